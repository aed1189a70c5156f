"""Exact Shapley values of boosted trees from their paths, without 2^m subsets and without a row of examples x background.

Of a leaf only one thing about a row matters: which of the path's columns it fits. The background is therefore counted
by its turns in a few cuts at a time (at most 2^12 or 2^depth counts for a group of leaves), and from these counts by (leaf, columns fitted), at most leaves x 2^depth counts however many rows it has, and so are the examples. Where an
example fits the columns A that a background row does not, and the background row the columns B that the example does
not, and every other column of the path is fitted by both, the leaf is reached by exactly the subsets that hold A and
nothing of B; its share for each column has a closed form in the sizes of A and B.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import literal_table, stage
from .boosting import BoostedModel

# Leaves whose paths hold no more cuts than this are looked at together.
_CUTS_AT_ONCE = 12
# Up to so many cuts in all are expressions of their own; more are a loop over arrays, which is slow for each row.
_PLAIN_CUTS = 64


@dataclass(frozen=True)
class LeafPath:
    """``steps`` are (place of the node, whether the path goes left, bit of the column) from the leaf up; ``columns`` are in
    the order of their bits."""

    value: float
    steps: tuple[tuple[int, bool, int], ...]
    columns: tuple[str, ...]


def leaf_paths(model: BoostedModel) -> list[LeafPath]:
    """The path of every leaf that lies below a cut."""
    features, width = [*model.numeric, *model.categorical], 2 ** (model.depth + 1)
    held = {(n.tree, n.node): n for n in model.nodes}
    paths = []
    for leaf in model.nodes:
        if leaf.column >= 0 or leaf.node == 1:
            continue
        steps, columns, node = [], [], leaf.node
        while node > 1:
            above = held[leaf.tree, node // 2]
            name = features[above.column]
            if name not in columns:
                columns.append(name)
            steps.append((leaf.tree * width + above.node, node % 2 == 0, columns.index(name)))
            node //= 2
        paths.append(LeafPath(leaf.leaf or 0.0, tuple(steps), tuple(columns)))
    return paths


def _groups(paths: Sequence[LeafPath]) -> list[tuple[list[int], list[int]]]:
    """Places and leaves of every group: leaves in their order, as long as their paths hold few places in all."""
    groups: list[tuple[list[int], list[int]]] = []
    for leaf, path in enumerate(paths):
        mine = [place for place, _, _ in path.steps]
        if not groups or len({*groups[-1][0], *mine}) > _CUTS_AT_ONCE:
            groups.append(([], []))
        places, leaves = groups[-1]
        places.extend([p for p in mine if p not in places])
        leaves.append(leaf)
    return groups


def _turns(model: BoostedModel, groups: Sequence[tuple[list[int], list[int]]], plain_cuts: int = _PLAIN_CUTS) -> Column:
    """For each group, a bit for every place of it in which the row goes left, the first place lowest."""
    width = 2 ** (model.depth + 1)
    nodes = {n.tree * width + n.node: n for n in model.nodes}
    if len({p for places, _ in groups for p in places}) <= plain_cuts:
        return F.array(*[sum((F.when(model.turn(nodes[p]), 1 << i).otherwise(0) for i, p in enumerate(places)), F.lit(0))
                         for places, _ in groups]).cast("array<int>")
    table = F.from_json(F.lit(json.dumps([places[::-1] for places, _ in groups])), "array<array<int>>")

    def one(turns: Column, places: Column) -> Column:
        return F.aggregate(places, F.lit(0), lambda bits, place: 2 * bits + F.when(F.get(turns, place), 1).otherwise(0))

    return F.get(F.transform(F.array(model.turns()), lambda turns: F.transform(table, lambda places: one(turns, places))), F.lit(0))


def _fitting(df: DataFrame, paths: Sequence[LeafPath], groups: Sequence[tuple[list[int], list[int]]], name: str) -> DataFrame:
    """Rows with ``group`` and ``turns`` as one row for each ``leaf`` of the group, with the bits of those of its columns
    all of whose conditions the turns meet."""
    told = []
    for g, (places, leaves) in enumerate(groups):
        for leaf in leaves:
            steps = [(1 << places.index(place), left, bit) for place, left, bit in paths[leaf].steps]
            tests = [{"bit": 1 << i, "mask": sum(at for at, _, bit in steps if bit == i),
                      "wanted": sum(at for at, left, bit in steps if bit == i and left)} for i in range(len(paths[leaf].columns))]
            told.append((g, leaf, tests))
    table = literal_table(df.sparkSession, told, "group int, leaf int, tests array<struct<bit: int, mask: int, wanted: int>>")
    met = F.aggregate("tests", F.lit(0), lambda bits, test: F.when(
        F.col("turns").bitwiseAND(test["mask"]) == test["wanted"], bits + test["bit"]).otherwise(bits))
    return df.join(F.broadcast(table), "group").withColumn(name, met).drop("group", "turns", "tests")


def _weights(most: int) -> tuple[Column, Column]:
    """Share of a leaf for a column of A, and for one of B, at place |A| * (most + 1) + |B|."""
    a_side, b_side = [], []
    for a in range(most + 1):
        for b in range(most + 1):
            orders = factorial(a + b)
            a_side.append(factorial(a - 1) * factorial(b) / orders if a else 0.0)
            b_side.append(-factorial(a) * factorial(b - 1) / orders if b else 0.0)
    return F.array(*map(F.lit, a_side)), F.array(*map(F.lit, b_side))


def path_shapley(
    examples: DataFrame, background: DataFrame, model: BoostedModel, keys: Sequence[str], silent: Sequence[str] = (),
) -> DataFrame:
    """(*keys*, ``feature``, ``value``) on the log-odds scale: the worth of a subset is the mean log-odds of the
    background rows that hold the example's values in it.

    Values add up to the example's log-odds less the mean log-odds of the background. (``shapley_values`` takes the
    log-odds of the mean chance instead, for any scorer, and pays 2^m subsets.) The background is read once and counted inside
    each task, so it may be a whole training table; examples cost one row for each leaf. Examples of equal keys stay
    apart; columns in ``silent`` are no inputs and get zero. Counts and shares are bounded by the model: at most 4^depth
    pairs a leaf.
    """
    features, paths = [*model.numeric, *model.categorical], leaf_paths(model)
    spark = examples.sparkSession
    held = stage(examples.select(*dict.fromkeys([*keys, *features])).withColumn(
        "__example", F.monotonically_increasing_id()), "examples")
    named = F.array(*[F.lit(f) for f in (*features, *silent)])
    nothing = held.select("__example", F.explode(named).alias("feature"), F.lit(0.0).alias("share"))
    groups = _groups(paths)
    turns = F.posexplode(_turns(model, groups)).alias("group", "turns")
    kinds = background.select(turns).groupBy("group", "turns").agg(F.count("*").alias("n"))
    counts = stage(_fitting(kinds, paths, groups, "other").groupBy("leaf", "other").agg(F.sum("n").alias("n")), "background-paths")
    total = counts.filter(F.col("leaf") == 0).agg(F.sum("n")).first()[0]
    if paths and not total:
        raise ValueError("attribution needs at least one background row")
    own = stage(_fitting(held.select("__example", turns), paths, groups, "mine").select("__example", "leaf", "mine"), "example-paths")

    columns = [[{"bit": 1 << i, "feature": f} for i, f in enumerate(p.columns)] for p in paths]
    table = literal_table(spark, [(i, p.value, 2 ** len(p.columns) - 1, c) for i, (p, c) in enumerate(zip(paths, columns))],
                          "leaf int, worth double, whole int, columns array<struct<bit: int, feature: string>>")
    mine, other = F.col("mine"), F.col("other")
    pairs = own.select("leaf", "mine").distinct().join(table, "leaf").join(counts, "leaf").filter(
        mine.bitwiseOR(other) == F.col("whole"))
    pairs = pairs.select("leaf", "mine", "columns", (F.col("worth") * F.col("n") / F.lit(float(total or 1))).alias("part"),
                         mine.bitwiseAND(F.bitwise_not(other)).alias("a"), other.bitwiseAND(F.bitwise_not(mine)).alias("b"))
    most = max((len(p.columns) for p in paths), default=0)
    for_a, for_b = _weights(most)
    sizes = F.bit_count("a") * (most + 1) + F.bit_count("b")
    shares = pairs.select("leaf", "mine", "a", "b", F.inline("columns"), (F.get(for_a, sizes) * F.col("part")).alias("gain"),
                          (F.get(for_b, sizes) * F.col("part")).alias("loss"))
    shares = shares.withColumn("share", F.when(F.col("a").bitwiseAND(F.col("bit")) != 0, F.col("gain")).when(
        F.col("b").bitwiseAND(F.col("bit")) != 0, F.col("loss"))).filter(F.col("share").isNotNull())
    shares = shares.groupBy("leaf", "mine", "feature").agg(F.sum("share").alias("share"))
    found = own.join(shares, ["leaf", "mine"]).select("__example", "feature", "share")
    values = found.unionByName(nothing).groupBy("__example", "feature").agg(F.sum("share").alias("value"))
    return values.join(held.select("__example", *keys), "__example").select(*keys, "feature", "value")

"""Second-order boosted trees: sums of gradients and hessians, one aggregation for each level of a tree.

The rows are written once with their numbers cut into bins, and stay where they are. A level of a tree is one
``groupBy`` of (node, column, bin or category) with partial sums in every task, so what is shuffled grows with the
bins and categories, not with the rows. Only the best cut of each node comes to the driver: at most 2^depth rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hash_order
from ..runtime import drop_stage, literal_table, stage
from .models import BOOSTING, SPLIT_SEED

_GAIN_DIGITS = 9
# Rounds between two writings of the rows' margins; in between they are expressions over the trees.
_ROUNDS_TO_STAGE = 5
# Up to so many cuts of a column are compared one by one; more are a loop over an array, which is slow for each row.
_PLAIN_CUTS = 16
_NODES_DDL = ("tree int, node int, column int, cut double, value string, missing_left boolean, "
              "leaf double, gain double, cover double")
_INPUTS_DDL = "numeric array<string>, categorical array<string>, depth int, base double"


@dataclass(frozen=True)
class Settings:
    """``min_child_weight`` is the least hessian of a side, ``penalty`` the L2 term of leaf values, ``least_gain``
    what a cut must win. Rows and columns are drawn anew for each tree with the given shares."""

    rounds: int = BOOSTING["maxIter"]
    depth: int = BOOSTING["maxDepth"]
    rate: float = BOOSTING["stepSize"]
    row_share: float = BOOSTING["subsamplingRate"]
    column_share: float = float(BOOSTING["featureSubsetStrategy"])
    min_child_weight: float = 5.0
    penalty: float = 1.0
    least_gain: float = 0.0
    bins: int = 64
    base: float = 0.0
    seed: int = SPLIT_SEED


@dataclass(frozen=True)
class Node:
    """A row goes left if its number is at most ``cut``, or its category equals ``value``; ``column`` is -1 in a leaf.

    The children of node n are 2n and 2n + 1. ``cover`` is the sum of hessians.
    """

    tree: int
    node: int
    column: int = -1
    cut: float | None = None
    value: str | None = None
    missing_left: bool = False
    leaf: float | None = None
    gain: float | None = None
    cover: float = 0.0


def share_limit(share: float) -> str | None:
    """Eight hexadecimal digits below which a hash is drawn; None where all are."""
    return None if share >= 1 else f"{int(share * 2**32):08x}"


def _drawn(text: Column, share: float) -> Column:
    limit = share_limit(share)
    return F.lit(True) if limit is None else F.substring(F.md5(text), 1, 8) < F.lit(limit)


def _is_drawn(text: str, share: float) -> bool:
    limit = share_limit(share)
    return limit is None or md5(text.encode()).hexdigest()[:8] < limit


def _number(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)


def _array(values: Sequence[Column], kind: str) -> Column:
    return F.array(*values).cast(f"array<{kind}>")


def _doubles(values: Sequence[float | None]) -> Column:
    return F.expr("array(" + ", ".join("double(null)" if v is None else f"double('{v!r}')" for v in values) + ")")


def _ints(values: Sequence[int]) -> Column:
    return F.expr(f"array({', '.join(map(str, values))})")


class _Trees:
    """Trees as literal arrays, ``width`` places for each tree."""

    def __init__(self, nodes: Sequence[Node], first: int, trees: int, depth: int, numbers: int):
        self.width, self.numbers = 2 ** (depth + 1), numbers
        held: list[Node | None] = [None] * (trees * self.width)
        for n in nodes:
            held[(n.tree - first) * self.width + n.node] = n
        self.column = _ints([n.column if n else -1 for n in held])
        self.cut = _doubles([n.cut if n else None for n in held])
        self.value = F.array(*[F.lit(n.value if n else None).cast("string") for n in held])
        self.missing = F.expr("array(" + ", ".join("true" if n and n.missing_left else "false" for n in held) + ")")
        self.leaf = _doubles([n.leaf if n and n.leaf is not None else 0.0 for n in held])

    def child(self, numbers: Column, texts: Column, at: Column, tree: Column) -> Column:
        """One step down; a row in a leaf stays."""
        place = tree * self.width + at
        column = F.get(self.column, place)
        by_number = F.coalesce(F.get(numbers, column) <= F.get(self.cut, place), F.get(self.missing, place))
        by_text = F.coalesce(F.get(texts, column - self.numbers) == F.get(self.value, place), F.lit(False))
        left = F.when(column < self.numbers, by_number).otherwise(by_text)
        return F.when(column < 0, at).otherwise(2 * at + F.when(left, 0).otherwise(1))

    def worth(self, at: Column, tree: Column) -> Column:
        return F.get(self.leaf, tree * self.width + at)


@dataclass(frozen=True)
class BoostedModel:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    depth: int
    base: float
    nodes: tuple[Node, ...]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` of the positive class and a boolean ``predicted``, without a shuffle.

        A missing number takes the side that the cut learned, or the right one; unseen categories and NULL are none.
        """
        count = 1 + max((n.tree for n in self.nodes), default=-1)
        trees = _Trees(self.nodes, 0, count, self.depth, len(self.numeric))
        numbers = _array([_number(c) for c in self.numeric], "double")
        texts = _array([F.col(c).cast("string") for c in self.categorical], "string")
        made = df.select("*", numbers.alias("__numbers"), texts.alias("__texts"),
                         F.array_repeat(F.lit(1), count).alias("__at"))
        for _ in range(self.depth):
            made = made.withColumn("__at", F.transform("__at", lambda at, tree: trees.child(
                F.col("__numbers"), F.col("__texts"), at, tree)))
        margin = F.aggregate(F.transform("__at", lambda at, tree: trees.worth(at, tree)), F.lit(self.base), lambda x, y: x + y)
        made = made.withColumn("__chance", 1 / (1 + F.exp(-margin)))
        kept = [F.col(c) for c in df.columns if c not in ("probability", "predicted")]
        return made.select(*kept, F.col("__chance").alias("probability"), (F.col("__chance") > 0.5).alias("predicted"))

    def turn(self, node: Node) -> Column:
        """Whether a row goes left in a node that cuts."""
        if node.column < len(self.numeric):
            return F.coalesce(_number(self.numeric[node.column]) <= F.lit(node.cut), F.lit(node.missing_left))
        text = F.col(self.categorical[node.column - len(self.numeric)]).cast("string")
        return F.coalesce(text == F.lit(node.value), F.lit(False))

    def turns(self) -> Column:
        """For every place (tree times 2^(depth + 1), plus node), whether a row would go left in it; nothing in leaves."""
        count = 1 + max((n.tree for n in self.nodes), default=0)
        trees = _Trees(self.nodes, 0, count, self.depth, len(self.numeric))
        # The inner lambda reads a variable, so the row's values are gathered once and not once a place.
        row = F.struct(_array([_number(c) for c in self.numeric], "double").alias("numbers"),
                       _array([F.col(c).cast("string") for c in self.categorical], "string").alias("texts"))
        places = _ints(range(count * trees.width))
        made = F.transform(F.array(row), lambda held: F.transform(places, lambda place: trees.child(
            held["numbers"], held["texts"], place % trees.width, F.floor(place / trees.width).cast("int")) % 2 == 0))
        return F.get(made, F.lit(0))

    def table(self, spark: SparkSession) -> DataFrame:
        """One row for each node of each tree."""
        return literal_table(spark, [tuple(vars(n).values()) for n in self.nodes], _NODES_DDL)

    def save(self, spark: SparkSession, path: str) -> None:
        """Nodes and inputs as two tables below ``path``; an earlier model there is replaced."""
        inputs = literal_table(spark, [(list(self.numeric), list(self.categorical), self.depth, self.base)], _INPUTS_DDL)
        self.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        inputs.coalesce(1).write.mode("overwrite").parquet(f"{path}/inputs")


def load(spark: SparkSession, path: str) -> BoostedModel:
    inputs = spark.read.schema(_INPUTS_DDL).parquet(f"{path}/inputs").first()
    nodes = spark.read.schema(_NODES_DDL).parquet(f"{path}/nodes").orderBy("tree", "node").collect()
    return BoostedModel(tuple(inputs["numeric"]), tuple(inputs["categorical"]), inputs["depth"], inputs["base"],
                        tuple(Node(**n.asDict()) for n in nodes))


def number_cuts(rows: DataFrame, numeric: Sequence[str], bins: int) -> dict[str, list[float]]:
    """At most ``bins`` - 1 cut points of each column, from mergeable quantile sketches in one scan."""
    if not numeric:
        return {}
    shares = [i / bins for i in range(1, bins)]
    row = rows.agg(*[F.percentile_approx(_number(c), shares, 100 * bins).alias(f"cuts_{i}")
                     for i, c in enumerate(numeric)]).first()
    return {c: sorted(set(row[f"cuts_{i}"] or [])) for i, c in enumerate(numeric)}


def _bin(column: str, cuts: Sequence[float]) -> Column:
    """How many cuts lie below the number; NULL where it is missing."""
    if not cuts:
        return F.when(_number(column).isNotNull(), 0)
    if len(cuts) <= _PLAIN_CUTS:
        return F.when(_number(column).isNotNull(), sum((F.when(F.lit(c) < _number(column), 1).otherwise(0) for c in cuts), F.lit(0)))
    return F.when(_number(column).isNotNull(), F.size(F.filter(_doubles(cuts), lambda c: c < _number(column))))


def _best_cuts(rows: DataFrame, totals: Mapping[int, tuple], numeric: Sequence[str], categorical: Sequence[str],
               settings: Settings, tree: int) -> list:
    """The best cut of each open node, from rows with ``node``, ``g``, ``h``, ``bins`` and ``texts``."""
    name = f"{settings.seed}|{tree}|"
    # Keys of a sum are never NULL: Spark's fast map for few groups takes no others. Odd cells hold what is missing, and
    # numbers that the tree did not draw are not summed.
    def cell(column: int, value: Column, bin_: Column, text: Column) -> Column:
        return F.struct(F.when(value.isNull(), 2 * column + 1).otherwise(2 * column).alias("cell"),
                        F.coalesce(bin_, F.lit(0)).alias("bin"), F.coalesce(text, F.lit("")).alias("value"))

    kept = [i for i, c in enumerate(numeric) if _is_drawn(name + c, settings.column_share)]
    cells = [cell(i, F.get("bins", F.lit(i)), F.get("bins", F.lit(i)), F.lit("")) for i in kept]
    cells += [cell(len(numeric) + i, F.get("texts", F.lit(i)), F.lit(0), F.get("texts", F.lit(i))) for i in range(len(categorical))]
    if not cells:
        return []
    sums = rows.select("node", "g", "h", F.inline(F.array(*cells))).groupBy("node", "cell", "bin", "value").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("n"))
    column, there = F.shiftright("cell", 1), F.col("cell").bitwiseAND(1) == 0
    sums = sums.select("node", column.alias("column"), F.when(there & (column < len(numeric)), F.col("bin")).alias("bin"),
                       F.when(there & (column >= len(numeric)), F.col("value")).alias("value"), "g", "h", "n")

    # A category is a part of its own, so no part is longer than the bins of a column.
    part = Window.partitionBy("node", "column", "value")
    is_number, known = F.col("column") < len(numeric), F.col("bin").isNotNull()
    up_to = part.orderBy(F.col("bin").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    missing = {x: F.sum(F.when(is_number & ~known, F.col(x)).otherwise(0)).over(part) for x in "ghn"}
    sums = sums.withColumns({f"{x}_missing": missing[x] for x in "ghn"} | {f"{x}_left": F.sum(x).over(up_to) for x in "ghn"})
    names = F.array(*[F.lit(name + c) for c in (*numeric, *categorical)])
    chosen = _drawn(F.when(is_number, F.get(names, F.col("column"))).otherwise(
        F.concat(F.get(names, F.col("column")), F.lit("="), F.col("value"))), settings.column_share)
    open_cells = sums.filter((known | F.col("value").isNotNull()) & chosen)
    with_side = open_cells.withColumn("missing_left", F.explode(
        F.when(F.col("n_missing") > 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))))
    with_side = with_side.withColumns({
        x: F.when(F.col("missing_left"), F.col(f"{x}_left")).otherwise(F.col(f"{x}_left") - F.col(f"{x}_missing")) for x in "ghn"})
    last = 2 ** (1 + max(totals).bit_length()) if totals else 1
    of_node = {x: F.get(_doubles([totals[k][i] if k in totals else None for k in range(last)]), F.col("node")) for i, x in enumerate("ghn")}
    right = {x: of_node[x] - F.col(x) for x in "ghn"}

    def strength(g: Column, h: Column) -> Column:
        return F.try_divide(g * g, h + settings.penalty)

    gain = F.round(strength(F.col("g"), F.col("h")) + strength(right["g"], right["h"]) - strength(of_node["g"], of_node["h"]), _GAIN_DIGITS)
    cuts = with_side.withColumns({"gain": gain, "h_right": right["h"], "n_right": right["n"]}).filter(
        (F.col("gain") > settings.least_gain) & (F.col("n") > 0) & (F.col("n_right") > 0)
        & (F.col("h") >= settings.min_child_weight) & (F.col("h_right") >= settings.min_child_weight))
    order = F.struct((-F.col("gain")).alias("loss"), "column", "bin", "value", "missing_left", "gain", "g", "h", "n")
    return cuts.groupBy("node").agg(F.min(order).alias("best")).select("node", "best.*").collect()


def fit(
    train: DataFrame,
    target: Column,
    numeric: Sequence[str],
    categorical: Sequence[str],
    keys: Sequence[str],
    settings: Settings = Settings(),
    cuts: Mapping[str, Sequence[float]] | None = None,
) -> BoostedModel:
    """Trees for the log-odds of ``target`` (a boolean column; rows where it is NULL take no part).

    A number is cut at one of its ``cuts`` (from quantile sketches where none are given) and a category is cut off
    alone, as its one-hot column would be; categories need no dictionary. Rows are drawn for a tree by a hash of their keys, and
    each number or category by a hash of its name, so reruns draw the same; copies of a key are drawn together, and the
    number of columns varies around its share. Of cuts with the same gain the first column, bin and category
    win. Nothing to cut gives trees of one leaf; without rows all leaves are zero.
    """
    rows = train.filter(target.isNotNull())
    at_cuts = {c: sorted(cuts[c]) for c in numeric} if cuts is not None else number_cuts(rows, numeric, settings.bins)
    data = stage(rows.select(
        target.cast("double").alias("y"), hash_order(keys, settings.seed).alias("order"),
        _array([_bin(c, at_cuts[c]) for c in numeric], "int").alias("bins"),
        _array([F.col(c).cast("string") for c in categorical], "string").alias("texts"),
        F.lit(settings.base).alias("margin")), "boosting")
    last_written, model = data, []
    for tree in range(settings.rounds):
        chance = 1 / (1 + F.exp(-F.col("margin")))
        drawn = data.filter(_drawn(F.concat(F.lit(f"{tree}|"), F.col("order")), settings.row_share)).select(
            "bins", "texts", (chance - F.col("y")).alias("g"), (chance * (1 - chance)).alias("h"), F.lit(1).alias("node"))
        root = drawn.agg(F.sum("g"), F.sum("h"), F.count("*")).first()
        totals = {1: (root[0] or 0.0, root[1] or 0.0, float(root[2]))}
        nodes = {1: Node(tree, 1)}
        for level in range(settings.depth):
            within = {n: t for n, t in totals.items() if n >= 2**level}
            if not within or not (numeric or categorical):
                break
            below = drawn
            for _ in range(level):
                below = below.withColumn("node", _step(nodes, tree, settings, len(numeric)))
            for r in _best_cuts(below.filter(F.col("node") >= 2**level), within, numeric, categorical, settings, tree):
                n = r["node"]
                nodes[n] = Node(tree, n, r["column"], None if r["bin"] is None else float(r["bin"]), r["value"],
                                r["missing_left"], None, r["gain"])
                left = (r["g"], r["h"], float(r["n"]))
                totals[2 * n] = left
                totals[2 * n + 1] = tuple(a - b for a, b in zip(totals[n], left))
                nodes |= {k: Node(tree, k) for k in (2 * n, 2 * n + 1)}
        for n, node in nodes.items():
            g, h, _ = totals[n]
            leaf = None if node.column >= 0 else -settings.rate * g / (h + settings.penalty) + 0.0 if h + settings.penalty else 0.0
            nodes[n] = replace(node, leaf=leaf, cover=h)
        model += [nodes[n] for n in sorted(nodes)]
        if tree + 1 < settings.rounds:
            data = data.withColumn("node", F.lit(1))
            for _ in range(max(nodes).bit_length() - 1):
                data = data.withColumn("node", _step(nodes, tree, settings, len(numeric)))
            reached = _Trees(list(nodes.values()), tree, 1, settings.depth, len(numeric))
            data = data.withColumn("margin", F.col("margin") + reached.worth(F.col("node"), F.lit(0))).drop("node")
            if (tree + 1) % _ROUNDS_TO_STAGE == 0:
                data = stage(data, "boosting")
                drop_stage(last_written)
                last_written = data
    drop_stage(last_written)

    def real(node: Node) -> Node:
        if node.cut is None:
            return node
        values = at_cuts[numeric[node.column]]
        return replace(node, cut=values[int(node.cut)] if node.cut < len(values) else float("inf"))

    return BoostedModel(tuple(numeric), tuple(categorical), settings.depth, settings.base, tuple(map(real, model)))


def _step(nodes: Mapping[int, Node], tree: int, settings: Settings, numbers: int) -> Column:
    trees = _Trees(list(nodes.values()), tree, 1, settings.depth, numbers)
    return trees.child(F.col("bins"), F.col("texts"), F.col("node"), F.lit(0))

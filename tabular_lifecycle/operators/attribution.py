"""Exact Shapley values of single predictions, as one Spark job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import stage

# Means of 0 or 1 are moved in by this much before the log-odds.
_CLIP = 1e-15

Scorer = Callable[[DataFrame], DataFrame]


def _numbered(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The rows with numbers from 0 without gaps in a column ``name``, written once; and how many there are."""
    held = stage(rows.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__id", 33)
    counts = sorted(held.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for r in counts:
        starts += [F.lit(r["part"]), F.lit(total)]
        total += r["n"]
    if not total:
        raise ValueError("attribution needs at least one example and one background row")
    place = F.element_at(F.create_map(*starts), part) + F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return held.withColumn(name, place.cast("long")).drop("__id"), total


def shapley_values(
    examples: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    scorer: Scorer,
    silent: Sequence[str] = (),
) -> DataFrame:
    """(*keys*, ``feature``, ``value``) on the log-odds scale for each example.

    For each of the 2^m feature subsets the example's values are put into every background row, the
    mixed rows are scored, and the log-odds of the mean score is the worth of the subset. ``scorer``
    adds a ``probability`` column. Work is spread over (example, subset), and partial means are
    formed before the shuffle; examples of equal keys stay apart. Columns in ``silent`` are no model inputs; they
    get zero. Exact values cost examples x 2^m x background rows, so m and the background are the caller's to
    keep small.
    """
    m = len(features)
    slots, n = _numbered(background.select(*features), "__slot")
    numbered, _ = _numbered(examples.select(*dict.fromkeys([*keys, *features])), "__example")
    subsets = numbered.select(
        "__example", *[F.col(f).alias(f"__example_{f}") for f in features],
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2**m - 1).cast("long"))).alias("__subset"),
    ).repartition("__example", "__subset")
    all_slots = F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    mixed = subsets.withColumn("__slot", F.explode(all_slots)).join(slots, "__slot")
    mixed = mixed.select("__example", "__subset", *[
        F.when(F.col("__subset").bitwiseAND(F.lit(1 << i).cast("long")) != 0, F.col(f"__example_{f}"))
        .otherwise(F.col(f)).alias(f)
        for i, f in enumerate(features)
    ])
    mean = F.least(F.greatest(F.avg("probability"), F.lit(_CLIP)), F.lit(1.0 - _CLIP))
    worth = scorer(mixed).groupBy("__example", "__subset").agg(mean.alias("__mean"))
    worth = worth.withColumn("__worth", F.log(F.col("__mean") / (1.0 - F.col("__mean"))))

    # Weight of a subset of s features for a feature inside it, and for one outside it.
    inside = [0.0] + [factorial(s - 1) * factorial(m - s) / factorial(m) for s in range(1, m + 1)]
    outside = [-factorial(s) * factorial(m - s - 1) / factorial(m) for s in range(m)] + [0.0]
    size = F.bit_count("__subset")
    shares = []
    for i, f in enumerate(features):
        member = F.col("__subset").bitwiseAND(F.lit(1 << i).cast("long")) != 0
        weight = F.when(member, F.get(F.array(*map(F.lit, inside)), size)).otherwise(
            F.get(F.array(*map(F.lit, outside)), size)
        )
        shares.append(F.struct(F.lit(f).alias("feature"), (weight * F.col("__worth")).alias("share")))
    shares += [F.struct(F.lit(f).alias("feature"), F.lit(0.0).alias("share")) for f in silent]
    values = worth.select("__example", F.inline(F.array(*shares))).groupBy("__example", "feature").agg(
        F.sum("share").alias("value"))
    return values.join(numbered.select("__example", *keys), "__example").select(*keys, "feature", "value")

"""Running counts over sorted values without one big task.

A window that sorts a whole column is a single task. Here the value range of each column is first
cut into buckets, equal values are counted together (so a value held by a third of all rows
becomes one row before the shuffle), and running counts are taken inside (column, bucket). What
lies below a bucket is one small number per bucket, added at the end.

The cut points come from a mergeable quantile sketch. They steer only how the work is split, never
the result, and they are fixed on the driver before they are used, so a recomputed task sees the
same buckets.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import literal_table, settle

ROWS_PER_BUCKET = 5_000_000
# Small columns are cut as well, so that every size runs the same plan.
_LEAST_CUTS = 16
_MAX_CUTS = 1024
_SKETCH_K = 1000
# Partial sketches are merged in groups of tasks before the last merge.
_MERGE_FAN_IN = 64


@dataclass(frozen=True)
class Ladder:
    """Row counts and bucket borders per column, measured in one pass."""

    columns: tuple[str, ...]
    sizes: Mapping[str, Mapping[str, int]]
    borders: Mapping[str, Sequence[float]] = field(default_factory=dict)
    steps: int = 1


def present(value: Column) -> Column:
    """The value as a double, NULL for NaN."""
    as_double = value.cast("double")
    return F.when(~F.isnan(as_double), as_double)


def measure(
    df: DataFrame,
    columns: Sequence[str],
    conditions: Mapping[str, Column] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> Ladder:
    """Count the usable values of each column, per condition, and choose the bucket borders."""
    conditions = {"all": F.lit(True), **(conditions or {})}
    values = {c: present(F.col(c)) for c in columns}
    first, last = [], []
    for i, c in enumerate(columns):
        for name, condition in conditions.items():
            alias = f"n_{i}_{name}"
            first.append(F.count_if(values[c].isNotNull() & condition).alias(alias))
            last.append(F.sum(alias).alias(alias))
        first += [
            F.kll_sketch_agg_double(values[c], _SKETCH_K).alias(f"sketch_{i}"),
            F.min(values[c]).alias(f"min_{i}"), F.max(values[c]).alias(f"max_{i}"),
        ]
        # A task without a usable value has an empty sketch, which is left out of the merge.
        last += [
            F.kll_merge_agg_double(F.when(F.col(f"min_{i}").isNotNull(), F.col(f"sketch_{i}"))).alias(f"sketch_{i}"),
            F.min(f"min_{i}").alias(f"min_{i}"), F.max(f"max_{i}").alias(f"max_{i}"),
        ]
    # At most _MERGE_FAN_IN rows of fixed size remain, one row in the end.
    task = F.pmod(F.spark_partition_id(), F.lit(_MERGE_FAN_IN)).alias("task")
    row = df.groupBy(task).agg(*first).agg(*last).first()

    sizes, borders, largest = {}, {}, 0
    for i, c in enumerate(columns):
        sizes[c] = {name: int(row[f"n_{i}_{name}"] or 0) for name in conditions}
        largest = max(largest, sizes[c]["all"])
    wanted = max(_LEAST_CUTS, math.ceil(largest / rows_per_bucket))
    filled = [(i, c) for i, c in enumerate(columns) if sizes[c]["all"]]
    if filled:
        parts = min(wanted, _MAX_CUTS)
        ranks = F.expr("array(" + ", ".join(f"{k / parts!r}D" for k in range(1, parts)) + ")")
        sketches = literal_table(
            df.sparkSession, [tuple(bytes(row[f"sketch_{i}"]) for i, _ in filled)],
            ", ".join(f"sketch_{i} binary" for i, _ in filled),
        )
        cuts = sketches.select(*[
            F.kll_sketch_get_quantile_double(f"sketch_{i}", ranks).alias(f"cuts_{i}") for i, _ in filled
        ]).first()
        for i, c in filled:
            low, high = row[f"min_{i}"], row[f"max_{i}"]
            inner = sorted({q for q in cuts[f"cuts_{i}"] if low < q < high})
            if inner:
                borders[c] = [low, *inner, high]
    return Ladder(tuple(columns), sizes, borders, steps=max(1, math.ceil(wanted / _MAX_CUTS)))


def _bucket(ladder: Ladder, column: str) -> Column:
    """Bucket number of a row, growing with the value."""
    if column not in ladder.borders:
        return F.lit(0)
    coarse = F.col(f"__bucket_{column}").cast("int")
    if ladder.steps == 1:
        return coarse
    borders = F.array(*[F.lit(float(b)) for b in ladder.borders[column]])
    low, high = F.get(borders, coarse), F.get(borders, coarse + 1)
    share = (F.col(column).cast("double") - low) / (high - low)
    step = F.floor(share * ladder.steps).cast("int")
    step = F.coalesce(F.least(F.greatest(step, F.lit(0)), F.lit(ladder.steps - 1)), F.lit(0))
    return coarse * ladder.steps + step


def long_form(df: DataFrame, ladder: Ladder, keep: Sequence[str] = ()) -> DataFrame:
    """One row (``column``, ``bucket``, ``v``) per usable value, next to the ``keep`` columns."""
    wide = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in ladder.columns if c not in keep])
    if ladder.borders:
        names = list(ladder.borders)
        wide = Bucketizer(
            splitsArray=[[-math.inf, *ladder.borders[c][1:-1], math.inf] for c in names],
            inputCols=names, outputCols=[f"__bucket_{c}" for c in names], handleInvalid="keep",
        ).transform(wide)
    cells = [
        F.struct(F.lit(c).alias("column"), _bucket(ladder, c).alias("bucket"), present(F.col(c)).alias("v"))
        for c in ladder.columns
    ]
    exploded = wide.select(*keep, F.explode(F.array(*cells)).alias("cell"))
    return exploded.select(*keep, "cell.column", "cell.bucket", "cell.v").filter(F.col("v").isNotNull())


def before(keys: Sequence[str], order: str, *, inclusive: bool = False) -> Window:
    """Rows of the same keys that come before this one, or up to and with it."""
    end = 0 if inclusive else -1
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, end)


def offsets(per_bucket: DataFrame, keys: Sequence[str], counts: Mapping[str, str]) -> DataFrame:
    """Add, per bucket, the totals of all lower buckets; the input has one row per bucket."""
    below = before(keys, "bucket")
    return per_bucket.withColumns({
        name: F.coalesce(F.sum(count).over(below), F.lit(0)) for name, count in counts.items()
    })


def size_of(ladder: Ladder, column: Column, condition: str) -> Column:
    """Total of the named condition for the column named in the row, as a double."""
    pairs = [F.lit(x) for c in ladder.columns for x in (c, float(ladder.sizes[c][condition]))]
    return F.element_at(F.create_map(*pairs), column)


def distinct_ranks(df: DataFrame, ladder: Ladder) -> DataFrame:
    """(``column``, ``v``, ``n``, ``rank``): each distinct value with the mean rank of its rows."""
    values = long_form(df, ladder).groupBy("column", "bucket", "v").agg(F.count("*").alias("n"))
    lower = F.coalesce(F.sum("n").over(before(["column", "bucket"], "v")), F.lit(0))
    ranked = values.withColumn("lower", lower)
    per_bucket = settle(values.groupBy("column", "bucket").agg(F.sum("n").alias("held")), "buckets")
    ranked = ranked.join(offsets(per_bucket, ["column"], {"start": "held"}), ["column", "bucket"])
    return ranked.select("column", "v", "n", (F.col("start") + F.col("lower") + (F.col("n") + 1) / 2).alias("rank"))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(``column``, ``probability``, ``value``), linear between neighbours, exact at any size.

    Only the buckets that hold a wanted rank are read value by value.
    """
    spark = df.sparkSession
    ladder = measure(df, columns, rows_per_bucket=rows_per_bucket)
    wanted = []
    for c in columns:
        n = ladder.sizes[c]["all"]
        for p in probabilities:
            if n:
                position = p * (n - 1)
                low = math.floor(position)
                wanted += [(c, float(p), "low", low, position - low),
                           (c, float(p), "high", min(low + 1, n - 1), position - low)]
    schema = "column string, probability double, side string, rank bigint, share double"
    targets = literal_table(spark, wanted, schema)
    rows = long_form(df, ladder)
    per_bucket = rows.groupBy("column", "bucket").agg(F.count("*").alias("held"))
    steps = offsets(settle(per_bucket, "buckets"), ["column"], {"start": "held"})
    inside = (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("start") + F.col("held"))
    targets = settle(targets.join(steps, "column").filter(inside).drop("held"))
    rows = rows.join(targets.select("column", "bucket").distinct(), ["column", "bucket"], "left_semi")
    values = rows.groupBy("column", "bucket", "v").agg(F.count("*").alias("n"))
    lower = F.coalesce(F.sum("n").over(before(["column", "bucket"], "v")), F.lit(0))
    local = F.col("rank") - F.col("start")
    hits = values.withColumn("lower", lower).join(targets, ["column", "bucket"]).filter(
        (local >= F.col("lower")) & (local < F.col("lower") + F.col("n"))
    )
    low = F.max(F.when(F.col("side") == "low", F.col("v")))
    high = F.max(F.when(F.col("side") == "high", F.col("v")))
    return hits.groupBy("column", "probability").agg(
        F.when(low == high, low).otherwise(low + (high - low) * F.max("share")).alias("value")
    )

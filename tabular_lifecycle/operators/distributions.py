"""Stored distributions: value counts that merge, so that a new batch is tested without reading training rows again.

A distribution is a table (``dataset``, ``column``, ``bucket``, ``value``, ``n``). The borders of the buckets are taken once, from the
reference, and stored beside it; they steer how the work is split and which files are read, never the result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import literal_table, settle
from .drift import DRIFT_COLUMNS, add_pvalue, report_rows
from .ordered import ROWS_PER_BUCKET, Ladder, before, long_form, measure

_KEYS = ["dataset", "column"]


def borders(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> Ladder:
    """Bucket borders of each column, from one pass over the reference."""
    return measure(df, columns, rows_per_bucket=rows_per_bucket)


def borders_table(spark: SparkSession, ladder: Ladder) -> DataFrame:
    """(``place``, ``column``, ``borders``, ``steps``): one row for each column."""
    rows = [(i, c, [float(b) for b in ladder.borders.get(c, [])], ladder.steps) for i, c in enumerate(ladder.columns)]
    return literal_table(spark, rows, "place int, column string, borders array<double>, steps int")


def read_borders(table: DataFrame) -> Ladder:
    """The ladder that ``borders_table`` stored; a row a column, so the driver may hold it."""
    rows = sorted(table.collect(), key=lambda r: r.place)
    return Ladder(tuple(r["column"] for r in rows), {}, {r["column"]: list(r["borders"]) for r in rows if r["borders"]},
                  max((r["steps"] for r in rows), default=1))


def distribution(df: DataFrame, ladder: Ladder, dataset: str = "dataset") -> DataFrame:
    """Value counts of all columns of the ladder, by the data set named in each row; NULL and NaN are left out.

    Equal values are counted before the shuffle. All data sets of ``df`` are counted in one pass.
    """
    rows = long_form(df.withColumnRenamed(dataset, "dataset"), ladder, ["dataset"])
    return rows.groupBy("dataset", "column", "bucket", F.col("v").alias("value")).agg(F.count("*").alias("n"))


def merge(*parts: DataFrame) -> DataFrame:
    """One distribution of several with the same borders: counts add up."""
    first, *rest = parts
    for other in rest:
        first = first.unionByName(other)
    return first.groupBy("dataset", "column", "bucket", "value").agg(F.sum("n").alias("n"))


def _each_dataset(reference: DataFrame, compared: Sequence[str]) -> DataFrame:
    """The reference's rows once for each compared data set, under its name."""
    names = F.array(*[F.lit(name) for name in compared])
    return reference.drop("dataset").withColumn("dataset", F.explode(names))


def ks_stored(stored: DataFrame, reference: str, compared: Sequence[str], columns: Sequence[str] = DRIFT_COLUMNS, law: str = "finite") -> DataFrame:
    """(``dataset``, ``column``, ``n_training``, ``n_comparison``, ``statistic``, ``pvalue``) for each compared data set and column.

    All data sets are tested in one pass. Counts of the buckets bound the gap inside each; values are read only of
    buckets that could beat the widest gap at a border. A column with an empty side has a NULL statistic and p-value.
    """
    if not compared:
        raise ValueError("compared names no data set")
    stored = stored.where(F.col("dataset").isin(reference, *compared) & F.col("column").isin(*columns))
    first, others = stored.where(F.col("dataset") == reference), stored.where(F.col("dataset").isin(*compared))
    per_bucket = settle(stored.groupBy("dataset", "column", "bucket").agg(F.sum("n").alias("held")), "buckets")
    nothing = F.lit(0).cast("bigint")

    def sides(a: DataFrame, b: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
        both = a.select(*keys, F.col(count).alias("a"), nothing.alias("b")).unionByName(b.select(*keys, nothing.alias("a"), F.col(count).alias("b")))
        return both.groupBy(*keys).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))

    both = sides(_each_dataset(per_bucket.where(F.col("dataset") == reference), compared),
                 per_bucket.where(F.col("dataset").isin(*compared)), [*_KEYS, "bucket"], "held")
    whole, below = Window.partitionBy(*_KEYS), before(_KEYS, "bucket")
    steps = both.withColumns({
        "n": F.sum("a").over(whole), "m": F.sum("b").over(whole),
        "a0": F.coalesce(F.sum("a").over(below), nothing), "b0": F.coalesce(F.sum("b").over(below), nothing),
    })

    def gap(a, b):
        return F.try_divide(a.cast("double"), F.col("n")) - F.try_divide(b.cast("double"), F.col("m"))

    a, b, a0, b0 = (F.col(x) for x in ("a", "b", "a0", "b0"))
    steps = settle(steps.withColumns({
        "start": gap(a0, b0), "border": F.abs(gap(a0 + a, b0 + b)),
        "bound": F.greatest(F.abs(gap(a0 + a, b0)), F.abs(gap(a0, b0 + b))),
    }), "steps")
    at_borders = steps.groupBy(*_KEYS).agg(F.max("border").alias("gap"), F.max("n").alias("n"), F.max("m").alias("m"))
    contested = settle(steps.join(at_borders.select(*_KEYS, "gap"), _KEYS).where("bound > gap").select(*_KEYS, "bucket", "start", "n", "m"), "contested")
    held = contested.select(*_KEYS, "bucket")
    values = sides(first.drop("dataset").join(held, ["column", "bucket"]), others.join(held, [*_KEYS, "bucket"], "left_semi"), [*_KEYS, "bucket", "value"], "n")
    upto = before([*_KEYS, "bucket"], "value", inclusive=True)
    inside = values.withColumns({"a": F.sum("a").over(upto), "b": F.sum("b").over(upto)}).join(contested, [*_KEYS, "bucket"])
    inside = inside.select(*_KEYS, F.abs(F.col("start") + gap(F.col("a"), F.col("b"))).alias("gap"))
    widest = inside.unionByName(at_borders.select(*_KEYS, "gap")).groupBy(*_KEYS).agg(F.max("gap").alias("statistic"))
    wanted = literal_table(stored.sparkSession, [(d, c) for d in compared for c in columns], "dataset string, column string")
    # A data set without any row still has the reference's size beside it.
    sizes = per_bucket.groupBy("dataset", "column").agg(F.sum("held").alias("size"))
    of = lambda d, name: sizes.where(d).select(*_KEYS, F.col("size").alias(name))
    result = wanted.join(of(F.col("dataset") == reference, "n_training").drop("dataset"), "column", "left").join(
        of(F.col("dataset").isin(*compared), "n_comparison"), _KEYS, "left").join(widest, _KEYS, "left").select(
        *_KEYS, F.coalesce("n_training", nothing).alias("n_training"), F.coalesce("n_comparison", nothing).alias("n_comparison"), "statistic")
    return add_pvalue(result, "statistic", "n_training", "n_comparison", law)


def drift_reports(stored: DataFrame, reference: str, dates: Mapping[str, str], columns: Sequence[str] = DRIFT_COLUMNS,
                  alpha: float = 0.05, law: str = "finite") -> DataFrame:
    """Drift rows of every data set named in ``dates``, under its date, against the stored reference."""
    tested = ks_stored(stored, reference, list(dates), columns, law)
    date = F.element_at(F.create_map(*[F.lit(x) for pair in dates.items() for x in pair]), F.col("dataset"))
    return report_rows(tested, date, F.col("dataset"), alpha)

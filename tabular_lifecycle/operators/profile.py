"""Profiling tables: overview, numeric detail, histograms, frequent values, associations."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import literal_table, stage
from .ordered import ROWS_PER_BUCKET, distinct_ranks, exact_quantiles, measure, present
from .relational import numeric_columns

QUARTILES = (0.25, 0.5, 0.75)
STATISTICS = ("count", "missing", "distinct", "mean", "std", "min", "p25", "p50", "p75", "max")


def _as_text(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in columns]


def cells(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """(``column``, ``value``) with values of one type, text by default, all columns in one scan."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot([], list(columns), "column", "value")


def _by_kind(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Columns by the type that holds their values exactly; numbers need not become text."""
    kinds: dict[str, list[str]] = {}
    for field in df.select(*columns).schema.fields:
        whole = isinstance(field.dataType, T.IntegralType)
        kind = "bigint" if whole else "double" if isinstance(field.dataType, T.FractionalType) else "string"
        if isinstance(field.dataType, T.DecimalType):
            kind = "string"
        kinds.setdefault(kind, []).append(field.name)
    return kinds


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """(``column``, ``count``, ``missing``, ``distinct``).

    The exact form counts equal values together before the shuffle; the other one merges sketches.
    """
    parts = [_distinct_counts(cells(df, names, kind), exact) for kind, names in _by_kind(df, columns).items()]
    return reduce(DataFrame.unionByName, parts)


def _distinct_counts(rows: DataFrame, exact: bool) -> DataFrame:
    held = F.col("value").isNotNull()
    if not exact:
        return rows.groupBy("column").agg(
            F.count("*").alias("count"), F.count_if(~held).alias("missing"),
            F.approx_count_distinct("value").alias("distinct"),
        )
    values = rows.groupBy("column", "value").agg(F.count("*").alias("n"))
    # Partial sums are formed where the values are, so one column does not meet in one task.
    return values.groupBy("column").agg(
        F.sum("n").alias("count"), F.sum(F.when(held, 0).otherwise(F.col("n"))).alias("missing"),
        F.count("value").alias("distinct"),
    )


def overview(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: type, rows, missing values, distinct values and their shares."""
    columns = list(columns or df.columns)
    kinds = literal_table(df.sparkSession, [(c, t) for c, t in df.dtypes if c in columns],
                          "column string, type string")
    counts = distinct_counts(df, columns, exact).join(kinds, "column")
    filled = F.col("count") - F.col("missing")
    return counts.select(
        "column", "type", "count", "missing", "distinct",
        (F.col("missing") / F.col("count")).alias("missing_share"),
        F.try_divide(F.col("distinct"), filled).alias("distinct_share"),
    )


def _moments(df: DataFrame, columns: Sequence[str], functions: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """The same aggregates for each column, one row per column.

    The columns are laid out as rows first: one wide aggregation would grow with columns times
    aggregates until it no longer compiles, this one stays the same size.
    """
    cells_of = [F.struct(F.lit(c).alias("column"), present(F.col(c)).alias("v")) for c in columns]
    return df.select(F.inline(F.array(*cells_of))).groupBy("column").agg(*[
        f(F.col("v")).cast("double").alias(name) for name, f in functions.items()
    ])


def _quartiles(df: DataFrame, columns: Sequence[str], exact: bool, rows_per_bucket: int) -> DataFrame:
    names = {p: f"p{round(p * 100)}" for p in QUARTILES}
    if not exact:
        return _moments(df, columns, {
            n: (lambda c, p=p: F.percentile_approx(c, p)) for p, n in names.items()
        })
    values = exact_quantiles(df, columns, QUARTILES, rows_per_bucket)
    return values.groupBy("column").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("value"))).alias(n) for p, n in names.items()
    ])


def numeric_detail(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Mean, deviation, extremes, quartiles, zeros, and bias-corrected skewness and excess kurtosis."""
    columns = list(columns or numeric_columns(df))

    def skew(c: Column) -> Column:
        n = F.count(c).cast("double")
        return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))

    def kurt(c: Column) -> Column:
        n = F.count(c).cast("double")
        top = ((n + 1) * F.kurtosis(c) + 6) * (n - 1)
        return F.when(n > 3, F.try_divide(top, (n - 2) * (n - 3)))

    detail = _moments(df, columns, {
        "n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
        "zeros": lambda c: F.count_if(c == 0), "skewness": skew, "kurtosis": kurt,
    })
    return detail.join(_quartiles(df, columns, exact, rows_per_bucket), "column", "left")


def summarize(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Descriptive statistics of every column as (``column``, ``stat``, ``value``), values as doubles.

    Text columns have the counts only.
    """
    columns = list(columns or df.columns)
    numbers = [c for c in numeric_columns(df) if c in columns]
    counts = distinct_counts(df, columns, exact).select(
        "column", *[F.col(x).cast("double").alias(x) for x in ("count", "missing", "distinct")]
    )
    wide = counts.unpivot("column", ["count", "missing", "distinct"], "stat", "value")
    if numbers:
        detail = _moments(df, numbers, {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max})
        detail = detail.join(_quartiles(df, numbers, exact, rows_per_bucket), "column", "left")
        measures = [s for s in STATISTICS if s not in ("count", "missing", "distinct")]
        wide = wide.unionByName(detail.unpivot("column", measures, "stat", "value"))
    return wide


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # One row per class is left here, so the total over them is a small window.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def histogram(df: DataFrame, columns: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """(``column``, ``bin``, ``low``, ``high``, ``n``): equal-width bins, the last one closed.

    Infinite values have no bin. A constant column gets a range of width one around its value.
    """
    columns = list(columns or numeric_columns(df))

    def finite(c: str) -> Column:
        value = present(F.col(c))
        return F.when(F.abs(value) != F.lit(float("inf")), value)

    numbers = df.select(*[finite(c).alias(c) for c in columns])
    row = numbers.agg(*[f(c).alias(f"{name}_{i}") for i, c in enumerate(columns)
                        for name, f in (("low", F.min), ("high", F.max))]).first()
    ranges = {}
    for i, c in enumerate(columns):
        low, high = row[f"low_{i}"], row[f"high_{i}"]
        if low is not None:
            ranges[c] = (low, high) if low < high else (low - 0.5, high + 0.5)
    if not ranges:
        return literal_table(df.sparkSession, [], "column string, bin int, low double, high double, n bigint")
    located = []
    for c, (low, high) in ranges.items():
        position = F.floor((F.col(c) - F.lit(low)) / F.lit(high - low) * F.lit(float(bins)))
        located.append(F.struct(F.lit(c).alias("column"),
                                F.when(position.isNotNull(), F.least(position, F.lit(bins - 1)))
                                .cast("int").alias("bin")))
    counted = numbers.select(F.inline(F.array(*located))).filter(F.col("bin").isNotNull())
    counted = counted.groupBy("column", "bin").agg(F.count("*").alias("n"))
    edges = literal_table(df.sparkSession, [(c, b, low + (high - low) * b / bins, low + (high - low) * (b + 1) / bins)
                                    for c, (low, high) in ranges.items() for b in range(bins)],
                          "column string, bin int, low double, high double")
    return edges.join(counted, ["column", "bin"], "left").select(
        "column", "bin", "low", "high", F.coalesce("n", F.lit(0)).alias("n")
    )


def frequent_values(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values per column; ties go to the smaller value.

    The rank filter is applied by Spark before the shuffle too, so one column does not meet in one task.
    """
    counts = cells(df, columns).filter(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def correlations(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of each pair of numeric columns, in one aggregation, in long form."""
    columns = list(columns or numeric_columns(df))
    pairs = list(combinations(columns, 2))
    numbers = df.select(*[present(F.col(c)).alias(c) for c in columns])
    wide = numbers.agg(*[F.corr(a, b).alias(f"r_{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("first"), F.lit(b).alias("second"), F.col(f"r_{i}").alias("correlation"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def rank_correlations(
    df: DataFrame, columns: Sequence[str] | None = None, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Spearman correlation over the rows without missing values, with mean ranks for ties.

    Equal rows are counted together first, and each value meets its rank by an equality join: a
    value that many rows share is one row of the rank table, and AQE splits its side of the join.
    """
    columns = list(columns or numeric_columns(df))
    numbers = df.select(*[present(F.col(c)).alias(c) for c in columns]).dropna("any")
    ladder = measure(numbers, columns, rows_per_bucket=rows_per_bucket)
    ranks = distinct_ranks(numbers, ladder)
    rows = numbers.groupBy(*columns).agg(F.count("*").alias("weight"))
    for i, c in enumerate(columns):
        table = ranks.filter(F.col("column") == c).select(F.col("v").alias(f"__v{i}"), F.col("rank").alias(f"__r{i}"))
        rows = rows.join(table, F.col(c) == F.col(f"__v{i}")).drop(f"__v{i}")
    # Mean ranks average to the middle rank in every column.
    middle = F.lit((ladder.sizes[columns[0]]["all"] + 1) / 2)
    weight, centred = F.col("weight"), [F.col(f"__r{i}") - middle for i in range(len(columns))]
    pairs = list(combinations(range(len(columns)), 2))

    def product(i: int, j: int) -> Column:
        return F.sum(weight * centred[i] * centred[j])

    wide = rows.agg(*[
        F.try_divide(product(i, j), F.sqrt(product(i, i) * product(j, j))).alias(f"r_{i}_{j}") for i, j in pairs
    ])
    out = [F.struct(F.lit(columns[i]).alias("first"), F.lit(columns[j]).alias("second"),
                    F.col(f"r_{i}_{j}").alias("correlation")) for i, j in pairs]
    return wide.select(F.inline(F.array(*out)))


def associations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cramér's V of each pair of categorical columns, plain and bias-corrected."""
    pairs = list(combinations(columns, 2))
    cells_of = [F.struct(F.lit(i).alias("pair"), F.col(a).alias("a"), F.col(b).alias("b"))
                for i, (a, b) in enumerate(pairs)]
    table = df.select(*_as_text(columns)).select(F.inline(F.array(*cells_of)))
    table = table.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    # From here on the rows are contingency cells.
    table = stage(table.groupBy("pair", "a", "b").agg(F.count("*").cast("double").alias("n")), "cells")
    row_sums = table.groupBy("pair", "a").agg(F.sum("n").alias("row_sum"))
    column_sums = table.groupBy("pair", "b").agg(F.sum("n").alias("column_sum"))
    shape = row_sums.groupBy("pair").agg(
        F.count("*").cast("double").alias("r"), F.sum("row_sum").alias("total")
    ).join(column_sums.groupBy("pair").agg(F.count("*").cast("double").alias("c")), "pair")
    share = F.col("n") * F.col("n") / (F.col("row_sum") * F.col("column_sum"))
    joined = table.join(row_sums, ["pair", "a"]).join(column_sums, ["pair", "b"])
    names = literal_table(df.sparkSession, [(i, a, b) for i, (a, b) in enumerate(pairs)],
                          "pair int, first string, second string")
    phi = joined.groupBy("pair").agg((F.sum(share) - 1.0).alias("phi2")).join(shape, "pair").join(names, "pair")
    r, c, n, phi2 = F.col("r"), F.col("c"), F.col("total"), F.greatest(F.col("phi2"), F.lit(0.0))
    bias = F.try_divide((r - 1) * (c - 1), n - 1)
    r_fixed, c_fixed = r - F.try_divide((r - 1) * (r - 1), n - 1), c - F.try_divide((c - 1) * (c - 1), n - 1)
    corrected = F.try_divide(F.greatest(phi2 - bias, F.lit(0.0)), F.least(r_fixed, c_fixed) - 1)
    return phi.select(
        "first", "second",
        F.sqrt(F.try_divide(phi2, F.least(r, c) - 1)).alias("cramers_v"),
        F.sqrt(corrected).alias("cramers_v_corrected"),
    )


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Groups of equal rows with their size, for groups of more than one."""
    columns = list(columns or df.columns)
    return df.groupBy(*columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def drop_advice(
    correlated: DataFrame, associated: DataFrame, label: str,
    correlation_limit: float = 0.9, label_limit: float = 0.1,
) -> DataFrame:
    """(``feature``, ``reason``): the later column of a close pair, and columns hardly tied to the label."""
    close = correlated.filter(F.abs("correlation") > correlation_limit).select(
        F.col("second").alias("feature"), F.lit("correlated").alias("reason")
    )
    near = associated.filter((F.col("second") != label) & (F.col("first") != label)
                             & (F.col("cramers_v") > correlation_limit)).select(
        F.col("second").alias("feature"), F.lit("correlated").alias("reason")
    )
    weak = associated.filter(((F.col("second") == label) | (F.col("first") == label))
                             & (F.col("cramers_v") < label_limit)).select(
        F.when(F.col("second") == label, F.col("first")).otherwise(F.col("second")).alias("feature"),
        F.lit("weak").alias("reason"),
    )
    return close.unionByName(near).unionByName(weak).distinct()

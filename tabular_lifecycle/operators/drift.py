"""Distribution drift: two-sample Kolmogorov-Smirnov, drift rows, noise and drift history."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import row_noise, threshold_flag
from ..runtime import literal_table, settle
from .ordered import ROWS_PER_BUCKET, Ladder, before, long_form, measure, offsets, size_of

DRIFT_COLUMNS = ("fnlwgt", "hours_per_week", "log_capital_gain", "log_capital_loss")
DRIFT_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("dataset", T.StringType(), True),
    T.StructField("column", T.StringType(), True),
    T.StructField("statistic", T.FloatType(), True),
    T.StructField("pvalue", T.FloatType(), True),
    T.StructField("passed", T.IntegerType(), True),
])


def columns_to_rows(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(``column``, ``value``) rows, all columns in one scan; NULLs are kept."""
    return df.select(*keep, *columns).unpivot(
        [F.col(k) for k in keep], [F.col(c).cast("double").alias(c) for c in columns], "column", "value"
    )


def two_sided(training: DataFrame, comparison: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Both data sets as one frame; ``compared`` tells the side."""
    def side(df: DataFrame, flag: bool) -> DataFrame:
        return df.select(*[F.col(c).cast("double").alias(c) for c in columns], F.lit(flag).alias("compared"))

    return side(training, False).unionByName(side(comparison, True))


# Distribution function of z = sqrt(size) * D up to size**(-3/2), for z below 2. The sums run over
# half-odd numbers (h, standing for both signs) and whole numbers (g); ten terms are beyond double
# precision there.
_PELZ_GOOD = """
aggregate(
  transform(sequence(1, 10), i -> named_struct('h', pi() * pi() * (i - 0.5D) * (i - 0.5D), 'g', pi() * pi() * i * i)),
  named_struct('k0', 0D, 'k1', 0D, 'k2', 0D, 'w2', 0D, 'k3', 0D, 'w3', 0D),
  (t, x) -> named_struct(
    'k0', t.k0 + 2D * exp(-x.h / (2D * __z2)),
    'k1', t.k1 + 2D * (x.h - __z2) * exp(-x.h / (2D * __z2)),
    'k2', t.k2 + 2D * (6D * __z6 + 2D * __z4 + x.h * (2D * __z4 - 5D * __z2) + x.h * x.h * (1D - 2D * __z2)) * exp(-x.h / (2D * __z2)),
    'w2', t.w2 + 2D * x.g * exp(-x.g / (2D * __z2)),
    'k3', t.k3 + 2D * (x.h * x.h * x.h * (5D - 30D * __z2) + x.h * x.h * (212D * __z4 - 60D * __z2)
                       + x.h * (135D * __z4 - 96D * __z6) - 30D * __z6 - 90D * __z4 * __z4) * exp(-x.h / (2D * __z2)),
    'w3', t.w3 + 2D * (3D * x.g * __z2 - x.g * x.g) * exp(-x.g / (2D * __z2))),
  t -> sqrt(pi() / 2D) * (
    t.k0 / __z + t.k1 / (6D * __z4 * sqrt(__size))
    + (t.k2 / (72D * __z6 * __z) - t.w2 / (36D * __z2 * __z)) / __size
    + (t.k3 / (6480D * __z6 * __z4) + t.w3 / (108D * __z6)) / (__size * sqrt(__size))))
"""
_UPPER_TAIL = "2D * exp(-pow(6D * __size * __d + 1D, 2D) / (18D * __size))"
_LIMIT_LAW = """
2D * aggregate(sequence(1, 100), 0D, (t, i) -> t + if(i % 2 = 1, 1D, -1D) * exp(-2D * i * i * __z2))
"""


@F.pandas_udf(T.DoubleType())
def _exact_law(n: pd.Series, m: pd.Series, statistic: pd.Series) -> pd.Series:
    return pd.Series([exact_tail(*row) for row in zip(n, m, statistic)], dtype="float64")


def exact_tail(n: float, m: float, statistic: float) -> float | None:
    """Probability that two samples of one continuous law lie at least ``statistic`` apart.

    The pooled values are drawn one by one without regard to side; the chance of every count of the first side
    is carried along, and what reaches the gap on the way leaves.
    """
    if any(pd.isna(x) for x in (n, m, statistic)) or not n or not m:
        return None
    n, m = int(n), int(m)
    wall = round(statistic * n * m)
    first = np.arange(n + 1)
    inside = (first == 0).astype("float64")
    for drawn in range(n + m):
        left = n + m - drawn
        taken = inside * (n - first) / left
        inside = inside * np.clip(m - (drawn - first), 0, None) / left
        inside[1:] += taken[:-1]
        inside[np.abs(first * m - (drawn + 1 - first) * n) >= wall] = 0.0
    return float(min(max(1.0 - inside[n], 0.0), 1.0)) if wall > 0 else 1.0


def add_pvalue(
    df: DataFrame, statistic: str, n: str, m: str, law: str = "finite", name: str = "pvalue"
) -> DataFrame:
    """Add the two-sided p-value of a two-sample gap with ``n`` and ``m`` values per side.

    ``limit`` is the Kolmogorov limit law. ``finite`` is the law of one sample of the effective size
    round(n*m/(n+m)): the Pelz-Good expansion in the middle of the range, twice the one-sided tail
    beyond it. ``exact`` is the law of two samples itself, for small ones: its work grows with (n + m) * n.
    """
    if law not in ("finite", "limit", "exact"):
        raise ValueError("law is 'finite', 'limit' or 'exact'")
    if law == "exact":
        return df.withColumn(name, _exact_law(F.col(n), F.col(m), F.col(statistic)))
    effective = f"try_divide(CAST(`{n}` AS DOUBLE) * `{m}`, CAST(`{n}` AS DOUBLE) + `{m}`)"
    size = effective if law == "limit" else f"round({effective})"
    # The parts are one struct, computed once and referred to by name.
    parts = F.expr(f"named_struct('__size', {size}, '__d', `{statistic}`, '__z2', {size} * `{statistic}` * `{statistic}`)")
    value = _LIMIT_LAW if law == "limit" else f"if(__z2 >= 4D, {_UPPER_TAIL}, 1D - {_PELZ_GOOD})"
    fields = df.withColumn("__parts", parts).select(*df.columns, "__parts.*").withColumns({
        "__z": F.sqrt("__z2"), "__z4": F.col("__z2") * F.col("__z2"),
        "__z6": F.col("__z2") * F.col("__z2") * F.col("__z2"),
    })
    bounded = F.expr(f"if(__z2 < 0.04D, 1D, least(greatest({value}, 0D), 1D))")
    return fields.select(*df.columns, F.when(F.col("__d").isNotNull(), bounded).alias(name))


def _signed_gap(ladder: Ladder, a: Column, b: Column) -> Column:
    column = F.col("column")
    return a / size_of(ladder, column, "training") - b / size_of(ladder, column, "comparison")


def _contested_buckets(rows: DataFrame, ladder: Ladder) -> tuple[DataFrame, DataFrame]:
    """The widest gap at bucket borders, and the buckets that could still hold a wider one."""
    per_bucket = settle(
        rows.groupBy("column", "bucket").agg(
            F.count_if(~F.col("compared")).alias("a"), F.count_if("compared").alias("b")
        ), "buckets",
    )
    steps = offsets(per_bucket, ["column"], {"a0": "a", "b0": "b"})
    a, b, a0, b0 = (F.col(x) for x in ("a", "b", "a0", "b0"))
    steps = steps.withColumns({
        "start": _signed_gap(ladder, a0, b0),
        "border": F.abs(_signed_gap(ladder, a0 + a, b0 + b)),
        "bound": F.greatest(
            F.abs(_signed_gap(ladder, a0 + a, b0)), F.abs(_signed_gap(ladder, a0, b0 + b))
        ),
    })
    at_borders = settle(steps.groupBy("column").agg(F.max("border").alias("gap")))
    contested = steps.join(at_borders, "column").filter(F.col("bound") > F.col("gap"))
    return at_borders, settle(contested.select("column", "bucket", "start"), "contested")


def ks_two_sample(
    df: DataFrame,
    columns: Sequence[str],
    side: str = "compared",
    law: str = "finite",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """(``column``, ``n_training``, ``n_comparison``, ``statistic``, ``pvalue``) per column.

    NULL and NaN are left out. A column with an empty side has a NULL statistic and p-value.
    """
    compared = F.coalesce(F.col(side), F.lit(False))
    df = df.select(*columns, compared.alias("compared"))
    ladder = measure(
        df, columns, {"training": ~F.col("compared"), "comparison": F.col("compared")}, rows_per_bucket
    )
    usable = [c for c in columns if ladder.sizes[c]["training"] and ladder.sizes[c]["comparison"]]
    spark = df.sparkSession
    sizes = literal_table(
        spark,
        [(c, ladder.sizes[c]["training"], ladder.sizes[c]["comparison"]) for c in columns],
        "column string, n_training bigint, n_comparison bigint",
    )
    if usable:
        narrowed = Ladder(tuple(usable), ladder.sizes,
                          {c: b for c, b in ladder.borders.items() if c in usable}, ladder.steps)
        gaps = _largest_gaps(long_form(df, narrowed, ["compared"]), narrowed)
        result = sizes.join(gaps, "column", "left")
    else:
        result = sizes.withColumn("statistic", F.lit(None).cast("double"))
    return add_pvalue(result, "statistic", "n_training", "n_comparison", law)


def _largest_gaps(rows: DataFrame, ladder: Ladder) -> DataFrame:
    """Largest distance between the two distribution functions of each column."""
    at_borders, contested = _contested_buckets(rows, ladder)
    rows = rows.join(contested.select("column", "bucket"), ["column", "bucket"], "left_semi")
    values = rows.groupBy("column", "bucket", "v").agg(
        F.count_if(~F.col("compared")).alias("a"), F.count_if("compared").alias("b")
    )
    upto = before(["column", "bucket"], "v", inclusive=True)
    inside = values.withColumn("gap", _signed_gap(ladder, F.sum("a").over(upto), F.sum("b").over(upto)))
    extremes = inside.groupBy("column", "bucket").agg(F.max("gap").alias("high"), F.min("gap").alias("low"))
    shifted = extremes.join(contested, ["column", "bucket"]).select(
        "column",
        F.greatest(F.abs(F.col("start") + F.col("high")), F.abs(F.col("start") + F.col("low"))).alias("gap"),
    )
    return shifted.unionByName(at_borders).groupBy("column").agg(F.max("gap").alias("statistic"))


def drift_report(
    training: DataFrame,
    comparison: DataFrame,
    dataset: str,
    date: str,
    columns: Sequence[str] = DRIFT_COLUMNS,
    alpha: float = 0.05,
    law: str = "finite",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """One row per column in the drift-table schema; computed in double and narrowed last."""
    tested = ks_two_sample(two_sided(training, comparison, columns), columns,
                           law=law, rows_per_bucket=rows_per_bucket)
    return report_rows(tested, F.lit(date), F.lit(dataset), alpha)


def report_rows(tested: DataFrame, date: Column, dataset: Column, alpha: float) -> DataFrame:
    """Tested columns in the drift-table schema."""
    return tested.select(
        date.cast("date").alias("date"),
        dataset.alias("dataset"),
        F.col("column"),
        F.col("statistic").cast("float").alias("statistic"),
        F.col("pvalue").cast("float").alias("pvalue"),
        threshold_flag(F.col("pvalue"), alpha).alias("passed"),
    )


def perturb(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str] = DRIFT_COLUMNS,
    seed: int = 0, max_noise: int = 20,
) -> DataFrame:
    """Add the same whole number from [0, max_noise] to all ``columns`` of a row."""
    noise = row_noise(keys, seed, max_noise)
    return df.withColumns({c: F.col(c) + noise for c in columns})


def drift_history(*reports: DataFrame) -> DataFrame:
    """Dated reports one after another; columns match by name."""
    return reduce(DataFrame.unionByName, reports)

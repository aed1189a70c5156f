"""Aggregation, profiling, sort and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, runs
from ..operators import relational as rel
from ..plans import monitor
from ..plans.prepare import CATEGORICAL
from ..runtime import rounded, stage
from ..sources import CENSUS_COLUMNS
from . import fixtures as fx
from .book import query

_NUMBERS = ("age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week")


@query("d1_mean_by_group", fx.with_ctes("""
SELECT occupation, round(avg(age)) AS avg_age FROM census GROUP BY occupation ORDER BY avg_age DESC""", "census"))
def mean_by_group(spark, sf_dir):
    return rel.mean_by(fx.census(spark, sf_dir), "occupation", "age", "avg_age")


@query("d2_mean_of_numbers", fx.with_ctes("""
SELECT occupation, round(avg(age)) AS age, round(avg(fnlwgt)) AS fnlwgt, round(avg(education_num)) AS education_num,
       round(avg(capital_gain)) AS capital_gain, round(avg(capital_loss)) AS capital_loss,
       round(avg(hours_per_week)) AS hours_per_week
FROM census GROUP BY occupation""", "census"))
def mean_of_numbers(spark, sf_dir):
    return rel.means_of_numbers(fx.census(spark, sf_dir), "occupation", 0)


@query("d3_tagged_means", fx.with_ctes("""
SELECT round(avg(fnlwgt), 4) AS avg_fnlwgt, round(avg(hours_per_week), 4) AS avg_hours_per_week,
       round(avg(log_capital_gain), 4) AS avg_log_capital_gain, round(avg(log_capital_loss), 4) AS avg_log_capital_loss,
       '2010' AS year FROM modified""", "modified"))
def tagged_means(spark, sf_dir):
    rows = rel.means_tagged(fx.modified(spark, sf_dir), monitor.DRIFT_COLUMNS, "year", "2010")
    return _rounded_means(rows)


def _rounded_means(df):
    return df.withColumns({c: rounded(F.col(c), 4) for c in df.columns if c.startswith("avg_")})


@query("d4_conditional_count", """
SELECT CAST(sum(CASE WHEN l_tax = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "TOTAL_FAILURES" FROM lineitem""")
def conditional_count(spark, sf_dir):
    return rel.count_where(fx.table(spark, sf_dir, "lineitem"), F.col("l_tax") == 0, "TOTAL_FAILURES")


@query("d5_pivot_sum", fx.with_ctes("""
SELECT run_id, experiment_id, round(val_accuracy_score, 5) AS val_accuracy_score, round(val_f1_score, 5) AS val_f1_score,
       round(val_log_loss, 5) AS val_log_loss, round(val_precision_score, 5) AS val_precision_score,
       round(val_recall_score, 5) AS val_recall_score, round(val_roc_auc_score, 5) AS val_roc_auc_score,
       max_depth, booster FROM refined""", "refined"))
def pivot_sum(spark, sf_dir):
    entries = stage(runs.numeric_entries(fx.run_log(spark, sf_dir)).select("run_id", "experiment_id", "key", "value"))
    wide = rel.pivot_sum(entries, ["run_id", "experiment_id"], "key", "value")
    return wide.withColumns({c: rounded(F.col(c), 5) for c in wide.columns[2:]})


@query("d6_chart_by_run", fx.with_ctes("""
SELECT run_id, round(val_accuracy_score, 5) AS accuracy, round(val_roc_auc_score, 5) AS roc_auc FROM refined""",
                                       "refined"))
def chart_by_run(spark, sf_dir):
    rows = monitor.score_chart(runs.refine_runs(fx.run_log(spark, sf_dir)))
    return rows.withColumns({c: rounded(F.col(c), 5) for c in ("accuracy", "roc_auc")})


@query("d7_chart_sum_by_year", fx.with_ctes("""
SELECT '2010' AS year, round(avg(hours_per_week), 4) AS hours_per_week FROM modified
UNION ALL SELECT '2000', round(avg(hours_per_week), 4) FROM inference""", "inference", "modified"))
def chart_sum_by_year(spark, sf_dir):
    drifted = monitor.data_drift(fx.modified(spark, sf_dir), fx.inference(spark, sf_dir))
    return monitor.data_drift_charts(drifted).select("year", rounded(F.col("hours_per_week"), 4).alias("hours_per_week"))


@query("d8_chart_mean_by_year", fx.with_ctes("""
SELECT '2010' AS year, round(avg(fnlwgt), 4) AS fnlwgt, round(avg(log_capital_gain), 4) AS log_capital_gain,
       round(avg(log_capital_loss), 4) AS log_capital_loss FROM modified
UNION ALL SELECT '2000', round(avg(fnlwgt), 4), round(avg(log_capital_gain), 4), round(avg(log_capital_loss), 4)
FROM inference""", "inference", "modified"))
def chart_mean_by_year(spark, sf_dir):
    drifted = monitor.data_drift(fx.modified(spark, sf_dir), fx.inference(spark, sf_dir))
    names = ("fnlwgt", "log_capital_gain", "log_capital_loss")
    return monitor.data_drift_charts(drifted).select("year", *[rounded(F.col(c), 4).alias(c) for c in names])


_LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE_TEXTS = ("l_returnflag", "l_linestatus", "l_shipdate")
_SUMMARY_SQL = f"""
WITH long AS (
  UNPIVOT (SELECT {', '.join(f'{c}::DOUBLE AS {c}' for c in _LINE_NUMBERS)} FROM lineitem)
  ON {', '.join(_LINE_NUMBERS)} INTO NAME "column" VALUE v
), stats AS (
  SELECT "column", count(*)::DOUBLE AS "count", 0::DOUBLE AS missing, count(DISTINCT v)::DOUBLE AS "distinct",
    avg(v) AS mean, stddev_samp(v) AS std, min(v) AS min, quantile_cont(v, 0.25) AS p25,
    quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, max(v) AS max
  FROM long GROUP BY "column"
), texts AS (
  {' UNION ALL '.join(f"""SELECT '{c}' AS "column", count({c})::DOUBLE AS "count", 0::DOUBLE AS missing,
         count(DISTINCT {c})::DOUBLE AS "distinct" FROM lineitem""" for c in _LINE_TEXTS)}
)
SELECT "column", stat, round("value", 4) AS "value" FROM (
  UNPIVOT stats ON "count", missing, "distinct", mean, std, min, p25, p50, p75, max INTO NAME stat VALUE "value"
  UNION ALL
  UNPIVOT texts ON "count", missing, "distinct" INTO NAME stat VALUE "value")"""


@query("d9_table_summary", _SUMMARY_SQL)
def table_summary(spark, sf_dir):
    rows = profile.summarize(fx.line_items(spark, sf_dir, [*_LINE_NUMBERS, *_LINE_TEXTS]))
    return rows.withColumn("value", rounded(F.col("value"), 4))


@query("d10_class_ratio", fx.with_ctes("""
SELECT income, count(*) AS n, round(count(*) / (SELECT count(*) FROM training)::DOUBLE, 6) AS share
FROM training GROUP BY income""", "training"))
def class_ratio(spark, sf_dir):
    return profile.class_ratio(fx.training(spark, sf_dir), "income").withColumn("share", rounded(F.col("share")))


def _overview_sql(columns):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{t}' AS type, count(*) AS "count", count(*) - count({c}) AS missing,
  count(DISTINCT {c}) AS "distinct", round((count(*) - count({c}))::DOUBLE / count(*), 6) AS missing_share,
  round(count(DISTINCT {c})::DOUBLE / count({c}), 6) AS distinct_share FROM census"""
        for c, t in columns
    )


@query("e1_overview", fx.with_ctes(_overview_sql(
    [("age", "int"), ("fnlwgt", "double"), ("education_num", "double"), ("capital_gain", "double"),
     ("capital_loss", "double"), ("hours_per_week", "double"), *[(c, "string") for c in CATEGORICAL]]), "census"))
def overview(spark, sf_dir):
    columns = ["age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week", *CATEGORICAL]
    rows = profile.overview(fx.census(spark, sf_dir), columns)
    return rows.withColumns({c: rounded(F.col(c)) for c in ("missing_share", "distinct_share")})


@query("e2_numeric_detail", fx.with_ctes(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c})::DOUBLE AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
  min({c})::DOUBLE AS min, max({c})::DOUBLE AS max, (count(*) FILTER ({c} = 0))::DOUBLE AS zeros,
  round(skewness({c}), 5) AS skewness, round(kurtosis({c}), 5) AS kurtosis,
  round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
  round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75 FROM census""" for c in _NUMBERS), "census"))
def numeric_detail(spark, sf_dir):
    rows = profile.numeric_detail(stage(fx.census(spark, sf_dir).select(*_NUMBERS)))
    digits = {"mean": 4, "std": 4, "skewness": 5, "kurtosis": 5, "p25": 4, "p50": 4, "p75": 4}
    return rows.withColumns({c: rounded(F.col(c), d) for c, d in digits.items()})


@query("e3_histogram", fx.with_ctes(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", b::INTEGER AS bin, round(lo + (hi - lo) * b / 10, 6) AS low,
  round(lo + (hi - lo) * (b + 1) / 10, 6) AS high, coalesce(n, 0) AS n
FROM (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM census), range(10) r(b)
LEFT JOIN (SELECT least(floor(({c} - lo) / (hi - lo) * 10.0::DOUBLE), 9) AS k, count(*) AS n
           FROM census, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM census)
           WHERE {c} IS NOT NULL GROUP BY 1) ON k = b""" for c in _NUMBERS), "census"))
def histogram(spark, sf_dir):
    rows = profile.histogram(stage(fx.census(spark, sf_dir).select(*_NUMBERS)), bins=10)
    return rows.withColumns({c: rounded(F.col(c)) for c in ("low", "high")})


_COUNTED = (*CATEGORICAL, "row_key")


@query("e4_frequent_values", fx.with_ctes(f"""
SELECT "column", "value", n, CAST(place AS INTEGER) AS place FROM (
  SELECT "column", "value", count(*) AS n, row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, "value") AS place
  FROM (UNPIVOT (SELECT {', '.join(_COUNTED)} FROM census) ON {', '.join(_COUNTED)} INTO NAME "column" VALUE "value")
  GROUP BY "column", "value") WHERE place <= 5""", "census"))
def frequent_values(spark, sf_dir):
    return profile.frequent_values(fx.census(spark, sf_dir), list(_COUNTED), 5)


_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1:]]


@query("e5_correlation", fx.with_ctes(" UNION ALL ".join(
    f"""SELECT '{a}' AS "first", '{b}' AS "second", round(corr({a}, {b}), 6) AS correlation FROM census"""
    for a, b in _PAIRS), "census"))
def correlation(spark, sf_dir):
    rows = profile.correlations(fx.census(spark, sf_dir), _NUMBERS)
    return rows.withColumn("correlation", rounded(F.col("correlation")))


@query("e5_rank_correlation", fx.with_ctes(", whole AS (SELECT " + ", ".join(_NUMBERS) + " FROM census WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in _NUMBERS) + "), ranks AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::DOUBLE AS r_{c}" for c in _NUMBERS
) + " FROM whole) " + " UNION ALL ".join(
    f"""SELECT '{a}' AS "first", '{b}' AS "second", round(corr(r_{a}, r_{b}), 6) AS correlation FROM ranks""" for a, b in _PAIRS), "census"))
def rank_correlation(spark, sf_dir):
    rows = profile.rank_correlations(stage(fx.census(spark, sf_dir).select(*_NUMBERS)), _NUMBERS)
    return rows.withColumn("correlation", rounded(F.col("correlation")))


_TIED = CATEGORICAL
_ASSOCIATION_CTES = """, cells AS (
""" + " UNION ALL ".join(
    f"""SELECT '{a}' AS "first", '{b}' AS "second", {a} AS a, {b} AS b, count(*)::DOUBLE AS n FROM prepared GROUP BY {a}, {b}"""
    for i, a in enumerate(_TIED) for b in _TIED[i + 1:]) + """
), sums AS (
  SELECT *, sum(n) OVER (PARTITION BY "first", "second", a) AS ra, sum(n) OVER (PARTITION BY "first", "second", b) AS rb,
         sum(n) OVER (PARTITION BY "first", "second") AS t FROM cells
), phi AS (
  SELECT "first", "second", greatest(sum(n * n / (ra * rb)) - 1, 0) AS phi2, count(DISTINCT a)::DOUBLE AS r,
         count(DISTINCT b)::DOUBLE AS c, max(t) AS t FROM sums GROUP BY "first", "second"
), associations AS (
  SELECT "first", "second", sqrt(phi2 / (least(r, c) - 1)) AS cramers_v,
    sqrt(greatest(phi2 - (r-1)*(c-1)/(t-1), 0) / (least(r - (r-1)*(r-1)/(t-1), c - (c-1)*(c-1)/(t-1)) - 1)) AS cramers_v_corrected
  FROM phi
)
"""


@query("e6_association", fx.with_ctes(_ASSOCIATION_CTES + """
SELECT "first", "second", round(cramers_v, 6) AS cramers_v, round(cramers_v_corrected, 6) AS cramers_v_corrected
FROM associations""", "prepared"))
def association(spark, sf_dir):
    rows = profile.associations(fx.prepare(fx.census(spark, sf_dir)), _TIED)
    return rows.withColumns({c: rounded(F.col(c)) for c in ("cramers_v", "cramers_v_corrected")})


@query("e7_duplicate_rows", fx.with_ctes(f"""
, twice AS (SELECT {', '.join(CENSUS_COLUMNS)} FROM census UNION ALL SELECT {', '.join(CENSUS_COLUMNS)} FROM census WHERE age > 60)
SELECT {', '.join(CENSUS_COLUMNS)}, count(*) AS copies FROM twice GROUP BY ALL HAVING count(*) > 1""", "census"))
def duplicate_rows(spark, sf_dir):
    """All columns; line items have no equal rows, so those of the old are there twice."""
    rows = fx.census(spark, sf_dir).select(*CENSUS_COLUMNS)
    return profile.duplicate_rows(rows.unionByName(rows.where("age > 60")))


@query("e8_drop_advice", fx.with_ctes(_ASSOCIATION_CTES + """
, pearson AS (""" + " UNION ALL ".join(
    f"""SELECT '{a}' AS "first", '{b}' AS "second", corr({a}, {b}) AS r FROM census""" for a, b in _PAIRS) + """)
SELECT DISTINCT feature, reason FROM (
  SELECT "second" AS feature, 'correlated' AS reason FROM pearson WHERE abs(r) > 0.4
  UNION ALL SELECT "second", 'correlated' FROM associations WHERE cramers_v > 0.4 AND "first" <> 'income' AND "second" <> 'income'
  UNION ALL SELECT "first", 'weak' FROM associations WHERE cramers_v < 0.02 AND "second" = 'income')""",
                                     "census", "prepared"))
def drop_advice(spark, sf_dir):
    raw = fx.census(spark, sf_dir)
    raw = stage(raw.select(*{*_NUMBERS, *CATEGORICAL}))
    correlated = profile.correlations(raw, _NUMBERS)
    associated = profile.associations(fx.prepare(raw), _TIED)
    return profile.drop_advice(correlated, associated, "income", correlation_limit=0.4, label_limit=0.02)


@query("f1_sort_descending", fx.with_ctes("""
SELECT native_country, round(avg(age), 4) AS avg_age FROM census GROUP BY native_country ORDER BY avg_age DESC""", "census"))
def sort_descending(spark, sf_dir):
    means = fx.census(spark, sf_dir).groupBy("native_country").agg(rounded(F.avg("age"), 4).alias("avg_age"))
    return rel.sort_descending(means, "avg_age", "native_country")


@query("f2_union_distinct", fx.with_ctes("""
SELECT education, income FROM training UNION SELECT education, income FROM inference""", "training", "inference"))
def union_distinct(spark, sf_dir):
    return rel.union_distinct(*[
        part(spark, sf_dir).select("education", "income") for part in (fx.training, fx.inference)
    ])


@query("f3_union_history", fx.with_ctes("""
SELECT row_key, occupation, 'training' AS batch FROM training
UNION ALL SELECT row_key, occupation, 'inference' FROM inference""", "training", "inference"))
def union_history(spark, sf_dir):
    first = rel.tag(fx.training(spark, sf_dir).select("row_key", "occupation"), batch="training")
    second = rel.tag(fx.inference(spark, sf_dir).select("occupation", "row_key"), batch="inference")
    return rel.union_history(first, second)

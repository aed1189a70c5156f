"""Drift, dashboard queries and the composed preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators import distributions, drift, models, runs
from ..operators.evaluate import METRICS, metric_table
from ..plans import monitor
from ..plans.prepare import LABEL, prepare
from ..runtime import fresh_path, rounded, stage
from . import fixtures as fx
from .book import query
from .model_queries import INPUTS, _rule_metrics, inference_sides, rounded_metrics, split_training

_COLUMNS = drift.DRIFT_COLUMNS


def _baseline(spark, sf_dir):
    return drift.drift_report(_stored(fx.training, spark, sf_dir), _stored(fx.inference, spark, sf_dir), fx.INFERENCE, "2000-01-01")


def _history(spark, sf_dir):
    """Baseline and perturbed reports from stored distributions: every side is counted once, both dates in one pass."""
    clean, new = fx.both_sides(spark, sf_dir, [*fx.KEYS, *_COLUMNS])
    changed = drift.perturb(new, fx.KEYS, seed=fx.NOISE_SEED)
    ladder = distributions.borders(clean, _COLUMNS)
    sides = [side.select(F.lit(name).alias("dataset"), *_COLUMNS) for side, name in ((clean, fx.TRAINING), (new, fx.INFERENCE), (changed, fx.MODIFIED))]
    counted = stage(distributions.distribution(sides[0].unionByName(sides[1]).unionByName(sides[2]), ladder), "distributions")
    return distributions.drift_reports(counted, fx.TRAINING, {fx.INFERENCE: "2000-01-01", fx.MODIFIED: "2010-01-01"})


def _stored_history(spark, sf_dir):
    """The history as a table partitioned by date and data set."""
    path = fresh_path(spark, "drift-history")
    _history(spark, sf_dir).write.partitionBy("date", "dataset").parquet(path)
    return spark.read.schema(drift.DRIFT_SCHEMA).parquet(path)


def _stored(part, spark, sf_dir):
    """The tested columns of one side, written once: they are read in several passes."""
    return stage(part(spark, sf_dir).select(*_COLUMNS))


def _plain(history):
    """Drift rows in types that compare alike everywhere: text dates, rounded doubles."""
    return history.withColumns({
        "date": F.col("date").cast("string"),
        "statistic": rounded(F.col("statistic").cast("double"), 5),
        "pvalue": rounded(F.col("pvalue").cast("double"), 5),
    })


def _plain_sql(columns: str) -> str:
    return columns.replace("statistic", "round(CAST(statistic AS DOUBLE), 5) AS statistic").replace(
        "pvalue", "round(CAST(pvalue AS DOUBLE), 5) AS pvalue")


@query("k1_ks_drift", fx.with_ctes("""
SELECT "column", n AS n_training, m AS n_comparison, round(statistic, 6) AS statistic, round(pvalue, 6) AS pvalue
FROM baseline_gap""", "baseline_gap"))
def ks_drift(spark, sf_dir):
    sides = drift.two_sided(fx.training(spark, sf_dir), fx.inference(spark, sf_dir), _COLUMNS)
    tested = drift.ks_two_sample(stage(sides), _COLUMNS)
    return tested.withColumns({c: rounded(F.col(c)) for c in ("statistic", "pvalue")})


_ROWS = '"date", dataset, "column", statistic, pvalue, passed'


@query("k2_drift_report", fx.with_ctes(
    f"""SELECT {_plain_sql(_ROWS)} FROM history WHERE "date" = '2000-01-01'""", "history"))
def drift_report(spark, sf_dir):
    return _plain(_baseline(spark, sf_dir))


@query("k3_perturbed_data", fx.with_ctes("""
SELECT row_key, occupation, round(fnlwgt, 2) AS fnlwgt, hours_per_week, round(log_capital_gain, 6) AS log_capital_gain,
       round(log_capital_loss, 6) AS log_capital_loss FROM modified""", "modified"))
def perturbed_data(spark, sf_dir):
    path = sinks.overwrite_path(fx.modified(spark, sf_dir), fresh_path(spark, "modified"))
    rows = spark.read.parquet(path).select("row_key", "occupation", *_COLUMNS)
    return rows.withColumns({"fnlwgt": rounded(F.col("fnlwgt"), 2),
                             **{c: rounded(F.col(c)) for c in ("log_capital_gain", "log_capital_loss")}})


@query("k4_drift_history", fx.with_ctes(f"SELECT {_plain_sql(_ROWS)} FROM history", "history"))
def drift_history(spark, sf_dir):
    return _plain(_history(spark, sf_dir))


@query("k5_metric_drift")
def metric_drift_of_model(spark, sf_dir):
    """Fit on the training rows, then score validation, inference and perturbed rows."""
    train, validation = split_training(spark, sf_dir)
    model = models.fit_stages(train, INPUTS)
    columns = [*fx.KEYS, LABEL, *INPUTS.columns]
    new, changed = inference_sides(spark, sf_dir)
    parts = ((validation, fx.TRAINING), (new, fx.INFERENCE), (changed, fx.MODIFIED))
    tables = [
        metric_table(models.evaluate(models.score(model, rows.select(*columns, F.lit(name).alias("dataset"))), INPUTS))
        for rows, name in parts
    ]
    return rounded_metrics(monitor.metric_history(*tables))


@query("k5_rule_metric_history", fx.with_ctes(f"""
SELECT {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)}, dataset FROM metrics""", "metrics"))
def rule_metric_history(spark, sf_dir):
    """The same history under the fixed rule: two data sets first, the perturbed one appended."""
    first = metric_table(_rule_metrics(spark, sf_dir, fx.TRAINING, fx.INFERENCE))
    return rounded_metrics(monitor.metric_history(first, metric_table(_rule_metrics(spark, sf_dir, fx.MODIFIED))))


@query("l1_run_statistics", fx.with_ctes("SELECT run_id, experiment_id, " + ", ".join(
    f"round({c}, 5) AS {c}" for c in monitor.RUN_STATISTICS[2:]) + " FROM refined", "refined"))
def run_statistics(spark, sf_dir):
    rows = monitor.run_statistics(runs.refine_runs(fx.run_log(spark, sf_dir)))
    return rows.withColumns({c: rounded(F.col(c), 5) for c in monitor.RUN_STATISTICS[2:]})


@query("l2_metric_drift", fx.with_ctes(f"""
SELECT CASE WHEN dataset = '{fx.MODIFIED}' THEN '2010' ELSE '2000' END AS year, round(roc_auc_score, 6) AS roc_auc_score
FROM metrics WHERE dataset = '{fx.MODIFIED}' OR dataset = '{fx.INFERENCE}'""", "metrics"))
def metric_drift(spark, sf_dir):
    rows = monitor.metric_drift(metric_table(_rule_metrics(spark, sf_dir)), fx.MODIFIED, fx.INFERENCE)
    return rows.withColumn("roc_auc_score", rounded(F.col("roc_auc_score")))


@query("d7_chart_auc_by_year", fx.with_ctes(f"""
SELECT CASE WHEN dataset = '{fx.MODIFIED}' THEN '2010' ELSE '2000' END AS year, round(sum(roc_auc_score), 6) AS roc_auc
FROM metrics WHERE dataset = '{fx.MODIFIED}' OR dataset = '{fx.INFERENCE}' GROUP BY 1""", "metrics"))
def chart_auc_by_year(spark, sf_dir):
    rows = monitor.metric_drift(metric_table(_rule_metrics(spark, sf_dir)), fx.MODIFIED, fx.INFERENCE)
    return monitor.metric_drift_chart(rows).withColumn("roc_auc", rounded(F.col("roc_auc")))


@query("l3_numerical_drift", fx.with_ctes(f"""
SELECT "column" AS feature, {_plain_sql('statistic, pvalue, passed')} FROM history WHERE "date" = '2010-01-01'""",
                                          "history"))
def numerical_drift(spark, sf_dir):
    """Over a stored table, where the date names a partition."""
    return monitor.numerical_drift(_stored_history(spark, sf_dir)).withColumns({
        c: rounded(F.col(c).cast("double"), 5) for c in ("statistic", "pvalue")
    })


@query("l3_total_failures", fx.with_ctes(
    'SELECT CAST(sum(CASE WHEN passed = 0 THEN 1 ELSE 0 END) AS BIGINT) AS "TOTAL_FAILURES" FROM history', "history"))
def total_failures(spark, sf_dir):
    return monitor.total_failures(_stored_history(spark, sf_dir))


def _means_sql(source: str, year: str) -> str:
    return "SELECT " + ", ".join(f"round(avg({c}), 4) AS avg_{c}" for c in _COLUMNS) + f", '{year}' AS year FROM {source}"


@query("l4_data_drift", fx.with_ctes(
    f"{_means_sql('modified', '2010')} UNION {_means_sql('inference', '2000')}", "modified", "inference"))
def data_drift(spark, sf_dir):
    rows = monitor.data_drift(fx.modified(spark, sf_dir), fx.inference(spark, sf_dir))
    return rows.withColumns({f"avg_{c}": rounded(F.col(f"avg_{c}"), 4) for c in _COLUMNS})


@query("m1_prepare", fx.with_ctes("""
SELECT row_key, workclass, fnlwgt, education, education_num, marital_status, occupation, relationship, race, sex,
       hours_per_week, native_country, income, age_by_decade, round(log_capital_gain, 6) AS log_capital_gain,
       round(log_capital_loss, 6) AS log_capital_loss FROM prepared""", "prepared"))
def prepared(spark, sf_dir):
    rows = prepare(fx.census(spark, sf_dir)).drop("o_orderdate")
    return rows.withColumns({c: rounded(F.col(c)) for c in ("log_capital_gain", "log_capital_loss")})


@query("m1_mean_hours", fx.with_ctes("""
SELECT occupation, round(avg(hours_per_week), 2) AS avg_hours FROM prepared GROUP BY occupation ORDER BY avg_hours DESC""",
                                     "prepared"))
def mean_hours(spark, sf_dir):
    """Mean hours by cleaned occupation: one scan, the joins of the view, one aggregation."""
    from ..operators.relational import mean_by

    return mean_by(prepare(fx.census(spark, sf_dir)), "occupation", "hours_per_week", "avg_hours", 2)

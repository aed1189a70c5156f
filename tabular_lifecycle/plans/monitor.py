"""The dashboard's table queries and the aggregations behind its charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import case_label, on_date
from ..operators.drift import DRIFT_COLUMNS
from ..operators.relational import any_of, chart, count_where, means_tagged, project, tag, union_distinct

RUN_STATISTICS = (
    "run_id", "experiment_id", "val_accuracy_score", "val_f1_score", "val_log_loss",
    "val_precision_score", "val_recall_score", "val_roc_auc_score",
)


def run_statistics(refined: DataFrame) -> DataFrame:
    return project(refined, RUN_STATISTICS)


def score_chart(refined: DataFrame) -> DataFrame:
    return chart(refined, "run_id", {
        "accuracy": ("sum", "val_accuracy_score"), "roc_auc": ("sum", "val_roc_auc_score"),
    })


def metric_drift(metrics: DataFrame, modified: str, original: str) -> DataFrame:
    """ROC AUC per census year: 2010 for the modified data set, 2000 for the original."""
    rows = any_of(metrics, "dataset", [modified, original])
    year = case_label(F.col("dataset"), {modified: "2010"}, "2000")
    return rows.select(year.alias("year"), "roc_auc_score")


def metric_drift_chart(drifted: DataFrame) -> DataFrame:
    return chart(drifted, "year", {"roc_auc": ("sum", "roc_auc_score")})


def numerical_drift(history: DataFrame, day: str = "2010-01-01") -> DataFrame:
    return history.filter(on_date(F.col("date"), day)).select(
        F.col("column").alias("feature"), "statistic", "pvalue", "passed"
    )


def total_failures(history: DataFrame) -> DataFrame:
    return count_where(history, F.col("passed") == 0, "TOTAL_FAILURES")


def data_drift(modified: DataFrame, original: DataFrame, columns: Sequence[str] = DRIFT_COLUMNS) -> DataFrame:
    """Column means of both years, one row each; two equal rows would be one."""
    return union_distinct(
        means_tagged(modified, columns, "year", "2010"), means_tagged(original, columns, "year", "2000")
    )


def data_drift_charts(drifted: DataFrame) -> DataFrame:
    """Hours are summed per year, the other means are averaged."""
    return chart(drifted, "year", {
        "log_capital_gain": ("avg", "avg_log_capital_gain"),
        "fnlwgt": ("avg", "avg_fnlwgt"),
        "hours_per_week": ("sum", "avg_hours_per_week"),
        "log_capital_loss": ("avg", "avg_log_capital_loss"),
    })


def metric_history(*tables: DataFrame, dataset: str | None = None) -> DataFrame:
    """Metric rows of several evaluations, appended by name; optionally under one label."""
    first, *rest = tables
    for other in rest:
        first = first.unionByName(other)
    return tag(first, dataset=dataset) if dataset else first

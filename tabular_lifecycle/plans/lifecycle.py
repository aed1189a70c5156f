"""The whole cycle over named tables: ingest, train and score, log runs, watch for drift."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..operators import distributions, drift, models, profile
from ..operators.attribution import shapley_values
from ..operators.evaluate import METRICS as METRIC_NAMES
from ..operators.evaluate import metric_table
from ..operators.runs import refine_runs
from ..operators.sampling import fixed_sample, stratified_split
from ..runtime import stage
from ..sources import RUN_LOG_SCHEMA, read_csv
from . import monitor
from .prepare import CATEGORICAL_INPUTS, LABEL, NUMERIC_INPUTS, POSITIVE, SUPPORTED, prepare, prepare_training

# Table names that existing queries and dashboards refer to.
RAW = "raw_income"
CLEAN = "clean_income"
INFERENCE = "inference_income"
METRICS = "metric_data_bronze"
EXPERIMENT_RUNS = "experiment_data_bronze"
SEARCH_RUNS = "automl_data_bronze"
DRIFT = "numerical_drift_income"
DISTRIBUTIONS = "numerical_distributions"
BORDERS = "numerical_borders"
MODIFIED = "modified_inference_data"
MODIFIED_LABEL = "modified_inference_income"
MODEL = "income"


@dataclass(frozen=True)
class Workspace:
    """A database and the column keys that random steps hash; by default the whole row."""

    spark: SparkSession
    database: str
    keys: Sequence[str] = ()
    format: str = "parquet"

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def keys_of(self, df: DataFrame) -> list[str]:
        return list(self.keys) or sorted(df.columns)

    def reset(self, location: str | None = None) -> None:
        """Drop the database with everything in it and create it anew."""
        sinks.drop_database(self.spark, self.database)
        sinks.create_database(self.spark, self.database, location)

    def publish(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` as a table under the database's own location, which lasts when scratch files are cleared."""
        sinks.overwrite_table(df, self.name(table), self.format)
        return self.table(table)


def ingest(work: Workspace, training_csv: str, inference_csv: str) -> None:
    """Raw, clean and inference tables from two header-less files, and the stored distributions of the clean one."""
    raw = work.publish(read_csv(work.spark, training_csv), RAW)
    clean = work.publish(prepare_training(raw), CLEAN)
    work.publish(prepare(read_csv(work.spark, inference_csv)), INFERENCE)
    ladder = distributions.borders(clean, drift.DRIFT_COLUMNS)
    work.publish(distributions.borders_table(work.spark, ladder), BORDERS)
    _store_distribution(work, clean, CLEAN)


def _store_distribution(work: Workspace, rows: DataFrame, dataset: str) -> None:
    """Value counts of a data set's drift columns, in place of those that were stored for it."""
    ladder = distributions.read_borders(work.table(BORDERS))
    counted = distributions.distribution(rows.withColumn("dataset", F.lit(work.name(dataset))), ladder)
    sinks.replace_batches(counted, work.name(DISTRIBUTIONS), ("dataset", "column"), work.format)


def _inputs(work: Workspace, rows: DataFrame) -> models.Inputs:
    return models.Inputs(NUMERIC_INPUTS, CATEGORICAL_INPUTS, LABEL, POSITIVE, work.keys_of(rows))


def split_clean(work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of the clean table."""
    rows = work.table(CLEAN)
    tagged = stratified_split(rows, LABEL, work.keys_of(rows), models.SPLIT_SEED)
    return tuple(tagged.filter(F.col("split") == part).drop("split") for part in ("train", "validation"))


def _metrics(work: Workspace, model: PipelineModel, rows: DataFrame, label: str) -> DataFrame:
    scored = models.score(model, rows.withColumn("dataset", F.lit(work.name(label))))
    return metric_table(models.evaluate(scored, _inputs(work, rows)))


def describe(work: Workspace) -> dict[str, DataFrame]:
    """Profile of the clean table: overview, summary, and advice on columns to drop."""
    rows = stage(work.table(CLEAN))
    texts = [c for c, kind in rows.dtypes if kind == "string"]
    return {
        "overview": profile.overview(rows),
        "summary": profile.summarize(rows),
        "advice": profile.drop_advice(profile.correlations(rows), profile.associations(rows, texts), LABEL),
    }


def train(work: Workspace, classifier: Estimator | None = None, model_root: str | None = None,
          experiment_id: str = "training") -> PipelineModel:
    """Fit on the clean table; the metric table holds validation and inference scores.

    The run with its parameters and metrics becomes the table of experiment runs. With ``model_root`` the
    model is stored under the run's id, and what scores the tables is the model read back.
    """
    training, validation = split_clean(work)
    inputs = _inputs(work, training)
    classifier = classifier or models.boosted_trees()
    started = dt.datetime.now(dt.timezone.utc)
    model = models.fit_stages(training, inputs, classifier)
    run_id = uuid.uuid4().hex
    if model_root:
        models.save_model(model, model_root, MODEL, run_id)
        model = models.load_model(model_root, MODEL, run_id)
    checked = stage(_metrics(work, model, validation, CLEAN))
    row = checked.first()
    metrics = {f"val_{m}": row[m] for m in METRIC_NAMES if row[m] is not None}
    params = {p.name: str(v) for p, v in classifier.extractParamMap().items()}
    ended = dt.datetime.now(dt.timezone.utc)
    run = (run_id, experiment_id, metrics, {"model": type(classifier).__name__, **params}, started, ended)
    store_runs(work, work.spark.createDataFrame([run], RUN_LOG_SCHEMA))
    scores = monitor.metric_history(checked, _metrics(work, model, work.table(INFERENCE), INFERENCE))
    sinks.replace_batches(scores, work.name(METRICS), ("dataset",), work.format, others="drop")
    return model


def explain(work: Workspace, model: PipelineModel, background_rows: int = 500, examples: int = 1) -> DataFrame:
    """Attribution of some validation rows against training rows; missing categories take the most frequent one."""
    training, validation = split_clean(work)
    texts = [c for c, kind in training.dtypes if kind == "string" and c in SUPPORTED]
    common = training.agg(*[F.mode(c).alias(c) for c in texts]).first().asDict()
    filled = [part.fillna({c: v for c, v in common.items() if v is not None}) for part in (training, validation)]
    background = fixed_sample(filled[0], background_rows, work.keys_of(training), models.SPLIT_SEED)
    chosen = fixed_sample(filled[1], examples, work.keys_of(validation), models.SPLIT_SEED)
    return shapley_values(chosen, background, SUPPORTED, work.keys_of(validation), lambda rows: models.score(model, rows))


def search(work: Workspace, experiment_id: str, **options) -> PipelineModel:
    """Search for a model within a time budget and store the refined runs."""
    training, validation = split_clean(work)
    log, best = models.search_models(training, validation, _inputs(work, training), experiment_id, **options)
    store_runs(work, log, SEARCH_RUNS)
    return best


def store_runs(work: Workspace, log: DataFrame, table: str = EXPERIMENT_RUNS) -> None:
    """Replace the table by the refined runs; their columns may differ from the last time."""
    sinks.overwrite_table(refine_runs(log), work.name(table), work.format)


def watch(work: Workspace, model: PipelineModel, noise_seed: int = 0, alpha: float = 0.05,
          dates: tuple[str, str] = ("2000-01-01", "2010-01-01")) -> None:
    """Drift of the inference table and of its perturbed copy, and the copy's metrics.

    Both are compared with the stored distributions of the clean table, which is not read again, in one pass. The drift
    history is partitioned by date and data set and the metrics by data set: a rerun replaces its own batches.
    """
    inference = work.table(INFERENCE)
    changed = work.publish(drift.perturb(inference, work.keys_of(inference), seed=noise_seed), MODIFIED)
    _store_distribution(work, inference, INFERENCE)
    _store_distribution(work, changed, MODIFIED_LABEL)
    reports = distributions.drift_reports(
        work.table(DISTRIBUTIONS), work.name(CLEAN),
        {work.name(INFERENCE): dates[0], work.name(MODIFIED_LABEL): dates[1]}, alpha=alpha)
    sinks.replace_batches(reports, work.name(DRIFT), ("date", "dataset"), work.format)
    sinks.replace_batches(_metrics(work, model, changed, MODIFIED_LABEL), work.name(METRICS), ("dataset",), work.format)


def dashboard(work: Workspace) -> dict[str, DataFrame]:
    """The dashboard's table queries over the stored tables."""
    return {
        "run_statistics": monitor.run_statistics(work.table(SEARCH_RUNS)),
        "metric_drift": monitor.metric_drift(
            work.table(METRICS), work.name(MODIFIED_LABEL), work.name(INFERENCE)),
        "numerical_drift": monitor.numerical_drift(work.table(DRIFT)),
        "total_failures": monitor.total_failures(work.table(DRIFT)),
        "data_drift": monitor.data_drift(work.table(MODIFIED), work.table(INFERENCE)),
    }

"""Models, evaluation and run statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import models, runs
from ..operators.attribution import shapley_values
from ..operators.drift import perturb
from ..operators.evaluate import METRICS, classification_metrics, metric_table
from ..operators.features import fit_features
from ..operators.sampling import fixed_sample, stratified_split
from ..plans.prepare import CATEGORICAL_INPUTS, LABEL, NUMERIC_INPUTS, POSITIVE, SUPPORTED
from ..runtime import fresh_path, rounded, stage
from . import fixtures as fx
from .book import query

INPUTS = models.Inputs(NUMERIC_INPUTS, CATEGORICAL_INPUTS, LABEL, POSITIVE, fx.KEYS)


def split_training(spark, sf_dir):
    """Training rows with their split, written once."""
    rows = stage(fx.training(spark, sf_dir).select(*fx.KEYS, LABEL, *INPUTS.columns))
    tagged = stratified_split(rows, LABEL, fx.KEYS, fx.SPLIT_SEED)
    return tagged.filter(F.col("split") == "train"), tagged.filter(F.col("split") == "validation")


def stored_inference(spark, sf_dir):
    """Inference rows with what models read, written once.

    Joins, cleaning and scoring in one stage make a method that is too long for the JVM to compile (8,000 bytes).
    """
    return stage(fx.inference(spark, sf_dir).select(*fx.KEYS, LABEL, *INPUTS.columns), "inference")


def inference_sides(spark, sf_dir):
    """Inference rows and their perturbed copy, from one writing."""
    rows = stored_inference(spark, sf_dir)
    return rows, perturb(rows, fx.KEYS, seed=fx.NOISE_SEED)


def rounded_metrics(df):
    return df.withColumns({m: rounded(F.col(m)) for m in METRICS})


@query("i1_boosted_trees")
def boosted_trees(spark, sf_dir):
    train, validation = split_training(spark, sf_dir)
    rows = stage(train)
    encoded = fit_features(rows, NUMERIC_INPUTS, CATEGORICAL_INPUTS)
    target = (F.col(LABEL) == POSITIVE).cast("double").alias("target")
    dealt = models.spread(rows.select(LABEL, *INPUTS.columns), [LABEL, *INPUTS.columns])
    fitted = models.boosted_trees().fit(encoded.transform(dealt).select(target, "features"))
    made = fitted.transform(encoded.transform(validation))
    return made.select("row_key", LABEL, (F.col("prediction") == 1.0).alias("predicted"))


@query("i2_fit_stages")
def fit_stages(spark, sf_dir):
    train, validation = split_training(spark, sf_dir)
    model = models.fit_stages(train, INPUTS)
    scored = models.score(model, validation.withColumn("dataset", F.lit("validation")))
    return metric_table(rounded_metrics(models.evaluate(scored, INPUTS)))


@query("i3_batch_scoring")
def batch_scoring(spark, sf_dir):
    train, _ = split_training(spark, sf_dir)
    model = models.fit_stages(train, INPUTS)
    scored = models.score(model, stored_inference(spark, sf_dir))
    return scored.select("row_key", LABEL, rounded(F.col("probability")).alias("probability"), "predicted")


@query("i4_save_and_load", fx.with_ctes(
    "SELECT count(*) AS n, CAST(0 AS BIGINT) AS different FROM inference", "inference"))
def save_and_load(spark, sf_dir):
    model = models.fit_stages(fx.training(spark, sf_dir), INPUTS)
    root = fresh_path(spark, "models")
    models.save_model(model, root, "income", 1)
    again = models.load_model(root, "income", 1)
    rows = stored_inference(spark, sf_dir).select("row_key", *INPUTS.columns)
    first = models.score(model, rows).select("*", F.col("probability").alias("before")).drop("probability", "predicted")
    both = models.score(again, stage(first, "first-scores"))
    return both.agg(F.count("*").alias("n"),
                    F.count_if(F.col("probability") != F.col("before")).alias("different"))


@query("i5_model_search")
def model_search(spark, sf_dir):
    """All candidates, without a time limit; the metrics of every run."""
    train, validation = split_training(spark, sf_dir)
    log, _ = models.search_models(train, validation, INPUTS, "search", budget_seconds=float("inf"))
    refined = runs.refine_runs(log.withColumn("params", F.map_filter("params", lambda k, v: k != "model")))
    names = log.select("run_id", F.col("params")["model"].alias("model"))
    return refined.join(names, "run_id").select(
        "experiment_id", "model", *[rounded(F.col(f"val_{m}"), 4).alias(f"val_{m}") for m in METRICS])


_FACTORIALS = "[1.0, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800]::DOUBLE[]"


def _mixed(feature: str, i: int) -> str:
    return f"CASE WHEN (s >> {i}) & 1 = 1 THEN e.{feature} ELSE b.{feature} END"


_POSITION = {f: i for i, f in enumerate(SUPPORTED)}
_SHAPLEY_SQL = f"""
, background AS (SELECT * FROM training ORDER BY md5('{fx.SAMPLE_SEED}|' || row_key), row_key LIMIT 500
), example AS (SELECT * FROM inference ORDER BY md5('1|' || row_key), row_key LIMIT 1
), mixed AS (
  SELECT e.row_key, s, (-2.2)::DOUBLE + 0.03::DOUBLE * {_mixed('hours_per_week', _POSITION['hours_per_week'])}
    + 0.1::DOUBLE * {_mixed('log_capital_gain', _POSITION['log_capital_gain'])}
    + CASE WHEN {_mixed('age_by_decade', _POSITION['age_by_decade'])} IN ('40s', '50s') THEN 0.5::DOUBLE ELSE 0.0 END AS odds
  FROM example e, background b, (SELECT unnest(range(0, 1024))::INTEGER AS s)
), worth AS (
  SELECT row_key, s, bit_count(s)::INTEGER AS k, ln(avg(p) / (1 - avg(p))) AS w
  FROM (SELECT row_key, s, round(1 / (1 + exp(-odds)), 6) AS p FROM mixed) GROUP BY row_key, s
), facts AS (SELECT {_FACTORIALS} AS f)
""" + " UNION ALL ".join(
    f"""SELECT row_key, '{name}' AS feature, round(sum(CASE WHEN (s >> {i}) & 1 = 1 THEN w * f[k] * f[11 - k] / f[11]
  ELSE -w * f[k + 1] * f[10 - k] / f[11] END), 6) + 0.0 AS "value" FROM worth, facts GROUP BY row_key"""
    for name, i in _POSITION.items()) + """
UNION ALL SELECT row_key, 'race', 0.0::DOUBLE FROM example"""


@query("i6_attribution", fx.with_ctes(_SHAPLEY_SQL, "training", "inference"))
def attribution(spark, sf_dir):
    columns = ["row_key", *SUPPORTED]
    background = fixed_sample(stage(fx.training(spark, sf_dir).select(*columns)), 500, fx.KEYS, fx.SAMPLE_SEED)
    example = fixed_sample(stage(fx.inference(spark, sf_dir).select(*columns)), 1, fx.KEYS, 1)
    values = shapley_values(example, background, SUPPORTED, fx.KEYS, fx.rule_score, silent=["race"])
    return values.withColumn("value", rounded(F.col("value")))


def _rule_metrics(spark, sf_dir, *datasets):
    rows = fx.scored(spark, sf_dir)
    if datasets:
        rows = rows.filter(F.col("dataset").isin(*datasets))
    return classification_metrics(rows, F.col(LABEL) == POSITIVE, F.col("predicted"), F.col("probability"))


@query("j1_classification_metrics", fx.with_ctes(f"""
SELECT dataset, {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)} FROM metrics""", "metrics"))
def metrics(spark, sf_dir):
    return rounded_metrics(_rule_metrics(spark, sf_dir))


@query("j2_metric_table", fx.with_ctes(f"""
SELECT {', '.join(f'round({m}, 6) AS {m}' for m in METRICS)}, dataset FROM metrics
WHERE dataset IN ('{fx.TRAINING}', '{fx.INFERENCE}')""", "metrics"))
def table_of_metrics(spark, sf_dir):
    return metric_table(rounded_metrics(_rule_metrics(spark, sf_dir, fx.TRAINING, fx.INFERENCE)))


@query("j3_refine_runs", fx.with_ctes("""
SELECT run_id, experiment_id, start_s AS started, end_s AS ended, round(val_accuracy_score, 5) AS val_accuracy_score,
  round(val_f1_score, 5) AS val_f1_score, round(val_log_loss, 5) AS val_log_loss,
  round(val_precision_score, 5) AS val_precision_score, round(val_recall_score, 5) AS val_recall_score,
  round(val_roc_auc_score, 5) AS val_roc_auc_score, max_depth, booster, "trainingDuration" FROM refined""", "refined"))
def refined_runs(spark, sf_dir):
    wide = runs.refine_runs(fx.run_log(spark, sf_dir))
    wide = wide.withColumns({c: rounded(F.col(c), 5) for c in wide.columns if c.startswith("val_")})
    return wide.select(
        F.unix_timestamp("start_time").alias("started"), F.unix_timestamp("end_time").alias("ended"), "*"
    ).drop("start_time", "end_time")

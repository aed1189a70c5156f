"""The model operators with a tree of one cut over the categories, which SQL can fit, score and measure exactly."""

from __future__ import annotations

import re

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import functions as F

from ..operators import models, runs
from ..operators.attribution import shapley_values
from ..operators.evaluate import METRICS, metric_table
from ..operators.features import fit_features
from ..operators.sampling import fixed_sample, undersample
from ..plans import monitor
from ..plans.prepare import CATEGORICAL_INPUTS, LABEL, POSITIVE, SUPPORTED
from ..runtime import rounded, stage
from . import fixtures as fx
from .book import query
from .model_queries import inference_sides, rounded_metrics, split_training, stored_inference
from .sample_queries import _ranked

INPUTS = models.Inputs((), CATEGORICAL_INPUTS, LABEL, POSITIVE, fx.KEYS)
_LIST = ", ".join(CATEGORICAL_INPUTS)
_ORDER = " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(CATEGORICAL_INPUTS))
_HIT = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in CATEGORICAL_INPUTS) + " END"


# Spark ML takes back a cut whose sides predict the same.
_SAME = "(p1 / n1 > 0.5) = ((p - p1) / (n - n1) > 0.5)"


def _gini(n: str, p: str) -> str:
    return f"2 * ({p} / {n}) * (1 - {p} / {n})"


def _fit(name: str, rows: str) -> str:
    """CTE ``name``: the cut of largest Gini gain and the share of positives on both sides of it."""
    return f"""
{name}_all AS (SELECT count(*)::DOUBLE AS n, (count(*) FILTER (income = '{POSITIVE}'))::DOUBLE AS p FROM {rows}),
{name}_cells AS (
  SELECT feature, v, count(*)::DOUBLE AS n1, (count(*) FILTER (income = '{POSITIVE}'))::DOUBLE AS p1
  FROM (UNPIVOT (SELECT income, {_LIST} FROM {rows}) ON {_LIST} INTO NAME feature VALUE v) GROUP BY feature, v),
{name} AS (
  SELECT feature, v, p / n AS base, CASE WHEN {_SAME} THEN p / n ELSE p1 / n1 END AS inside,
         CASE WHEN {_SAME} THEN p / n ELSE (p - p1) / (n - n1) END AS outside FROM {name}_cells, {name}_all WHERE n1 < n
  ORDER BY round({_gini('n', 'p')} - n1 / n * ({_gini('n1', 'p1')}) - (n - n1) / n * ({_gini('(n - n1)', '(p - p1)')}), 12) DESC,
           CASE feature {_ORDER} END, v LIMIT 1)"""


def _scored(model: str, rows: str, name: str) -> str:
    return f"""SELECT '{name}' AS dataset, row_key, income, CASE WHEN coalesce({_HIT} = v, false) THEN inside ELSE outside END AS probability,
  CASE WHEN coalesce({_HIT} = v, false) THEN inside ELSE outside END > 0.5 AS predicted FROM {rows}, {model}"""


_SPLIT = f"""
, tagged AS (
  SELECT *, place <= total * 8 // 10 AS trains
  FROM (SELECT *, {_ranked(fx.SPLIT_SEED)} AS place, count(*) OVER (PARTITION BY income) AS total FROM training))
, stump_train AS (SELECT * EXCLUDE (trains, place, total) FROM tagged WHERE trains)
, stump_validation AS (SELECT * EXCLUDE (trains, place, total) FROM tagged WHERE NOT trains)
, balanced AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY income ORDER BY md5('{fx.UNDERSAMPLE_SEED}|' || row_key), row_key) AS place FROM stump_train)
  WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM stump_train GROUP BY income)))
, {_fit('stump', 'stump_train')}, {_fit('even', 'balanced')}"""


def _metrics(source: str) -> str:
    """The metric CTEs of the fixed rule over ``source`` instead, with shares of 0 and 1 clipped."""
    text = re.sub(r"\b(metric_values|curve|counts|rates|metrics)\b", r"stump_\1", fx.CTES["metrics"][0])
    return re.sub(r"\bscored\b", source, text).replace(
        "-ln(CASE WHEN income = '>50k' THEN probability ELSE 1 - probability END)",
        "-ln(greatest(CASE WHEN income = '>50k' THEN probability ELSE 1 - probability END, 1e-15))")


_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in METRICS)


def _stump(**settings):
    return DecisionTreeClassifier(featuresCol="features", labelCol="target", maxDepth=1, **settings)


def _even_model(spark, sf_dir):
    train, validation = split_training(spark, sf_dir)
    return models.fit_stages(train, INPUTS, _stump()), validation


@query("i1_single_cut", fx.with_ctes(_SPLIT + ", made AS (" + _scored("stump", "stump_validation", "x") + """)
SELECT row_key, round(probability, 6) AS probability, predicted FROM made""", "training"))
def single_cut(spark, sf_dir):
    train, validation = split_training(spark, sf_dir)
    rows = stage(train)
    encoded = fit_features(rows, (), CATEGORICAL_INPUTS)
    target = (F.col(LABEL) == POSITIVE).cast("double").alias("target")
    dealt = models.spread(rows.select(LABEL, *INPUTS.columns), [LABEL, *INPUTS.columns])
    fitted = _stump().fit(encoded.transform(dealt).select(target, "features"))
    scored = models.score(models.PipelineModel(stages=[*encoded.stages, fitted]), validation)
    return scored.select("row_key", rounded(F.col("probability")).alias("probability"), "predicted")


@query("i2_single_cut_metrics", fx.with_ctes(_SPLIT + ", s AS (" + _scored("even", "stump_validation", "validation") + f"), {_metrics('s')} SELECT {_ROUNDED}, dataset FROM stump_metrics",
                                             "training"))
def single_cut_metrics(spark, sf_dir):
    model, validation = _even_model(spark, sf_dir)
    scored = models.score(model, validation.withColumn("dataset", F.lit("validation")))
    return metric_table(rounded_metrics(models.evaluate(scored, INPUTS)))


@query("i3_single_cut_scores", fx.with_ctes(_SPLIT + ", made AS (" + _scored("even", "inference", "x") + """)
SELECT row_key, income, round(probability, 6) AS probability, predicted FROM made""", "training", "inference"))
def single_cut_scores(spark, sf_dir):
    model, _ = _even_model(spark, sf_dir)
    scored = models.score(model, stored_inference(spark, sf_dir))
    return scored.select("row_key", LABEL, rounded(F.col("probability")).alias("probability"), "predicted")


def _candidates():
    return [("tree", _stump(), {"cut": "cut"}), ("tree", _stump(minInfoGain=1.0), {"cut": "none"})]


@query("i5_single_cut_search", fx.with_ctes(_SPLIT + ", s AS (" + _scored("even", "stump_validation", "cut") + f"""
UNION ALL SELECT 'none', row_key, income, base, base > 0.5 FROM stump_validation, even), {_metrics('s')}
SELECT 'search' AS experiment_id, dataset AS params_cut, {', '.join(f'round({m}, 4) AS val_{m}' for m in METRICS)},
       f1_score = max(f1_score) OVER () AND dataset = min(dataset) OVER (PARTITION BY f1_score) AS best FROM stump_metrics""", "training"))
def single_cut_search(spark, sf_dir):
    """A tree with a cut, one that may not cut, and which of them the search returns; classes are even."""
    train, validation = split_training(spark, sf_dir)
    train = undersample(train, LABEL, fx.KEYS, fx.UNDERSAMPLE_SEED)
    log, best = models.search_models(train, validation, INPUTS, "search", _candidates(), budget_seconds=float("inf"))
    chosen = "cut" if best.stages[-1].numNodes == 3 else "none"
    wide = log.select("run_id", F.col("params")["cut"].alias("params_cut")).join(
        runs.refine_runs(log.withColumn("params", F.map_filter("params", lambda k, v: F.lit(False)))), "run_id")
    return wide.select("experiment_id", "params_cut", *[rounded(F.col(f"val_{m}"), 4).alias(f"val_{m}") for m in METRICS],
                       (F.col("params_cut") == chosen).alias("best"))


def _rung(model: str, share: float) -> str:
    return _scored(model, "stump_validation", f"{share} cut") + f"""
UNION ALL SELECT '{share} none', row_key, income, base, base > 0.5 FROM stump_validation, {model}"""


# The quarter is drawn by the same hash as the rung's rows, and fitted and measured as the whole is.
_HALVING = _SPLIT + f"""
, quarter_rows AS (SELECT * FROM balanced WHERE substr(md5('{models.SPLIT_SEED}|' || row_key), 1, 8) < '{2**30:08x}')
, {_fit('quarter', 'quarter_rows')}
, s AS ({_rung('quarter', 0.25)} UNION ALL {_rung('even', 1.0)}), {_metrics('s')}
, trials AS (SELECT split_part(dataset, ' ', 1) AS params_share, split_part(dataset, ' ', 2) AS params_cut, * FROM stump_metrics)
SELECT 'search' AS experiment_id, params_share, params_cut, {', '.join(f'round({m}, 4) AS val_{m}' for m in METRICS)} FROM trials
WHERE params_share = '0.25' OR params_cut = (
  SELECT params_cut FROM trials WHERE params_share = '0.25' ORDER BY f1_score DESC, params_cut LIMIT 1)"""


@query("i5_halving_search", fx.with_ctes(_HALVING, "training"))
def halving_search(spark, sf_dir):
    """Both candidates on a quarter of the rows, the better one on all; classes are even."""
    train, validation = split_training(spark, sf_dir)
    train = undersample(train, LABEL, fx.KEYS, fx.UNDERSAMPLE_SEED)
    log, _ = models.halving_search(train, validation, INPUTS, "search", _candidates(), shares=(0.25, 1.0), budget_seconds=float("inf"))
    params = [F.col("params")[name].alias(f"params_{name}") for name in ("share", "cut")]
    return log.select("experiment_id", *params, *[rounded(F.col("metrics")[f"val_{m}"], 4).alias(f"val_{m}") for m in METRICS])


@query("k5_single_cut_history", fx.with_ctes(_SPLIT + ", s AS (" + " UNION ALL ".join(
    _scored("even", rows, name) for rows, name in (("stump_validation", fx.TRAINING), ("inference", fx.INFERENCE), ("modified", fx.MODIFIED))
) + f"), {_metrics('s')} SELECT {_ROUNDED}, dataset FROM stump_metrics", "training", "inference", "modified"))
def single_cut_history(spark, sf_dir):
    """Fit on the training rows, then score validation, inference and perturbed rows."""
    model, validation = _even_model(spark, sf_dir)
    columns = [*fx.KEYS, LABEL, *INPUTS.columns]
    new, changed = inference_sides(spark, sf_dir)
    parts = ((validation, fx.TRAINING), (new, fx.INFERENCE), (changed, fx.MODIFIED))
    tables = [metric_table(models.evaluate(models.score(model, rows.select(*columns, F.lit(name).alias("dataset"))), INPUTS)) for rows, name in parts]
    return rounded_metrics(monitor.metric_history(*tables))


@query("i6_model_attribution", fx.with_ctes(_SPLIT + f"""
, background AS (SELECT * FROM stump_train ORDER BY md5('{fx.SAMPLE_SEED}|' || row_key), row_key LIMIT 500)
, example AS (SELECT * FROM stump_validation ORDER BY md5('1|' || row_key), row_key LIMIT 1)
, worth AS (
  SELECT e.row_key, max(feature) AS feature,
    least(greatest(avg(p.probability), 1e-15), 1 - 1e-15) AS mean, least(greatest(max(q.probability), 1e-15), 1 - 1e-15) AS own
  FROM ({_scored('even', 'background', 'b')}) p, ({_scored('even', 'example', 'e')}) q, example e, even GROUP BY e.row_key)
SELECT row_key, f AS feature, CASE WHEN f = feature THEN round(ln(own / (1 - own)) - ln(mean / (1 - mean)), 6) + 0.0 ELSE 0.0 END AS "value"
FROM worth, (SELECT unnest([{', '.join(f"'{c}'" for c in (*SUPPORTED, 'race'))}]) AS f)""", "training"))
def model_attribution(spark, sf_dir):
    """Attribution of a fitted model: background from the training part, one example of the validation part."""
    train, validation = split_training(spark, sf_dir)
    model = models.fit_stages(train, INPUTS, _stump())
    background = fixed_sample(train.select("row_key", *SUPPORTED), 500, fx.KEYS, fx.SAMPLE_SEED)
    example = fixed_sample(validation.select("row_key", *SUPPORTED), 1, fx.KEYS, 1)
    values = shapley_values(example, background, SUPPORTED, fx.KEYS, lambda rows: models.score(model, rows), silent=["race"])
    return values.withColumn("value", rounded(F.col("value")))

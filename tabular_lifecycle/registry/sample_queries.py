"""Splits, samples and feature preparation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import features
from ..operators.sampling import fixed_sample, stratified_split, undersample
from ..plans.prepare import CATEGORICAL_INPUTS, NUMERIC_INPUTS
from ..runtime import rounded, stage
from . import fixtures as fx
from .book import query

# The cleaned categories of the generated tables, for the SQL side only.
_KNOWN = {
    "age_by_decade": ["20s", "30s", "40s", "50s", "60+", "teens"],
    "education": ["1-urgent", "2-high", "3-medium", "4-not-specified", "5-low"],
    "occupation": ["economy", "large", "medium", "promo", "small", "standard"],
    "relationship": ["a", "n", "r"],
    "workclass": ["automobile", "building", "furniture", "household", "machinery"],
    "native_country": sorted(f"nation_{i}" for i in range(25)),
}


def _ranked(seed: int, order: str = "row_key") -> str:
    return f"row_number() OVER (PARTITION BY income ORDER BY md5('{seed}|' || row_key), {order})"


_SPLIT_SQL = f"""
SELECT row_key, income, CASE WHEN place <= total * 8 // 10 THEN 'train' ELSE 'validation' END AS split
FROM (SELECT row_key, income, {_ranked(fx.SPLIT_SEED)} AS place, count(*) OVER (PARTITION BY income) AS total FROM training)"""


def _inputs(spark, sf_dir):
    return stage(fx.training(spark, sf_dir).select("row_key", "income", *NUMERIC_INPUTS, *CATEGORICAL_INPUTS))


@query("g1_stratified_split", fx.with_ctes(_SPLIT_SQL, "training"))
def split(spark, sf_dir):
    rows = stage(fx.training(spark, sf_dir).select("row_key", "income"))
    return stratified_split(rows, "income", fx.KEYS, fx.SPLIT_SEED)


@query("g2_undersample", fx.with_ctes(f"""
SELECT row_key, income FROM (
  SELECT row_key, income, {_ranked(fx.UNDERSAMPLE_SEED)} AS place FROM training)
WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM training GROUP BY income))""", "training"))
def undersampled(spark, sf_dir):
    rows = stage(fx.training(spark, sf_dir).select("row_key", "income"))
    return undersample(rows, "income", fx.KEYS, fx.UNDERSAMPLE_SEED)


@query("g3_fixed_sample", fx.with_ctes(f"""
SELECT row_key, income, fnlwgt FROM training ORDER BY md5('{fx.SAMPLE_SEED}|' || row_key), row_key LIMIT 500""", "training"))
def sample(spark, sf_dir):
    rows = stage(fx.training(spark, sf_dir).select("row_key", "income", "fnlwgt"))
    return fixed_sample(rows, 500, fx.KEYS, fx.SAMPLE_SEED)


_FILLED = ("education_num", "fnlwgt", "hours_per_week", "log_capital_gain", "log_capital_loss")


@query("h1_mean_imputation", fx.with_ctes("SELECT row_key, " + ", ".join(
    f"round(coalesce({c}, (SELECT avg({c}) FROM training)), 6) AS {c}" for c in _FILLED) + " FROM inference",
    "training", "inference"))
def mean_imputation(spark, sf_dir):
    means = features.fit_means(fx.training(spark, sf_dir), _FILLED)
    filled = features.fill_means(fx.inference(spark, sf_dir).select("row_key", *_FILLED), means)
    return filled.select("row_key", *[rounded(F.col(c)).alias(c) for c in _FILLED])


@query("h2_one_hot", fx.with_ctes("SELECT row_key, " + ", ".join(
    f"""CAST(coalesce({c} = '{v}', false) AS INTEGER) AS "{c}_{v}\"""" for c, values in _KNOWN.items() for v in values
) + " FROM inference", "inference"))
def one_hot(spark, sf_dir):
    categories = features.fit_categories(fx.training(spark, sf_dir), CATEGORICAL_INPUTS)
    wide = features.one_hot(fx.inference(spark, sf_dir).select("row_key", *CATEGORICAL_INPUTS), categories)
    return wide.drop(*CATEGORICAL_INPUTS)


@query("h3_compose_columns", fx.with_ctes("""
SELECT row_key, 54 AS width, round(log_capital_gain, 6) AS third,
       round(fnlwgt + hours_per_week + log_capital_gain + log_capital_loss + 6, 4) AS total FROM training""", "training"))
def compose_columns(spark, sf_dir):
    rows = _inputs(spark, sf_dir)
    stages = features.encoding_stages(rows, NUMERIC_INPUTS, CATEGORICAL_INPUTS)
    made = Pipeline(stages=stages).fit(rows).transform(rows).withColumn("cells", vector_to_array("assembled"))
    total = F.aggregate("cells", F.lit(0.0), lambda x, y: x + y)
    return made.select(
        "row_key", F.size("cells").alias("width"), rounded(F.col("cells")[2]).alias("third"),
        rounded(total, 4).alias("total"),
    )


_HOT_SQL = {f"{c}_{v}": f"CAST(coalesce({c} = '{v}', false) AS INTEGER)" for c, values in _KNOWN.items() for v in values}
_ENCODED_SQL = {**{c: c for c in NUMERIC_INPUTS}, **_HOT_SQL}


@query("h4_standardize", fx.with_ctes(", stats AS (SELECT " + ", ".join(
    f"""avg({x}) AS "mean_{i}", coalesce(nullif(stddev_pop({x}), 0), 1) AS "std_{i}\"""" for i, x in enumerate(_ENCODED_SQL.values())) +
    " FROM training) SELECT row_key, " + ", ".join(
    f"""round(({x} - "mean_{i}") / "std_{i}", 6) + 0.0 AS "{name}\"""" for i, (name, x) in enumerate(_ENCODED_SQL.items())) +
    " FROM inference, stats", "training", "inference"))
def standardize(spark, sf_dir):
    """All encoded features: the numbers and every one-hot column."""
    train = _inputs(spark, sf_dir)
    categories = features.fit_categories(train, CATEGORICAL_INPUTS)
    encoded = features.one_hot(train, categories)
    names = [*NUMERIC_INPUTS, *[c for c in encoded.columns if c not in train.columns]]
    scales = features.fit_scales(encoded, names)
    # Written once: with its joins and cleaning in the same stage, the generated method is too long for the JVM to compile.
    rows = stage(fx.inference(spark, sf_dir).select("row_key", *NUMERIC_INPUTS, *CATEGORICAL_INPUTS), "inference")
    scaled = features.standardize(features.one_hot(rows, categories), scales)
    return scaled.select("row_key", *[rounded(F.col(f"`{c}`")).alias(c) for c in names])

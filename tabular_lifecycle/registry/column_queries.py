"""Projection, filter, scalar functions and generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    age_band, case_label, clean_category, epoch_seconds, fixed_date, mean_rounded, merge_maps, on_date,
    row_noise, shifted_log, threshold_flag, to_float, to_number,
)
from ..operators import relational as rel
from ..operators import runs
from ..operators.drift import DRIFT_COLUMNS, columns_to_rows
from ..operators.evaluate import prefixed
from ..plans.prepare import CATEGORICAL, SUPPORTED, prepare
from ..runtime import rounded
from . import fixtures as fx
from .book import query

_TEN = """row_key, age_by_decade, fnlwgt, education, occupation, hours_per_week, relationship, workclass,
       round(log_capital_gain, 6) AS log_capital_gain, round(log_capital_loss, 6) AS log_capital_loss, native_country"""


@query("b1_project", fx.with_ctes("SELECT row_key, occupation, age FROM census", "census"))
def project(spark, sf_dir):
    return rel.project(fx.census(spark, sf_dir), ["row_key", "occupation", "age"])


@query("b2_select_supported", fx.with_ctes(f"SELECT {_TEN} FROM inference", "inference"))
def select_supported(spark, sf_dir):
    chosen = rel.select_supported(fx.inference(spark, sf_dir), ["row_key", *SUPPORTED])
    return chosen.withColumns({c: rounded(F.col(c)) for c in ("log_capital_gain", "log_capital_loss")})


@query("b3_drop_columns", fx.with_ctes("""
SELECT row_key, workclass, fnlwgt, education, education_num, marital_status, occupation, relationship,
       race, sex, hours_per_week, native_country, income FROM census""", "census"))
def drop_columns(spark, sf_dir):
    return rel.drop_columns(fx.census(spark, sf_dir), ["age", "capital_gain", "capital_loss", "o_orderdate"])


@query("b4_limit", fx.with_ctes("""
SELECT row_key, occupation, income, fnlwgt FROM training ORDER BY row_key, fnlwgt LIMIT 3""", "training"))
def limit(spark, sf_dir):
    rows = fx.training(spark, sf_dir).select("row_key", "occupation", "income", "fnlwgt")
    return rel.head(rows, 3, ["row_key", "fnlwgt"])


@query("b5_filter_not_equal", fx.with_ctes("""
SELECT run_id, "key", "value" FROM entries WHERE "key" <> 'model'""", "entries"))
def filter_not_equal(spark, sf_dir):
    entries = runs.explode_entries(fx.run_log(spark, sf_dir))
    return rel.exclude_value(entries, "key", "model").select("run_id", "key", "value")


@query("b6_filter_any_of", fx.with_ctes(f"""
SELECT row_key, dataset, round(probability, 6) AS probability FROM scored
WHERE dataset = '{fx.MODIFIED}' OR dataset = '{fx.INFERENCE}'""", "scored"))
def filter_any_of(spark, sf_dir):
    rows = rel.any_of(fx.scored(spark, sf_dir), "dataset", [fx.MODIFIED, fx.INFERENCE])
    return rows.select("row_key", "dataset", rounded(F.col("probability")).alias("probability"))


@query("b7_filter_date", """
SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-03-01'""")
def filter_date(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return orders.filter(on_date(F.col("o_orderdate"), "1998-03-01", timestamp=True)).select(
        "o_orderkey", "o_totalprice"
    )


@query("b8_case_label", fx.with_ctes(f"""
SELECT row_key, CASE WHEN dataset = '{fx.MODIFIED}' THEN '2010' ELSE '2000' END AS year FROM scored""", "scored"))
def label_case(spark, sf_dir):
    year = case_label(F.col("dataset"), {fx.MODIFIED: "2010"}, "2000")
    return fx.scored(spark, sf_dir).select("row_key", year.alias("year"))


@query("b9_literal_tag", """
SELECT o_orderkey, '2010' AS year, 'inference_income' AS dataset FROM orders""")
def literal_tag(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey")
    return rel.tag(orders, year="2010", dataset=fx.INFERENCE)


@query("b10_rename", fx.with_ctes("""
SELECT run_id, val_accuracy_score AS accuracy_score, val_f1_score AS f1_score, val_log_loss AS log_loss,
       val_precision_score AS precision_score, val_recall_score AS recall_score, val_roc_auc_score AS roc_auc_score FROM runs""", "runs"))
def rename(spark, sf_dir):
    log = fx.run_log(spark, sf_dir)
    names = ("accuracy_score", "f1_score", "log_loss", "precision_score", "recall_score", "roc_auc_score")
    plain = log.select("run_id", *[F.col("metrics")[f"val_{n}"].alias(n) for n in names])
    return rel.strip_tokens(prefixed(plain, "val_"), ["val_", "test_", "mod_"])


@query("b11_duration", fx.with_ctes("""
SELECT run_id, CAST(end_s - start_s AS INTEGER) AS "trainingDuration" FROM runs""", "runs"))
def duration(spark, sf_dir):
    return rel.add_duration(fx.run_log(spark, sf_dir), "start_time", "end_time").select("run_id", "trainingDuration")


@query("b12_drop_incomplete", fx.with_ctes(
    "SELECT row_key, education_num, age FROM census WHERE education_num IS NOT NULL", "census"))
def drop_incomplete(spark, sf_dir):
    return rel.drop_incomplete(fx.census(spark, sf_dir)).select("row_key", "education_num", "age")


@query("b13_separate_label", fx.with_ctes("""
SELECT 'features' AS side, 14 AS columns, count(*) AS n, round(sum(fnlwgt) + sum(hours_per_week) + sum(length(occupation)), 2) AS total
FROM prepared UNION ALL SELECT 'label', 1, count(*), sum(length(income))::DOUBLE FROM prepared""", "prepared"))
def separate_label(spark, sf_dir):
    rows = prepare(fx.census(spark, sf_dir)).drop("row_key", "o_orderdate")
    features, label = rel.separate_label(rows, "income")
    weights = F.sum("fnlwgt") + F.sum("hours_per_week") + F.sum(F.length("occupation"))
    sides = (("features", features, rounded(weights, 2)), ("label", label, F.sum(F.length("income")).cast("double")))
    totals = [side.agg(F.lit(name).alias("side"), F.lit(len(side.columns)).alias("columns"), F.count("*").alias("n"),
                       total.alias("total")) for name, side, total in sides]
    return totals[0].unionByName(totals[1])


@query("c1_clean_category", fx.with_ctes(
    f"SELECT row_key, {', '.join(CATEGORICAL)} FROM prepared", "prepared"))
def category_cleaner(spark, sf_dir):
    return fx.census(spark, sf_dir).select("row_key", *[clean_category(F.col(c)).alias(c) for c in CATEGORICAL])


@query("c2_age_band", fx.with_ctes("SELECT row_key, age_by_decade FROM prepared", "prepared"))
def band(spark, sf_dir):
    return fx.census(spark, sf_dir).select("row_key", age_band(F.col("age")).alias("age_by_decade"))


@query("c3_shifted_log", fx.with_ctes("""
SELECT row_key, round(log_capital_gain, 6) AS log_capital_gain, round(log_capital_loss, 6) AS log_capital_loss
FROM prepared""", "prepared"))
def log_shift(spark, sf_dir):
    return fx.census(spark, sf_dir).select(
        "row_key", rounded(shifted_log(F.col("capital_gain"))).alias("log_capital_gain"),
        rounded(shifted_log(F.col("capital_loss"))).alias("log_capital_loss"),
    )


@query("c4_round", """
SELECT l_suppkey, round(avg(l_quantity)) AS quantity, round(avg(l_extendedprice), 1) AS price
FROM lineitem GROUP BY l_suppkey""")
def round_means(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        mean_rounded(F.col("l_quantity")).alias("quantity"), mean_rounded(F.col("l_extendedprice"), 1).alias("price")
    )


@query("c5_to_float", fx.with_ctes("""
SELECT run_id, "key", round(CAST(try_cast("value" AS FLOAT) AS DOUBLE), 5) AS "value" FROM entries""", "entries"))
def cast_float(spark, sf_dir):
    entries = runs.explode_entries(fx.run_log(spark, sf_dir))
    return entries.select("run_id", "key", rounded(to_float(F.col("value")).cast("double"), 5).alias("value"))


@query("c6_epoch_seconds", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders")
def seconds(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", epoch_seconds(F.col("o_orderdate")).alias("seconds")
    )


@query("c7_to_number", """
SELECT o_orderkey, try_cast(substr(o_orderpriority, 1, 1) AS DOUBLE) AS level,
       try_cast(o_orderpriority AS DOUBLE) AS whole FROM orders""")
def coerce_number(spark, sf_dir):
    priority = F.col("o_orderpriority")
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", to_number(F.substring(priority, 1, 1)).alias("level"), to_number(priority).alias("whole")
    )


@query("c8_merge_maps", fx.with_ctes("""
SELECT run_id, string_agg("key" || '=' || "value", ';' ORDER BY "key") AS merged FROM entries GROUP BY run_id""",
                                     "entries"))
def map_merge(spark, sf_dir):
    merged = F.map_entries(merge_maps(F.col("metrics"), F.col("params")))
    text = F.transform(F.array_sort(merged), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return fx.run_log(spark, sf_dir).select("run_id", F.array_join(text, ";").alias("merged"))


@query("c9_fixed_date", """
SELECT o_orderkey, datediff('day', DATE '2000-01-01', CAST(o_orderdate AS DATE))::INTEGER AS days,
       '2010-01-01' AS simulated FROM orders""")
def date_literal(spark, sf_dir):
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_diff("o_orderdate", fixed_date("2000-01-01")).alias("days"),
        fixed_date("2010-01-01").cast("string").alias("simulated"),
    )


@query("c10_threshold_flag", """
SELECT l_orderkey, l_linenumber, l_tax, CASE WHEN l_tax < 0.05 THEN 0 ELSE 1 END AS passed FROM lineitem""")
def flag(spark, sf_dir):
    return fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax", threshold_flag(F.col("l_tax"), 0.05).alias("passed")
    )


@query("c11_row_noise", fx.with_ctes(
    "SELECT row_key, CAST('0x' || substr(md5('2010|' || row_key), 1, 8) AS BIGINT) % 21 AS noise FROM census",
    "census"))
def noise(spark, sf_dir):
    return fx.census(spark, sf_dir).select("row_key", row_noise(fx.KEYS, fx.NOISE_SEED).alias("noise"))


@query("c12_explode_map", fx.with_ctes(
    'SELECT run_id, experiment_id, "key", "value" FROM entries', "entries"))
def explode_map(spark, sf_dir):
    return runs.explode_entries(fx.run_log(spark, sf_dir)).drop("start_time", "end_time")


@query("c13_columns_to_rows", fx.with_ctes("""
SELECT "column", count("value") AS n, round(sum("value"), 2) AS total, round(max("value"), 6) AS largest
FROM (SELECT fnlwgt, hours_per_week, log_capital_gain, log_capital_loss FROM inference)
UNPIVOT INCLUDE NULLS ("value" FOR "column" IN (fnlwgt, hours_per_week, log_capital_gain, log_capital_loss))
GROUP BY "column\"""", "inference"))
def rows_of_columns(spark, sf_dir):
    return columns_to_rows(fx.inference(spark, sf_dir), DRIFT_COLUMNS).groupBy("column").agg(
        F.count("value").alias("n"), rounded(F.sum("value"), 2).alias("total"),
        rounded(F.max("value")).alias("largest"),
    )

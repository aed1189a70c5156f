"""Sources, sinks and catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..runtime import fresh_path, rounded
from ..sources import CENSUS_COLUMNS, local_rows, read_csv, read_parquet, read_run_log, read_table
from . import fixtures as fx
from .book import query


def _database(spark: SparkSession) -> str:
    """A database of its own inside the shared folder."""
    name = f"lifecycle_{uuid.uuid4().hex[:12]}"
    sinks.create_database(spark, name, fresh_path(spark, name))
    return name


def _nation_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals per nation, the small table that the write queries store."""
    rows = (
        fx.table(spark, sf_dir, "orders")
        .join(fx.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(fx.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return rows.groupBy(F.col("n_name").alias("nation")).agg(
        F.count("*").alias("orders"), rounded(F.sum("o_totalprice"), 2).alias("total")
    )


_NATION_SQL = """
  SELECT n_name AS nation, count(*) AS orders, round(sum(o_totalprice), 2) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"""


@query("a1_csv_scan", fx.with_ctes("""
SELECT occupation, count(*) AS n, count(education_num) AS with_education, sum(age)::BIGINT AS ages,
       round(sum(capital_gain), 2) AS gains, round(sum(hours_per_week), 2) AS hours,
       count(*) FILTER (workclass LIKE ' %.') AS blank_kept, count(*) FILTER (income = ' >50K.') AS high
FROM census GROUP BY occupation""", "census"))
def csv_scan(spark, sf_dir):
    path = fresh_path(spark, "census-csv")
    raw = fx.census(spark, sf_dir).select(*CENSUS_COLUMNS)
    raw.write.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path).groupBy("occupation").agg(
        F.count("*").alias("n"), F.count("education_num").alias("with_education"),
        F.sum("age").alias("ages"), rounded(F.sum("capital_gain"), 2).alias("gains"),
        rounded(F.sum("hours_per_week"), 2).alias("hours"),
        F.count_if(F.col("workclass").like(" %.")).alias("blank_kept"),
        F.count_if(F.col("income") == " >50K.").alias("high"),
    )


@query("a2_table_scan", "SELECT p_partkey, p_type, p_size, p_retailprice FROM part")
def table_scan(spark, sf_dir):
    name = f"{_database(spark)}.parts"
    sinks.create_external_table(spark, name, f"{sf_dir}/part.parquet")
    return read_table(spark, name).select("p_partkey", "p_type", "p_size", "p_retailprice")


@query("a3_parquet_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def parquet_scan(spark, sf_dir):
    return read_parquet(spark, f"{sf_dir}/customer.parquet")


@query("a4_run_log_scan", fx.with_ctes("""
SELECT run_id, experiment_id, val_f1_score AS f1, model, start_s AS started, end_s AS ended
FROM runs WHERE experiment_id = 'ASIA'""", "runs"))
def run_log_scan(spark, sf_dir):
    path = sinks.overwrite_path(fx.run_log(spark, sf_dir), fresh_path(spark, "run-log"))
    return read_run_log(spark, path, "ASIA").select(
        "run_id", "experiment_id", F.col("metrics")["val_f1_score"].alias("f1"),
        F.col("params")["model"].alias("model"),
        F.unix_timestamp("start_time").alias("started"), F.unix_timestamp("end_time").alias("ended"),
    )


@query("a5_local_rows", """
SELECT 'customer' AS dataset, count(*) AS customers, round(sum(c_acctbal), 2) AS balance, round(avg(c_acctbal), 6) AS mean FROM customer""")
def driver_rows(spark, sf_dir):
    # A metric dictionary, one row by its making, becomes a table again.
    row = fx.table(spark, sf_dir, "customer").agg(
        F.count("*").alias("n"), rounded(F.sum("c_acctbal"), 2).alias("balance"), rounded(F.avg("c_acctbal")).alias("mean")).first()
    return local_rows(
        spark, [("customer", row["n"], row["balance"], row["mean"])],
        "dataset string, customers bigint, balance double, mean double",
    )


@query("a6_overwrite_path", _NATION_SQL)
def overwrite_path(spark, sf_dir):
    path = fresh_path(spark, "nation-sums")
    sums = _nation_sums(spark, sf_dir)
    sinks.overwrite_path(sums.withColumn("total", F.lit(0.0)), path)
    sinks.overwrite_path(sums, path)
    return spark.read.parquet(path)


@query("a7_overwrite_table", _NATION_SQL)
def overwrite_table(spark, sf_dir):
    name = f"{_database(spark)}.sums"
    sums = _nation_sums(spark, sf_dir)
    sinks.overwrite_table(sums.select("nation"), name)
    sinks.overwrite_table(sums, name)
    return read_table(spark, name)


@query("a8_append_table", f"""
WITH sums AS ({_NATION_SQL})
SELECT nation, orders, total, 'first' AS batch FROM sums
UNION ALL SELECT nation, orders, total, 'second' FROM sums""")
def append_table(spark, sf_dir):
    name = f"{_database(spark)}.history"
    sums = _nation_sums(spark, sf_dir)
    sinks.append_table(sums.withColumn("batch", F.lit("first")), name)
    # The second batch has its columns in another order: they match by name.
    sinks.append_table(sums.select(F.lit("second").alias("batch"), "total", "orders", "nation"), name)
    return read_table(spark, name).select("nation", "orders", "total", "batch")


@query("a9_schema_merge", f"""
WITH sums AS ({_NATION_SQL})
SELECT nation, orders, CAST(NULL AS DOUBLE) AS total FROM sums
UNION ALL SELECT nation, CAST(NULL AS BIGINT), total FROM sums""")
def schema_merge(spark, sf_dir):
    name = f"{_database(spark)}.merged"
    sums = _nation_sums(spark, sf_dir)
    sinks.merge_append_table(sums.select("nation", "orders"), name)
    sinks.merge_append_table(sums.select("nation", "total"), name)
    return read_table(spark, name).select("nation", "orders", "total")


@query("a10_external_table", _NATION_SQL)
def external_table(spark, sf_dir):
    path = sinks.overwrite_path(_nation_sums(spark, sf_dir), fresh_path(spark, "nation-sums"))
    name = f"{_database(spark)}.outside"
    sinks.create_external_table(spark, name, path)
    return spark.sql(f"SELECT nation, orders, total FROM {name}")


@query("a11_database_lifecycle", f"""
WITH sums AS ({_NATION_SQL})
SELECT 'kept' AS table_name, count(*) AS row_count, sum(orders)::BIGINT AS orders FROM sums""")
def database_lifecycle(spark, sf_dir):
    """Create, fill, drop with everything inside, create anew; what is left holds the second fill."""
    sums = _nation_sums(spark, sf_dir)
    name = _database(spark)
    sinks.overwrite_table(sums.limit(0), f"{name}.kept")
    sinks.drop_database(spark, name)
    sinks.create_database(spark, name, fresh_path(spark, name))
    sinks.overwrite_table(sums, f"{name}.kept")
    sinks.overwrite_table(sums, f"{name}.dropped")
    sinks.drop_table(spark, f"{name}.dropped")
    left = [t.name for t in spark.catalog.listTables(name) if not t.isTemporary]
    return read_table(spark, f"{name}.kept").agg(
        F.count("*").alias("row_count"), F.sum("orders").alias("orders")
    ).select(F.lit(",".join(left)).alias("table_name"), "row_count", "orders")

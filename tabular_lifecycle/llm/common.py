"""Small helpers shared by the operators: text expressions, row keys, the documents table, link components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import drop_stage, stage

# White space of the contracts, [\x20\x09-\x0D], as literal characters and inside a regular expression.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"\x20\x09-\x0D"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name ``df`` does not have (names clash without regard to case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower()))


def words(text: Column) -> Column:
    """Words between white space; none for a null or blank text."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare != "", F.split(bare, f"[{SPACE_CLASS}]+")).otherwise(F.array().cast("array<string>"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def hex_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, root), root the smallest node.

    Alternates large and small star steps: every node points its larger neighbours, then its smaller ones, at the
    smallest node known around it. Minima are pre-aggregated before the shuffle, so a node with very many
    neighbours is not one task; each round is a written table, which goes when the next one is written. Ends when a round
    changes no edge.
    """
    spark = edges.sparkSession
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    print_of = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    seen = current.agg(print_of.alias("p")).first().p
    while seen.n:
        both = current.union(current.select("b", "a"))
        near = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = (both.join(near, both.a == near.u).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = stage(large, "links")
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        moved = large.join(low, large.a == low.u)
        small = (moved.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                 .union(low.select("u", "m")).distinct())
        last, current = current, stage(small, "links")
        drop_stage(last)
        drop_stage(large)
        now = current.agg(print_of.alias("p")).first().p
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select("root", "root").distinct()) if seen.n else \
        spark.createDataFrame([], roots.schema)

"""From raw documents to token ids: quality rules, line dedup, near duplicates, source mix, byte-pair encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabular_lifecycle.llm import bpe, line_dedup, mixing, ngram_join, quality_rules
from tabular_lifecycle.runtime import stage


_OWN = ("doc_id", "text", "lang", "source", "n_chars")


def extras_apart(stage_function):
    """Columns beyond those of documents pass through under names of their own, so that none clashes with an operator's."""
    @functools.wraps(stage_function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        extras = {c: f"_extra_{i}" for i, c in enumerate(c for c in docs.columns if c.lower() not in _OWN)}
        out = stage_function(spark, docs.select(*[F.col(c).alias(extras.get(c, c)) for c in docs.columns]), sf_dir)
        return out.select(*[F.col(extras.get(c, c)).alias(c) for c in docs.columns])

    return run_stage


@extras_apart
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null, empty and short texts are rejected; repeated rows stay or go together."""
    return quality_rules.cascade(docs).where("kept")


@extras_apart
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that three or more documents hold, but for the last holder; n_chars follows the text.

    A null text stays null, and an empty table empty; a document may become empty, and stays. Very long texts are cut whole.
    """
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))


@extras_apart
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group linked by five-word shingles at a similarity of 0.8.

    Null and blank texts and null ids stay; copies under one id stay together; of one id with two texts only a linked one goes.
    """
    return ngram_join.keep_one(docs, width=5, above=80, of=100)


@extras_apart
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those it takes more than once are rows of their own.

    A null source is a source; documents without words have size 0 and are taken by whole passes only.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "source")]
    mixed = mixing.mix(docs, keep=tuple(others)).where("passes > 0")
    return mixed.withColumn("_pass", F.explode(F.sequence(F.lit(1), F.col("passes"))))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document instead of its text; null and empty texts have none.

    A column named ids or n_tokens is replaced; others pass through."""
    ids = bpe.encode(docs, bpe.read_vocabulary(bpe.vocabulary_path()))
    return ids.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near duplicates", near_duplicates), ("source mix", mix), ("bpe", tokens)]

# The knapsack of the mix and the merges of the encoding have no SQL; tests compare the run with a brute-force one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

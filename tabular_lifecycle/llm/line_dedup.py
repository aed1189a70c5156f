"""Line dedup: lines that many documents hold stay in one of them only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, fresh, lower_ascii

_SALTS = 4


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, text: str = "text",
                doc_id: str = "doc_id") -> DataFrame:
    """Drop lines whose key at least ``min_docs`` documents hold, except in the largest ``doc_id`` holding it.

    A key is the line stripped of white space, A-Z lower-cased, of at least ``min_chars`` code points. Lines are
    exploded and hashed (128 bits), documents are counted per hash with partial sums, the lost positions are joined
    to their documents, and what stays is put together by position. Lines meet the table of widely
    held ones salted, so a line that a third of the rows hold is not one task. Only hashes and positions are shuffled twice;
    texts meet their lost positions in one join on the document.

    Returns all columns of ``docs`` with the new text, and ``n_lines`` (before) and ``n_dropped``.
    Null or empty text: one empty line, kept as it is. Null ids: together one document, below all others. Repeated
    rows: one document, each of them is rewritten. Empty table: empty result. Existing columns named ``n_lines`` or
    ``n_dropped`` are replaced.
    """
    base = docs.drop("n_lines", "n_dropped")
    lines_, at, gone, d, p = (fresh(base, name) for name in ("_lines", "_print", "_gone", "_of", "_as"))
    keyed = (base.where(F.length(text) >= min_chars)
             .select(F.col(doc_id).alias("d"), F.xxhash64(text).alias("p"),
                     F.posexplode(F.split(text, "\n", -1)).alias("at", "line"))
             .withColumn("key", F.btrim("line", F.lit(SPACE))).where(F.length("key") >= min_chars)
             .withColumn("key", lower_ascii(F.col("key")))
             .select("d", "p", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), F.reverse("key")).alias("h2")))
    spread = (keyed.groupBy("h1", "h2", "d").agg(F.lit(1).alias("one"))
              .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("d").alias("keeper"))
              .where(F.col("n") >= min_docs).drop("n"))
    # A line that very many documents hold meets its keeper in several parts, dealt by document.
    spread = spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    lost = (keyed.withColumn("salt", F.pmod("p", F.lit(_SALTS)).cast("int")).join(spread, ["h1", "h2", "salt"]).where(~F.col("d").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("d").alias(d), F.col("p").alias(p)).agg(F.collect_set("at").alias(gone)))
    whole = base.select("*", F.split(F.coalesce(text, F.lit("")), "\n", -1).alias(lines_), F.xxhash64(text).alias(at))
    joined = whole.join(lost, whole[doc_id].eqNullSafe(lost[d]) & (whole[at] == lost[p]), "left")
    kept = F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines_) - 1), gone), lambda i: F.get(F.col(lines_), i)), "\n")
    return joined.select(
        *[F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept).alias(text) if c == text else whole[c]
          for c in base.columns],
        F.size(lines_).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"))

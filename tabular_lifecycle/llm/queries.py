"""The registered queries of the operators: production parameters over whole tables, results as the contract has them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, hard_negatives, html_extract, line_dedup, lm_score, mixing, ngram_join, pii, quality_rules, secret_scan, sharding, token_align, topk_search
from .common import hex_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


_LINES = """
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM {docs}),
keyed AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
wide AS (SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT k.doc_id, k.pos, k.line, w.key IS NOT NULL AND k.doc_id <> w.keeper AS gone
           FROM keyed k LEFT JOIN wide w ON k.key = w.key)
"""


@query("op1_line_dedup", _LINES.format(docs="documents") + """
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""")
def op1(spark, sf_dir):
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", hex_of(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


@query("op5_kd_shards")
def op5(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query("op6_secret_scan")
def op6(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", hex_of(secret_scan.span_text(F.col("base"))).alias("base_sha256"),
                        secret_scan.span_text(F.col("found")).alias("spans"), "n_live", "n_copied")


@query("op9_pii_surrogates")
def op9(spark, sf_dir):
    return pii.replace_pii(table(spark, sf_dir, "documents"), key="surrogates").select("doc_id", "n_entities", "text")


_COUNTS = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM twice, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, len(l) AS n_lines FROM d LEFT JOIN r ON d.doc_id = r.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 4 * n_symbols > n_words
            OR 2 * n_dup_lines > n_lines) AS kept FROM b"""


@query("op10_quality_rules", _COUNTS)
def op10(spark, sf_dir):
    judged = quality_rules.cascade(table(spark, sf_dir, "documents"), keep_counts=True)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op2_ngram_jaccard", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)
      UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM w WHERE len(w) BETWEEN 1 AND 2),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN n na ON p.a = na.doc_id JOIN n nb ON p.b = nb.doc_id WHERE 100 * i >= 90 * (na.n + nb.n - i)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.low, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) m ON w.doc_id = m.a""")
def op2(spark, sf_dir):
    linked = ngram_join.link_classes(table(spark, sf_dir, "documents"), width=3, above=90, of=100)
    return linked.select(F.col("d").alias("doc_id"), "n_shingles", "component_id")


@query("op4_bpe")
def op4(spark, sf_dir):
    vocabulary = bpe.read_vocabulary(bpe.vocabulary_path())
    tokens = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary)
    back = bpe.decode(tokens, vocabulary, digest="ids_sha256")
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids_sha256", hex_of(F.col("text")).alias("decoded_sha256"))


@query("op3_top_k", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5""")
def op3(spark, sf_dir):
    found = topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", "rank", "vec_id", "score")


@query("op7_source_mix")
def op7(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


@query("op8_lm_score")
def op8(spark, sf_dir):
    held_out = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "utf-8")) % 7 == 2
    return lm_score.score(table(spark, sf_dir, "documents"), held_out)


@query("op13_hard_negatives", """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS a, c.vec_id AS c, q.label = c.label AS same, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
p AS (SELECT a, c AS p, score AS ps FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, c) <= 5)
SELECT p.a AS anchor_id, p.p AS positive_id, row_number() OVER (PARTITION BY p.a, p.p ORDER BY s.score DESC, s.c)::INTEGER AS rank,
       s.c AS negative_id, p.ps AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.ps <= 100 * s.score AND s.score <= p.ps QUALIFY rank <= 5""")
def op13(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


@query("op12_token_align")
def op12(spark, sf_dir):
    out = token_align.align(table(spark, sf_dir, "documents"), *token_align.read_models())
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op11_html_extract", r"""
WITH a AS (SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1), '<(/?(h1|p)|br)>', ' ', 'g') AS a FROM pages),
t AS (SELECT page_id, url, regexp_replace(replace(regexp_replace(a, '</?b>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g') AS t FROM a),
b AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM t)
SELECT page_id, url, text, length(text) AS n_chars FROM b""")
def op11(spark, sf_dir):
    out = html_extract.extract(table(spark, sf_dir, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

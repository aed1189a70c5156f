"""Sharding by a k-d tree over metadata, cut at weighted medians until the leaves have the target bytes."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import stage
from .common import fresh, let

_BINS = 4096
_TIE_BITS = 31


@dataclass(frozen=True)
class Cut:
    """A row whose key along dimension ``axis`` is at least ``key`` goes right."""

    axis: int
    key: int


@dataclass(frozen=True)
class Tree:
    """``levels[l][n]`` is the cut of node n at level l (None below a leaf); ``first[l]`` the first shard of each node."""

    axes: tuple[Column, ...]
    levels: tuple[tuple[Cut | None, ...], ...]
    first: tuple[int, ...]

    def keys(self) -> Column:
        return F.array(*self.axes)

    def shard(self, keys: Column) -> Column:
        """The row's shard by its ``keys`` (a plain column): one comparison for each level."""
        def descend(node: Column, level: int) -> Column:
            if level == len(self.levels):
                return F.get(F.array(*[F.lit(x) for x in self.first]), node)
            return let(below(self.levels[level], keys, node), lambda child: descend(child, level + 1))

        return descend(F.lit(0), 0)


def below(cuts: tuple[Cut | None, ...], keys: Column, node: Column) -> Column:
    """The child of ``node`` that a row falls into: twice the node's number, plus one on the right."""
    axis = F.array(*[F.lit(c.axis if c else 0) for c in cuts])
    key = F.array(*[F.lit(c.key if c else 2**63 - 1).cast("long") for c in cuts])
    return 2 * node + (F.get(keys, F.get(axis, node)) >= F.get(key, node)).cast("int")


def number_texts(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` with each text of ``columns`` replaced by its place among the column's distinct texts, null as the empty text.

    Distinct texts are sorted over range partitions; what lies before a partition is one number for each of them.
    """
    for c in columns:
        texts = rows.select(F.coalesce(F.col(c), F.lit("")).alias("_text")).distinct()
        held = stage(texts.repartitionByRange("_text").sortWithinPartitions("_text")
                     .withColumn("_id", F.monotonically_increasing_id()), "texts")
        part = F.shiftright("_id", 33)
        counts = held.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
        starts = counts.selectExpr("_part", "sum(_n) OVER (ORDER BY _part) - _n AS _start")
        numbers = held.withColumn("_part", part).join(starts, "_part").select(
            "_text", (F.col("_start") + F.col("_id").bitwiseAND(F.lit(2**33 - 1))).alias("_number"))
        joined = rows.join(numbers, F.coalesce(rows[c], F.lit("")) == F.col("_text"))
        rows = joined.select(*[F.col("_number").alias(c) if x == c else rows[x] for x in rows.columns])
    return rows


def _axis(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DateType, T.TimestampType)):
        return F.unix_timestamp(c.cast("timestamp")).cast("double")
    number = c.cast("double")
    return F.coalesce(F.when(F.isnan(number), None).otherwise(number), F.lit(0.0))


def fit_tree(rows: DataFrame, size: str, shards: int, dimensions: list[str], identity: list[str],
             tolerance: float = 0.002) -> Tree:
    """Cut ``rows`` into ``shards`` leaves of near equal total ``size``; text dimensions come numbered (``number_texts``).

    A node of k leaves is cut at the weighted quantile floor(k/2)/k along its widest dimension: the one along which
    the node spans the largest part of the whole table's range. All nodes of a level are cut together. A cut is found
    by counting bytes in bins of the key range and then in bins of the bin that holds the quantile, until what is left
    is under ``tolerance`` of a leaf; only (node, bin) sums and one row per node leave the executors. Equal values
    are told apart by a hash of ``identity``, so a value that a third of the rows share can be cut too.
    """
    raw = [_axis(rows, d) for d in dimensions]
    edges = rows.agg(*[F.min(c).alias(f"l{i}") for i, c in enumerate(raw)],
                     *[F.max(c).alias(f"h{i}") for i, c in enumerate(raw)], F.sum(size).alias("all")).first()
    tie = F.pmod(F.xxhash64(*identity), F.lit(2**_TIE_BITS))
    axes = []
    for i, c in enumerate(raw):
        low, high = edges[f"l{i}"] or 0.0, edges[f"h{i}"] or 0.0
        steps = (c - low) / F.lit((high - low) or 1.0) * F.lit(float(2**_TIE_BITS - 1))
        axes.append(F.shiftleft(F.floor(steps).cast("long"), _TIE_BITS) + tie)
    leaf = (edges["all"] or 0) / shards
    tree = Tree(tuple(axes), (), (0,))
    leaves = [shards]
    placed = stage(rows.select(tree.keys().alias("k"), F.col(size).alias("s"), F.lit(0).alias("n")), "keys")
    while max(leaves) > 1:
        spans = {r.n: r for r in placed.groupBy("n").agg(
            F.sum("s").alias("all"),
            *[F.min(F.get("k", F.lit(i))).alias(f"l{i}") for i in range(len(axes))],
            *[F.max(F.get("k", F.lit(i))).alias(f"h{i}") for i in range(len(axes))]).collect()}
        cuts: list[Cut | None] = [None] * len(leaves)
        open_: dict[int, list] = {}
        for n, k in enumerate(leaves):
            if k > 1 and n in spans:
                r = spans[n]
                axis = max(range(len(axes)), key=lambda i: (r[f"h{i}"] - r[f"l{i}"], -i))
                open_[n] = [axis, r[f"l{axis}"], r[f"h{axis}"] + 1, r["all"] * (k // 2) / k]
            elif k > 1:
                cuts[n] = Cut(0, 0)
        while open_:
            table = [open_.get(n, [0, 0, 1, 0]) for n in range(len(leaves))]
            axis, low, high = (F.get(F.array(*[F.lit(t[i]).cast("long") for t in table]), F.col("n")) for i in range(3))
            step = F.get(F.array(*[F.lit(max(1, -(-(t[2] - t[1]) // _BINS))).cast("long") for t in table]), F.col("n"))
            key = F.get(F.col("k"), axis.cast("int"))
            bins = (placed.where(F.col("n").isin(list(open_)) & (key >= low) & (key < high))
                    .groupBy("n", F.floor((key - low) / step).cast("int").alias("b"))
                    .agg(F.sum("s").alias("s")).groupBy("n").agg(F.sort_array(F.collect_list(F.struct("b", "s"))).alias("bins")))
            for r in bins.collect():
                n, (ax, lo, hi, want) = r.n, open_[r.n]
                width, before = max(1, -(-(hi - lo) // _BINS)), 0
                for b, s in r.bins:
                    if before + s > want or (b, s) == tuple(r.bins[-1]):
                        break
                    before += s
                at, end = lo + b * width, min(hi, lo + (b + 1) * width)
                if s <= tolerance * leaf or width == 1:
                    cuts[n] = Cut(ax, end if want - before > before + s - want else at)
                    del open_[n]
                else:
                    open_[n] = [ax, at, end, want - before]
        tree = Tree(tree.axes, (*tree.levels, tuple(cuts)), ())
        placed = stage(placed.withColumn("n", below(tuple(cuts), F.col("k"), F.col("n"))), "keys")
        leaves = [x for k in leaves for x in ((k // 2, k - k // 2) if k > 1 else (k, 0))]
    first, total = [], 0
    for k in leaves:
        first.append(total)
        total += k
    return Tree(tree.axes, tree.levels, tuple(first))


def number_slots(rows: DataFrame, shard: str, order: list[str], rows_per_bucket: int = 100_000) -> DataFrame:
    """``rows`` with ``slot``, numbered from 0 without gaps inside each shard.

    Rows of a shard are dealt over hash buckets; a row's slot is what lies in its shard's earlier buckets plus its
    place in its own, so no task sorts a whole shard. The number of buckets grows with the table.
    """
    b = fresh(rows, "_bucket")
    buckets = max(16, math.ceil(rows.count() / rows_per_bucket))
    dealt = rows.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(shard, b).agg(F.count("*").alias("_n"))
    before = counts.selectExpr(f"{shard} AS _s", f"{b} AS _b",
                               f"sum(_n) OVER (PARTITION BY {shard} ORDER BY {b}) - _n AS _before")
    own = F.expr(f"row_number() OVER (PARTITION BY {shard}, {b} ORDER BY {', '.join(order)}) - 1")
    numbered = dealt.withColumn("_own", own)
    return (numbered.join(before, (numbered[shard] == before["_s"]) & (numbered[b] == before["_b"]))
            .withColumn("slot", F.col("_before") + F.col("_own")).drop("_s", "_b", "_before", "_own", b))


def shard(docs: DataFrame, shards: int = 40, dimensions: tuple[str, ...] = ("source", "lang", "n_chars", "doc_id"),
          text: str = "text", doc_id: str = "doc_id", overhead: int = 16) -> DataFrame:
    """Every document's place: doc_id, size, text_crc32, shard, slot.

    The tree is fitted on staged keys (four numbers a row); documents are read once, for size and checksum, and
    never shuffled. ``fit_tree`` and ``Tree.shard`` give the same shard to full rows with the same numbers, to write them out.
    A text dimension (a source, a language) counts by its place among its distinct values, however alike they begin.

    Null text: size ``overhead``, checksum of the empty text. Null metadata count as the smallest value. Repeated
    rows lie side by side; equal texts under different ids may part, as the law is equal bytes. Empty table: empty
    result. Other columns are left out, so none can clash. Fewer rows than shards leave shards empty.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    names = [f"m{i}" for i in range(len(dimensions))]
    rows = stage(docs.select(
        F.col(doc_id).alias("id"), (F.octet_length(value) + overhead).cast("long").alias("size"),
        F.crc32(F.encode(value, "utf-8")).cast("long").alias("text_crc32"),
        *[F.col(d).alias(m) for d, m in zip(dimensions, names)]), "sizes")
    texts = [m for m in names if isinstance(rows.schema[m].dataType, T.StringType)]
    rows = stage(number_texts(rows, texts), "numbered") if texts else rows
    tree = fit_tree(rows, "size", shards, names, ["id", "text_crc32", "size"])
    placed = (rows.select("id", "size", "text_crc32", tree.keys().alias("keys"))
              .select("id", "size", "text_crc32", tree.shard(F.col("keys")).alias("shard")))
    return number_slots(placed, "shard", ["id", "text_crc32", "size"]).withColumnRenamed("id", doc_id).select(
        doc_id, "size", "text_crc32", "shard", "slot")

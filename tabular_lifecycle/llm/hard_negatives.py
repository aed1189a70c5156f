"""Hard negatives by a secondary sort: packed (anchor, descending score, id) keys, read once by a streaming iterator."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import stage

CELLS = 1 << 22
_LOW, _HIGH = -(2**63), 2**63 - 1
_KEY = np.dtype([("anchor", ">u8"), ("anchor_row", ">u8"), ("falling", ">u8"), ("negative", "u1"), ("no_id", "u1"),
                 ("id", ">u8"), ("row", ">u8")])
_BIAS = np.uint64(2**63)


def whole(components: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles where every product of two rows stays exact, else as Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(components * scale)
    if not out.size or np.abs(out).max() < 2.0**20:
        return out
    exact = lambda x: math.floor(x * scale) if abs(x) < 2.0**40 else math.floor(x) * scale
    return np.array([[exact(x) for x in row] for row in components.tolist()], object)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows: doubles below 2^53, Python integers beyond, held inside 64 bits."""
    if a.dtype == object or b.dtype == object or a.shape[1] > 1 << 6:
        bound = int(max(abs(a).max(), 1)) * int(max(abs(b).max(), 1)) * a.shape[1] * 128 if a.size and b.size else 0
        if bound >= 2**53:
            integers = lambda x: np.array([[int(y) for y in row] for row in x.tolist()], object)
            return np.vectorize(lambda s: min(max(int(s), _LOW), _HIGH), otypes=[object])(integers(a).dot(integers(b).T))
    return a.astype(np.float64) @ b.astype(np.float64).T


def pack_keys(anchor_ids, anchor_rows, scores, negative, ids, no_id, rows) -> pa.Array:
    """Keys whose byte order is anchor, score from the highest, positives before negatives, id (null last), row."""
    keys = np.zeros(len(scores), _KEY)
    biased = lambda x: np.asarray(x, np.int64).view(np.uint64) ^ _BIAS
    keys["anchor"], keys["anchor_row"] = biased(anchor_ids), np.asarray(anchor_rows, np.uint64)
    keys["falling"] = ~biased(scores.astype(np.int64))
    keys["negative"], keys["no_id"], keys["id"], keys["row"] = negative, no_id, biased(ids), np.asarray(rows, np.uint64)
    return pa.array([k.tobytes() for k in keys], pa.binary())


def unpack_keys(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(anchor id, anchor row, score, is negative, id or None) of every key of a batch, in its order."""
    keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), _KEY)
    back = lambda x: (x.astype(np.uint64) ^ _BIAS).view(np.int64).tolist()
    ids = [None if none else i for i, none in zip(back(keys["id"]), keys["no_id"].tolist())]
    return zip(back(keys["anchor"]), keys["anchor_row"].tolist(), back(~keys["falling"].astype(np.uint64)),
               keys["negative"].tolist(), ids)


def first_positives(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The first ``k`` keys of every anchor, streamed."""
    now, seen = None, 0
    for batch in batches:
        out = []
        for anchor, row, score, _, found in unpack_keys(batch):
            now, seen = (row, seen + 1) if row == now else (row, 1)
            if seen <= k:
                out.append((anchor, row, seen, found, score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
            names=["anchor_id", "anchor_row", "nth", "positive_id", "positive_score"])


def emit_negatives(batches: Iterable[pa.RecordBatch], k: int, at_least: int, of: int) -> Iterator[pa.RecordBatch]:
    """Negatives of every positive, streamed: a positive opens a window, the negatives that follow fill it.

    A window closes with its ``k``-th negative or at the first score below its share; only open windows are held.
    """
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    now, windows = None, []
    for batch in batches:
        out = []
        for anchor, row, score, negative, found in unpack_keys(batch):
            if row != now:
                now, windows = row, []
            if not negative:
                windows.append([found, score, 0])
                continue
            windows = [w for w in windows if w[2] < k and of * score >= at_least * w[1]]
            for w in windows:
                if score <= w[1]:
                    w[2] += 1
                    out.append((anchor, w[0], w[2], found, w[1], score))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [()] * 6, types)],
                                         names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Marks the k highest allowed scores of each row, and all that tie with the last of them."""
    n = scores.shape[1]
    if n <= k:
        return allowed
    masked = np.where(allowed, scores, -np.inf)
    kth = np.sort(masked, axis=1)[:, n - k] if scores.dtype == object else np.partition(masked, n - k, axis=1)[:, n - k]
    return allowed & (masked >= kth[:, None])


def _first_of_ties(q: np.ndarray, scores: np.ndarray, order_by: tuple, k: int) -> np.ndarray:
    """Positions of the first k entries of every q, by score from the highest, then ``order_by``."""
    order = np.lexsort((*order_by[::-1], ~scores.astype(np.int64), q))
    sorted_q = q[order]
    starts = np.flatnonzero(np.append(True, sorted_q[1:] != sorted_q[:-1])) if len(q) else np.zeros(0, int)
    nth = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[nth < k]


def mine(vectors: DataFrame, is_anchor: Column, label: Column | None = None, vector: str = "embedding", vec_id: str = "vec_id",
         positives: int = 5, negatives: int = 5, at_least: int = 80, of: int = 100, scale: int = 256,
         block_anchors: int = 16384, block_vectors: int = 16384) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for every anchor and positive.

    Components become floor(scale * x); a score is the integer inner product with the anchor. The positives of an
    anchor are its first ``positives`` other rows of the same label, the negatives of a positive the first
    ``negatives`` rows of other labels with at_least * positive_score <= of * score <= of * positive_score. Higher
    scores come first, ties by smaller id.

    1. Anchors and rows of one label meet in blocks; every block packs its best of each anchor into keys (anchor,
       descending score, id). The keys are dealt by anchor and sorted within partitions, and an iterator takes the
       first of every anchor.
    2. Anchors, with their positives' scores, and all rows meet in blocks. A block sends on only rows that are among its
       first of some positive's window, which loses none. Their keys and the positives' go through the same shuffle,
       and an iterator opens a window at each positive and emits the negatives that follow it.

    ``repartition`` by anchor and ``sortWithinPartitions`` are repartitionAndSortWithinPartitions for data frames: Spark
    sorts and spills in the JVM, Python reads a stream and holds the open windows. A block is a task of bounded size,
    so an anchor is never in one piece, and a label that holds a third of all rows is only more blocks.

    Rows with a null label, a null or empty vector, or a null, NaN or infinite component take no part. Rows of repeated ids are rows of
    their own: each anchor row is answered, and only the row itself is not its positive. A null id is no anchor, and
    comes last among ties. Rows are compared within equal vector lengths. Scores beyond 64 bits count as the nearest
    64-bit integer. An empty table, or one without anchors, gives an empty result. Only the named columns are read, so no others
    can clash. The work is the number of anchors times the number of rows, as the exact answer asks for.
    """
    x = F.col(vector)
    label = F.col("label") if label is None else label
    good = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), label.cast("string").alias("label"), x.cast("array<double>").alias("v"),
                          F.coalesce(is_anchor & F.col(vec_id).isNotNull(), F.lit(False)).alias("anchor"), good.alias("good"))
    rows = rows.where("good AND label IS NOT NULL").drop("good").withColumns(
        {"width": F.size("v"), "row": F.monotonically_increasing_id()})
    rows = stage(rows, "vectors")
    shape = rows.groupBy("width", "label").agg(F.count("*").alias("n"), F.count_if("anchor").alias("a"))
    shape = stage(shape.where("a > 0"), "labels")
    size = shape.agg(F.sum("a").alias("a")).first().a or 0
    total = rows.count()

    def blocks(n, of_size):
        return F.ceil(n / F.lit(of_size)).cast("int")

    def dealt(df, own, mine_, other, others):
        """Each row in its own block, once for every block of the other side."""
        at = F.pmod(F.xxhash64("row", F.lit(own)), mine_).cast("int").alias(own)
        return df.withColumn(own, at).withColumn(other, F.explode(F.sequence(F.lit(0), others - 1)))

    def read(t):
        return whole(np.asarray(t.column("v").combine_chunks().flatten(), np.float64).reshape(len(t), -1), scale)

    def columns(t):
        ids = t.column("id").combine_chunks()
        return np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(t.column("row").combine_chunks())

    def keys(anchors, at, found, scores, negative):
        (a_ids, _, a_rows), (ids, none, numbers) = anchors, found
        q, v = at
        return pa.table({"anchor_row": pa.array(a_rows[q], pa.int64()),
                         "key": pack_keys(a_ids[q], a_rows[q], scores, negative, ids[v], none[v], numbers[v])})

    nothing = pa.table({"anchor_row": pa.array([], pa.int64()), "key": pa.array([], pa.binary())})

    def slices(left, right):
        """Anchors of a block, some at a time, with their scores."""
        vectors_, step = read(right), max(1, CELLS // len(right))
        anchors_ = read(left)
        for start in range(0, len(left), step):
            yield slice(start, start + step), products(anchors_[start:start + step], vectors_)

    def score_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return nothing
        anchors, found, out = columns(left), columns(right), []
        for part, scores in slices(left, right):
            q, v = np.nonzero(_best(scores, anchors[2][part][:, None] != found[2][None, :], positives))
            s = scores[q, v]
            best = _first_of_ties(q, s, (found[1][v], found[0][v], found[2][v]), positives)
            out.append(keys(anchors, (q[best] + part.start, v[best]), found, s[best], 0))
        return pa.concat_tables(out)

    def score_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return nothing
        anchors, found, out = columns(left), columns(right), []
        names = pa.concat_arrays([left.column("label").combine_chunks(), right.column("label").combine_chunks()])
        codes = np.asarray(names.dictionary_encode().indices)
        mine_, theirs = codes[:len(left)], codes[len(left):]
        opened = left.column("opened").to_pylist()
        for part, scores in slices(left, right):
            other = mine_[part][:, None] != theirs[None, :]
            wanted = []
            for i in range(positives):
                has = np.array([len(o) > i for o in opened[part]])
                at = np.flatnonzero(has)
                if not len(at):
                    break
                top = np.array([opened[part][j][i] for j in at], object if scores.dtype == object else np.float64)[:, None]
                mine_scores = scores[at]
                inside = other[at] & (mine_scores <= top) & (of * mine_scores >= at_least * top)
                q, v = np.nonzero(_best(mine_scores, inside, negatives))
                s = mine_scores[q, v]
                best = _first_of_ties(q, s, (found[1][v], found[0][v], found[2][v]), negatives)
                wanted.append(at[q[best]] * len(right) + v[best])
            if wanted:
                cells = np.unique(np.concatenate(wanted))
                q, v = np.divmod(cells, len(right))
                out.append(keys(anchors, (q + part.start, v), found, scores[q, v], 1))
        return pa.concat_tables(out) if out else nothing

    asked = stage(rows.where("anchor"), "anchors")
    by_label = ["width", "label", "i", "j"]
    left = dealt(asked.join(shape, ["width", "label"]), "i", blocks(F.col("a"), block_anchors), "j", blocks(F.col("n"), block_vectors))
    right = dealt(rows.join(shape, ["width", "label"]), "j", blocks(F.col("n"), block_vectors), "i", blocks(F.col("a"), block_anchors))
    sent = left.select(*by_label, "id", "row", "v").groupBy(*by_label).cogroup(
        right.select(*by_label, "id", "row", "v").groupBy(*by_label)).applyInArrow(score_positives, "anchor_row long, key binary")
    best = sent.repartition("anchor_row").sortWithinPartitions("key").mapInArrow(
        lambda batches: first_positives(batches, positives),
        "anchor_id long, anchor_row long, nth int, positive_id long, positive_score long")
    best = stage(best, "positives")

    opened = best.groupBy("anchor_row").agg(F.sort_array(F.collect_list("positive_score"), asc=False).alias("opened"))
    a_blocks, v_blocks = max(1, math.ceil(size / block_anchors)), max(1, math.ceil(total / block_vectors))
    by_width = ["width", "i", "j"]
    left = dealt(asked.join(opened, F.col("row") == F.col("anchor_row")), "i", F.lit(a_blocks), "j", F.lit(v_blocks))
    right = dealt(rows, "j", F.lit(v_blocks), "i", F.lit(a_blocks))
    sent = left.select(*by_width, "id", "row", "label", "v", "opened").groupBy(*by_width).cogroup(
        right.select(*by_width, "id", "row", "label", "v").groupBy(*by_width)).applyInArrow(score_negatives, "anchor_row long, key binary")

    def as_keys(batches):
        for batch in batches:
            n, ids = len(batch), batch.column("positive_id")
            yield pa.RecordBatch.from_arrays([batch.column("anchor_row"), pack_keys(
                batch.column("anchor_id").to_numpy(), batch.column("anchor_row").to_numpy(), batch.column("positive_score").to_numpy(),
                0, np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(batch.column("nth")))] if n else
                [pa.array([], pa.int64()), pa.array([], pa.binary())], names=["anchor_row", "key"])

    opening = best.mapInArrow(as_keys, "anchor_row long, key binary")
    return opening.union(sent).repartition("anchor_row").sortWithinPartitions("key").mapInArrow(
        lambda batches: emit_negatives(batches, negatives, at_least, of),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")

"""Language-model scores by a weighted backoff automaton learnt from the corpus."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import stage
from .blocks import Vocabulary, block_name, lower_words, mix, pack, table_blocks, unpack, word_hashes

_A = np.uint64(0x9E3779B97F4A7C15)
END, START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0xD6E8FEB86659FD93)
GRAMS_PER_BUCKET = 1_000_000
# Text of a block: its tokens and pairs are held as arrays, some forty times as large.
BLOCK_BYTES = 8 << 20


class Grams:
    """The n-grams of a block: the hash of every word and, of every pair that occurs, the hash of the pair.

    Words have numbers from 1; 0 is the end of a text, and as a context it is the start. ``arc`` is the number of
    the pair at each token.
    """

    def __init__(self, places: list[np.ndarray], hashes: np.ndarray):
        self.lengths = np.array([len(p) + 1 for p in places], np.int64)
        ends = np.cumsum(self.lengths)
        self.token = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        inner = np.ones(len(self.token), bool)
        inner[ends - 1] = False
        self.token[inner] = np.concatenate(places).astype(np.int64) + 1 if len(places) else 0
        self.state = np.concatenate([[0], self.token[:-1]]) if len(self.token) else self.token
        self.starts = ends - self.lengths
        pairs, self.arc = np.unique(self.state << 32 | self.token, return_inverse=True)
        self.one = np.concatenate([[END], hashes])
        context = np.concatenate([[START], hashes])
        # The start as a context is a pair of its own, last in the list.
        self.two = np.append(mix(context[pairs >> 32] * _A + self.one[pairs & 0xFFFFFFFF]), START)

    def counts(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = np.repeat(train, self.lengths).astype(np.float64)
        one = np.bincount(self.token, weight, len(self.one)).astype(np.int64)
        two = np.append(np.bincount(self.arc, weight, len(self.two) - 1).astype(np.int64), int(train.sum()))
        return one, two


def _dealt(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by (bucket, key), and the bucket of each in that order."""
    at = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    order = np.argsort(keys, kind="stable")
    return order, at[order].astype(np.int64)


def score(docs: DataFrame, held_out, weight: float = 200.0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Scores of all rows: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a boolean column over ``docs``; rows for which it is true are scored, not learnt from.

    The automaton. A state is a context: the start of a text, a word, or the root. A state's arc for word w leads to
    state w and costs log10((c(v, w) + m p(w)) / (c(v) + m)) where the pair was seen (m: ``weight``); every state
    has one failure arc to the root, of cost log10(m / (c(v) + m)), which is taken where it was not. The root has an arc
    for every word, log10 p(w), with p the add-one unigram of the contract; a word never seen leads back to the root. So
    all probabilities of a state sum to those of p. A text is read once from left to right, the state goes along, and
    the costs met are added.

    How it is learnt and reached. Texts are numbered in blocks (8 MB). A block sends each of its n-grams once, as a
    sorted list of hashes with counts in the training rows, to buckets of the hash range; a bucket adds up the blocks'
    counts and answers every block in its own order. The answers and the block's texts meet in one task, which
    reads the texts through the part of the automaton that they can reach. An n-gram of every text has one entry a
    block, so no bucket is hot; the number of buckets grows with the text, so they stay bounded. Nothing is broadcast,
    nothing is cut off, and only two sums (tokens, distinct tokens) reach the driver.

    Null or empty text: the end alone. A null ``held_out`` counts as false. Repeated rows are learnt from and scored
    each. With nothing to learn from, p is 1 / (0 + 1) for every token. Empty table: empty result. Other columns are
    not read, so none can clash. Both passes must see the same rows in the same order, as files give them.
    """
    rows = docs.select(F.col(doc_id).alias("d"), F.coalesce(held_out, F.lit(False)).alias("h"), F.col(text).alias("t"))
    size = docs.agg(F.sum(F.octet_length(text)).alias("s")).first().s or 0
    buckets = max(1, math.ceil(size / 8 / GRAMS_PER_BUCKET))

    def numbered(batches):
        for sequence, block in enumerate(table_blocks(batches, "t", BLOCK_BYTES)):
            vocabulary = Vocabulary()
            places = [vocabulary.numbers(lower_words(t)) for t in block.column("t").to_pylist()]
            hashes = mix(word_hashes(vocabulary.words()))
            yield block_name(sequence, int(mix(hashes).sum(dtype=np.uint64)) if len(hashes) else 0), block, places, hashes

    def gram_lists(batches):
        for name, block, places, hashes in numbered(batches):
            grams = Grams(places, hashes)
            train = ~block.column("h").to_numpy(zero_copy_only=False).astype(bool)
            for n, keys, counts in zip((1, 2), (grams.one, grams.two), grams.counts(train)):
                order, at = _dealt(keys, buckets)
                cuts = np.searchsorted(at, np.arange(buckets + 1))
                for b in np.flatnonzero(np.diff(cuts)):
                    part = order[cuts[b]:cuts[b + 1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([n], pa.int32()), pa.array([b], pa.int32()), pa.array([name]),
                         pa.array([keys[part].astype("<u8").tobytes()]), pa.array([pack(counts[part])])],
                        names=["n", "b", "block", "keys", "counts"])

    def added(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, "<u8") for k in group.column("keys").to_pylist()]
        counts = np.concatenate([unpack(c) for c in group.column("counts").to_pylist()]).astype(np.int64)
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(every), np.int64)
        np.add.at(totals, where, counts)
        own, at, answers = totals[where], 0, []
        for k in keys:
            answers.append(pa.compress(own[at:at + len(k)].astype("<i8").tobytes(), codec="zstd", asbytes=True))
            at += len(k)
        blocks = group.column("block").to_pylist()
        return pa.table({
            "n": group.column("n").combine_chunks(), "b": group.column("b").combine_chunks(), "block": pa.array(blocks, pa.string()),
            "size": pa.array([len(k) for k in keys], pa.int64()), "totals": pa.array(answers, pa.binary()),
            "known": pa.array([int((totals > 0).sum())] + [0] * (len(blocks) - 1), pa.int64()),
            "tokens": pa.array([int(totals.sum())] + [0] * (len(blocks) - 1), pa.int64())})

    lists = rows.mapInArrow(gram_lists, "n int, b int, block string, keys binary, counts binary")
    totals = stage(lists.groupBy("n", "b").applyInArrow(
        added, "n int, b int, block string, size long, totals binary, known long, tokens long"), "ngrams")
    sums = totals.where("n = 1").agg(F.sum("known").alias("v"), F.sum("tokens").alias("n")).first()
    known, tokens = int(sums.v or 0), int(sums.n or 0)

    def as_numbers(batches):
        for name, block, places, hashes in numbered(batches):
            words = [hashes.astype("<u8").tobytes()] + [None] * (len(block) - 1)
            yield from pa.table({
                "d": block.column("d").combine_chunks(), "h": block.column("h").combine_chunks(),
                "block": pa.array([name] * len(block)), "at": pa.array(range(len(block)), pa.int32()),
                "places": pa.array([pack(p) for p in places], pa.binary()), "words": pa.array(words, pa.binary())}).to_batches(max_chunksize=2000)

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            raise ValueError("the two passes over the documents differ; stage the input first")
        left, right = left.sort_by("at"), right.sort_by([("n", "ascending"), ("b", "ascending")])
        hashes = np.frombuffer(left.column("words")[0].as_py(), "<u8")
        grams = Grams([unpack(p) for p in left.column("places").to_pylist()], hashes)
        answers = [np.frombuffer(pa.decompress(t, decompressed_size=8 * s, codec="zstd", asbytes=True), "<i8")
                   for t, s in zip(right.column("totals").to_pylist(), right.column("size").to_pylist())]
        merged = []
        for n, keys in ((1, grams.one), (2, grams.two)):
            found = np.concatenate([a for a, x in zip(answers, right.column("n").to_pylist()) if x == n])
            if len(found) != len(keys):
                raise ValueError("the two passes over the documents differ; stage the input first")
            out = np.empty(len(keys), np.int64)
            out[_dealt(keys, buckets)[0]] = found
            merged.append(out)
        one, two = merged
        context = np.append(two[-1:], one[1:]).astype(np.float64)  # of the start and of every word
        root = np.log10((one + 1.0) / (tokens + known + 1.0))
        fail = np.log10(weight / (context + weight))
        state, token, seen = grams.state, grams.token, two[:-1][grams.arc]
        arc = np.log10((seen + weight * 10.0 ** root[token]) / (context[state] + weight))
        cost = np.where(seen > 0, arc, fail[state] + root[token])
        per = lambda x: np.add.reduceat(x, grams.starts)
        return pa.table({
            "d": left.column("d").combine_chunks(), "held_out": left.column("h").combine_chunks(),
            "n_tokens": pa.array(grams.lengths), "n_known": pa.array(per((one[token] > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(left), tokens, np.int64)),
            "base_score": pa.array(per(root[token])), "score": pa.array(per(cost))})

    kind = docs.schema[doc_id].dataType
    carried = T.StructType([T.StructField("d", kind)]).simpleString()[7:-1]
    numbers = rows.mapInArrow(as_numbers, f"{carried}, h boolean, block string, at int, places binary, words binary")
    out = numbers.groupBy("block").cogroup(totals.select("n", "b", "block", "size", "totals").groupBy("block")).applyInArrow(
        read, f"{carried}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("d", doc_id)

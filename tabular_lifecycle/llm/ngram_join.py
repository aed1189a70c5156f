"""Jaccard self-join on word shingles by vertical partitioning of the global order of n-grams."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import drop_stage, release, stage
from .blocks import Vocabulary, block_name, lower_words, mix, pack, table_blocks, unpack, word_hashes
from .common import components, fresh

_GROWTH = 1.6
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
# Shingles for which a bucket of fragments is made.
SHINGLES_PER_BUCKET = 3 << 20
# A fragment that more sets of a block, or of all blocks, share is hot: those of its sets that need it meet in blocks instead of in pairs.
_HOT_IN_BLOCK, _HOT = 8, 32
_MOST_BITS = 1 << 14


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Each text's distinct word shingles as sorted 64-bit hashes; the order of hashes is the global order of n-grams.

    A text of fewer words is one shingle, a text without words has none.
    """
    vocabulary = Vocabulary()
    rows = [vocabulary.numbers(lower_words(t)) for t in texts]
    hashes = mix(word_hashes(vocabulary.words()))
    out = []
    for row in rows:
        h, n = hashes[row], min(len(row), width)
        shingle = np.full(max(len(row) - width + 1, min(n, 1)), np.uint64(n))
        for i in range(n):
            shingle = mix(shingle * _A + h[i:i + len(shingle)])
        out.append(np.unique(shingle))
    return out


def class_key(shingles: np.ndarray) -> tuple[int, int]:
    """A 128-bit print of a set: equal sets, and only they, share it. Zero for the empty set."""
    x, y = mix(shingles ^ _B).sum(dtype=np.uint64), mix(shingles + _C).sum(dtype=np.uint64)
    return int(x.astype(np.int64)), int(y.astype(np.int64))


class Fragments:
    """Where the global order is cut, so that linked sets share a whole fragment.

    Linked sets differ in at most d n-grams, d growing with their sizes. Cut into more than d fragments, one that
    holds n-grams of either is equal in both (else each would hold a difference). Sizes are in classes, each with its d.
    A set names its fragments for its own class, and for the class below if it can link into it. Where too few
    fragments hold an n-gram, it names those of twice as many as well, until more than d do.
    """

    def __init__(self, above: int, of: int):
        self.above, self.of, self.bounds, self._cuts = above, of, [1], {}

    def largest_partner(self, size: int) -> int:
        return size * self.of // self.above

    def difference(self, a: int, b: int) -> int:
        return (a + b) * (self.of - self.above) // (self.of + self.above)

    def _class(self, size: int) -> int:
        while self.bounds[-1] <= size:
            self.bounds.append(max(self.bounds[-1] + 1, math.ceil(self.bounds[-1] * _GROWTH)))
        return int(np.searchsorted(self.bounds, size, side="right")) - 1

    def _plan(self, c: int) -> tuple[int, int]:
        """(d, first number of fragments) of class ``c``: enough for d + 1 of them to hold an n-gram, mostly."""
        if c not in self._cuts:
            low, high = self.bounds[c], self.bounds[c + 1] - 1
            d = self.difference(high, self.largest_partner(high))
            k = d + 1
            while k < 4 * d + 4 and k * (1 - math.exp(-low / k)) < d + 1 + 2 * math.sqrt(k * math.exp(-low / k)):
                k += 1
            self._cuts[c] = d, k
        return self._cuts[c]

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        return np.concatenate([names for names, _ in self.lists(shingles)])

    def lists(self, shingles: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """For each class and number of fragments: names of those that hold an n-gram, and how many of them a linked
        set shares at least (it differs in no more fragments than in n-grams)."""
        size = len(shingles)
        own, out = self._class(size), []
        mixed = mix(shingles + _A)
        for c in {own, own - 1} if own and size <= self.largest_partner(self.bounds[own] - 1) else {own}:
            d, k = self._plan(c)
            apart = self.difference(size, self.largest_partner(size) if c == own else self.bounds[own] - 1)
            while True:
                at = ((shingles >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
                starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                tag = at[starts] * _B + np.array([(c << 32) + k], np.uint64) * _C
                out.append((mix(np.add.reduceat(mixed, starts) ^ mix(tag)), len(starts) - apart))
                if len(starts) > d or k >= 2**31:
                    break
                k *= 2
        return out


def set_prints(docs: DataFrame, width: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(d, h, n, c1, c2) of every row: id, hash of its text, size of its set, print of its set."""
    def run(batches):
        for block in table_blocks(batches, "t"):
            sets = shingle_sets(block.column("t").to_pylist(), width)
            keys = [class_key(s) for s in sets]
            out = block.select(["d", "h"]).append_column("n", pa.array([len(s) for s in sets], pa.int64()))
            out = out.append_column("c1", pa.array([k[0] for k in keys], pa.int64()))
            yield from out.append_column("c2", pa.array([k[1] for k in keys], pa.int64())).to_batches()

    return docs.select(F.col(doc_id).cast("long").alias("d"), F.xxhash64(text).alias("h"), F.col(text).alias("t")).mapInArrow(
        run, "d long, h long, n long, c1 long, c2 long")


def pack_sorted(numbers: np.ndarray) -> bytes:
    """Ascending numbers, as differences whose bytes stand plane by plane: the high planes are mostly zero."""
    steps = np.diff(numbers, prepend=np.uint64(0)).astype("<u8")
    return len(steps).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def unpack_sorted(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.decompress(data[4:], decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def bits_of(shingles: np.ndarray) -> bytes:
    """Which parts of the global order hold an n-gram: a bit for each of at least twice as many parts as n-grams."""
    width = min(_MOST_BITS, 1 << max(6, (2 * len(shingles) - 1).bit_length()))
    held = np.zeros(width, np.uint8)
    held[(shingles >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)] = 1
    return np.packbits(held).tobytes()


def unpack_bits(bits: list[bytes], width: int) -> np.ndarray:
    """Rows of ``width`` bits; wider ones are folded, neighbouring parts into one."""
    rows = np.stack([np.unpackbits(np.frombuffer(x, np.uint8)).reshape(width, -1).max(axis=1) for x in bits])
    return rows.astype(np.float32)


def may_link(a_bits: list[bytes], a_sizes: np.ndarray, b_bits: list[bytes], b_sizes: np.ndarray, above: int, of: int) -> np.ndarray:
    """Which pairs of all a and b are not ruled out by their bits: parts that only one set holds are n-grams that
    only one holds, and linked sets have few of these. No link is lost."""
    width = 8 * min(map(len, a_bits + b_bits))
    left, right = unpack_bits(a_bits, width), unpack_bits(b_bits, width)
    apart = left.sum(axis=1)[:, None] + right.sum(axis=1)[None, :] - 2 * (left @ right.T)
    total = a_sizes[:, None] + b_sizes[None, :]
    near = (apart <= total * (of - above) // (of + above)) if of > above else apart == 0
    return near & (of * np.minimum(a_sizes[:, None], b_sizes[None, :]) >= above * np.maximum(a_sizes[:, None], b_sizes[None, :]))


def forest(at: np.ndarray, to: np.ndarray, size: int) -> np.ndarray:
    """The least number that each of ``size`` nodes reaches by the edges."""
    root = np.arange(size)
    while True:
        low = np.minimum(root[at], root[to])
        following = root.copy()
        np.minimum.at(following, at, low)
        np.minimum.at(following, to, low)
        if (following == root).all():
            return root
        root = following


def _pairs_of_runs(group: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """All pairs of refs inside each run of equal ``group``; runs are short."""
    starts = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(group)))
    nth = np.arange(len(group)) - np.repeat(starts, lengths)
    found = [np.zeros((2, 0), np.int64)]
    for step in range(1, int(lengths.max(initial=1))):
        later = np.flatnonzero(nth >= step)
        found.append(np.stack([ref[later - step], ref[later]]))
    pairs = np.concatenate(found, axis=1)
    return np.unique(np.sort(pairs, axis=0), axis=1)


def shared_fragments(docs: DataFrame, width: int, above: int, of: int, buckets: int, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b, hot) of sets that share a fragment, by set print, and (key, n, bits) of all sets.

    A block of documents sends its fragments to buckets by hash, packed: sorted hashes and the numbers of their lists
    in the block. Hashes are cut to 56 bits, so a pair may be named in vain, but none is lost. Sets that share a
    fragment and are of like size are paired with each other; if more than a few share it, it is hot (and a block sends
    only one of its own sets, so a fragment that a third of the rows share is still a short group). A hot pair is of a
    fragment and a set. A set needs the hot fragments of a list only if a linked set may share no other of the list: if
    as many of them are hot as a linked set shares at least. Passages that very many texts quote join none of these.
    """
    low_bits, flag = np.uint64(8), 1 << 30

    def run(batches):
        fragments = Fragments(above, of)
        for sequence, block in enumerate(table_blocks(batches, "t")):
            own: dict[int, tuple[list, int, bytes]] = {}
            for s in shingle_sets(block.column("t").to_pylist(), width):
                if len(s):
                    key = class_key(s)[0]
                    if key not in own:
                        own[key] = fragments.lists(s), len(s), bits_of(s)
            if not own:
                continue
            lists = [x for sets, _, _ in own.values() for x in sets]
            many = [len(x[0]) for x in own.values()]
            names, sig = np.repeat(np.array(list(own), np.int64), many), np.concatenate([x for x, _ in lists]) >> low_bits
            who = np.repeat(np.arange(len(lists)), [len(x) for x, _ in lists])
            order = np.lexsort((who, sig))
            sig, who = sig[order], who[order]
            starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            lengths = np.diff(np.append(starts, len(sig)))
            hot = np.repeat(lengths > _HOT_IN_BLOCK, lengths)
            first = np.zeros(len(sig), bool)
            first[starts] = True
            held = np.stack([sig[hot & ~first].astype(np.int64), who[hot & ~first]])
            stays = first | ~hot
            sig, who = sig[stays], who[stays] | np.where(hot[stays], flag, 0)
            at = (sig >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(32)
            cuts = np.searchsorted(at, np.arange(buckets + 1, dtype=np.uint64))
            name = block_name(sequence, len(own))
            of_sets = np.stack([np.repeat([x[1] for x in own.values()], many), [x for _, x in lists]]).astype(np.int64)
            of_first = np.flatnonzero(np.append(True, names[1:] != names[:-1]))
            bits: list[bytes | None] = [None] * len(lists)
            for i, x in zip(of_first.tolist(), own.values()):
                bits[i] = x[2]
            columns = ["bucket", "block", "sigs", "who", "sizes", "bits"]
            binary = lambda x: pa.array([x], pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array([-1 - int(names[0]) % buckets], pa.int32()), pa.array([name]), binary(names.tobytes()), binary(held.tobytes()),
                binary(of_sets.tobytes()), pa.array([bits], pa.list_(pa.binary()))], names=columns)
            for i in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[i], cuts[i + 1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([i], pa.int32()), pa.array([name]), binary(pack_sorted(sig[part])), binary(pack(who[part])), binary(None),
                    pa.array([None], pa.list_(pa.binary()))], names=columns)

    types = {"a": pa.string(), "x": pa.int64(), "b": pa.string(), "y": pa.int64(), "sig": pa.int64(), "key": pa.int64(), "n": pa.int64(),
             "least": pa.int64(), "bits": pa.binary()}

    def rows(**columns) -> pa.Table:
        size = len(next(iter(columns.values())))
        return pa.table({c: pa.array(columns[c], t) if c in columns else pa.nulls(size, t) for c, t in types.items()})

    def shared(group: pa.Table) -> pa.Table:
        """Of a bucket, pairs of lists (block and number) and lists that hold a hot fragment; of negative buckets, the
        lists of blocks and which of them hold a fragment that is hot in the block."""
        blocks, lists = group.column("block").to_pylist(), list(zip(*(group.column(c).to_pylist() for c in ("sigs", "who", "sizes", "bits"))))
        if group.column("bucket")[0].as_py() < 0:
            out = []
            for block, (names, held, sizes, bits) in zip(blocks, lists):
                names, held = np.frombuffer(names, np.int64), np.frombuffer(held, np.int64).reshape(2, -1)
                sizes = np.frombuffer(sizes, np.int64).reshape(2, -1)
                out.append(rows(a=[block] * len(names), x=np.arange(len(names)), key=names, n=sizes[0], least=sizes[1], bits=bits))
                out.append(rows(a=[block] * held.shape[1], x=held[1], sig=held[0]))
            return pa.concat_tables(out)
        lists = [(unpack_sorted(x[0]), unpack(x[1])) for x in lists]
        sig, who = (np.concatenate(x) for x in zip(*lists))
        of_block = np.repeat(np.arange(len(blocks)), [len(x) for x, _ in lists])
        order = np.lexsort((who & (flag - 1), of_block, sig))
        sig, marked = sig[order], (who[order] & flag) > 0
        ref = (of_block[order] << 32) | (who[order] & (flag - 1)).astype(np.int64)
        starts = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
        lengths = np.diff(np.append(starts, len(sig)))
        hot = (lengths > _HOT) | np.maximum.reduceat(marked, starts)
        of_run, hot_row = np.repeat(np.arange(len(starts)), lengths), np.repeat(hot, lengths)
        pairs = _pairs_of_runs(of_run[~hot_row], ref[~hot_row])
        side = lambda x: [blocks[i] for i in (x >> 32).tolist()]
        return pa.concat_tables([
            rows(a=side(pairs[0]), x=pairs[0] & 0xFFFFFFFF, b=side(pairs[1]), y=pairs[1] & 0xFFFFFFFF),
            rows(a=side(ref[hot_row]), x=ref[hot_row] & 0xFFFFFFFF, sig=sig[hot_row].astype(np.int64))])

    named = docs.select(F.col(text).alias("t")).mapInArrow(run, "bucket int, block string, sigs binary, who binary, sizes binary, bits array<binary>")
    found = stage(named.groupBy("bucket").applyInArrow(
        shared, "a string, x long, b string, y long, sig long, key long, n long, least long, bits binary"), "shared")
    lists = found.where("key IS NOT NULL")
    refs = lists.select("a", "x", "key", "n")
    pairs = found.where("b IS NOT NULL").select("a", "x", "b", "y").distinct()
    pairs = pairs.join(refs, ["a", "x"]).select("b", "y", F.col("key").alias("k"), F.col("n").alias("m"))
    pairs = pairs.join(refs.withColumnsRenamed({"a": "b", "x": "y"}), ["b", "y"]).where(
        (F.col("k") != F.col("key")) & (of * F.least("n", "m") >= above * F.greatest("n", "m")))
    cold = pairs.select(F.least("k", "key").alias("a"), F.greatest("k", "key").alias("b")).distinct()
    held = found.where("sig IS NOT NULL").groupBy("a", "x").agg(F.collect_list("sig").alias("sigs"))
    hot = (held.join(lists.select("a", "x", "key", "least"), ["a", "x"]).where(F.size("sigs") >= F.col("least"))
           .select(F.explode("sigs").alias("a"), F.col("key").alias("b")).distinct())
    pairs = stage(cold.withColumn("hot", F.lit(False)).union(hot.withColumn("hot", F.lit(True))), "pairs")
    sets = stage(lists.where("bits IS NOT NULL").groupBy("key").agg(F.first("n").alias("n"), F.first("bits").alias("bits")), "sets")
    drop_stage(found)
    return pairs, sets


def near_pairs(pairs: DataFrame, sets: DataFrame, above: int, of: int, block_sets: int) -> DataFrame:
    """Pairs (a, b) that hold together all sets that may be linked, from pairs that share a fragment.

    Pairs of cold fragments are looked at one by one: only those that their bits do not rule out stay. Sets joined by the
    hot fragments they need meet in blocks of their bits, and what stays of a pair of blocks is a forest.
    """
    types = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def one_by_one(batches):
        for batch in batches:
            keep = []
            for n, bits, m, others in zip(*(batch.column(c).to_pylist() for c in ("n", "bits", "m", "others"))):
                x, y = sorted((np.frombuffer(bits, np.uint8), np.frombuffer(others, np.uint8)), key=len)
                wide = np.unpackbits(y).reshape(8 * len(x), -1).max(axis=1) if len(y) > len(x) else np.unpackbits(y)
                apart = int((np.unpackbits(x) != wide).sum())
                keep.append(apart <= (n + m) * (of - above) // (of + above) and of * min(n, m) >= above * max(n, m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def in_blocks(group: pa.Table) -> pa.Table:
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        mine = np.asarray(group.column("k")) == i
        sides = [group.filter(pa.array(mine)), group.filter(pa.array(~mine))] if i != j else [group, group]
        keys = [np.asarray(x.column("key")) for x in sides]
        if not len(keys[0]) or not len(keys[1]):
            return types.empty_table()
        sizes, bits = [np.asarray(x.column("n")) for x in sides], [x.column("bits").to_pylist() for x in sides]
        # Sets of one width of bits at a time: linked sets are of the same or of neighbouring widths.
        widths, at, to = [np.array(list(map(len, b))) for b in bits], [], []
        for w in np.unique(widths[0]):
            for v in np.unique(widths[1]):
                if max(w, v) <= 4 * min(w, v):
                    p, q = np.flatnonzero(widths[0] == w), np.flatnonzero(widths[1] == v)
                    x, y = np.nonzero(may_link([bits[0][r] for r in p], sizes[0][p], [bits[1][r] for r in q], sizes[1][q], above, of))
                    at.append(p[x])
                    to.append(q[y])
        at, to = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at, to))
        every = np.concatenate(keys) if i != j else keys[0]
        root = forest(at, to + (len(keys[0]) if i != j else 0), len(every))
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": every[root[moved]], "b": every[moved]}, types)

    by = lambda key, n, bits: sets.select(F.col("key").alias(key), F.col("n").alias(n), F.col("bits").alias(bits))
    cold = pairs.where("NOT hot").join(by("a", "n", "bits"), "a").join(by("b", "m", "others"), "b")
    cold = cold.select("a", "b", "n", "bits", "m", "others").mapInArrow(one_by_one, "a long, b long")
    joined = components(pairs.where("hot").select("a", "b"))
    members = stage(joined.join(sets, joined.node == sets.key).select("root", "key", "n", "bits"), "hot-sets")
    counts = members.groupBy("root").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("blocks"))
    dealt = (members.join(counts, "root").withColumn("k", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", "key", "n", "bits", "k", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j")))
    return cold.union(dealt.groupBy("root", "i", "j").applyInArrow(in_blocks, "a long, b long")).where("a <> b").distinct()


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, above: int, of: int, chunk: int = 4096) -> np.ndarray:
    """Which pairs are linked. N-grams that two sets hold are cut into fragments of the order; partial overlaps of a
    fragment are one matrix product, and are summed for each pair."""
    every = left + (right or [])
    sizes = np.array([len(s) for s in every])
    grams, where = np.unique(np.concatenate(every), return_inverse=True)
    who = np.repeat(np.arange(len(every)), sizes)
    shared = np.bincount(where, minlength=len(grams)) > 1
    place = np.cumsum(shared) - 1
    who, place = who[shared[where]], place[where[shared[where]]]
    rows, total = len(left), np.zeros((len(left), len(right) if right else len(left)), np.float32)
    order = np.argsort(place, kind="stable")
    who, place = who[order], place[order]
    for start in range(0, int(shared.sum()), chunk):
        low, high = np.searchsorted(place, [start, start + chunk])
        part = np.zeros((len(every), chunk), np.float32)
        part[who[low:high], place[low:high] - start] = 1
        total += part[:rows] @ (part[rows:] if right else part).T
    a, b = sizes[:rows], sizes[rows:] if right else sizes
    return of * total >= above * (a[:, None] + b[None, :] - total)


def verified(candidates: DataFrame, width: int, above: int, of: int) -> DataFrame:
    """Pairs (a, b) of classes that span the links inside each pair of blocks (root, i, j) of a candidate cluster.

    Columns of ``candidates``: root, i, j, k (the row's own block), c1, c2, t (text). Overlaps are exact. The links of a
    pair of blocks go on as a forest, not as all pairs.
    """
    def run(group: pa.Table) -> pa.Table:
        sets: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
        wanted = list(zip(group.column("c1").to_pylist(), group.column("c2").to_pylist()))
        for key, k, s in zip(wanted, group.column("k").to_pylist(), shingle_sets(group.column("t").to_pylist(), width)):
            if class_key(s) == key:
                sets.setdefault(key, (k, s))
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        one = [x for x, (k, _) in sets.items() if k == i]
        two = [x for x, (k, _) in sets.items() if k == j] if i != j else None
        names, edges = one + (two or []), []
        if one and (two is None or two):
            linked = _links([sets[x][1] for x in one], [sets[x][1] for x in two] if two else None, above, of)
            at, to = np.nonzero(linked)
            root = forest(at, to + len(one) if two else to, len(names)).tolist()
            edges = [(names[x], names[r]) for x, r in enumerate(root) if x != r]
        text = lambda side: pa.array([f"{e[side][0]:d}:{e[side][1]:d}" for e in edges], pa.string())
        return pa.table({"a": text(0), "b": text(1)})

    return candidates.groupBy("root", "i", "j").applyInArrow(run, "a string, b string")


def link_classes(docs: DataFrame, width: int = 5, above: int = 80, of: int = 100, text: str = "text",
                 doc_id: str = "doc_id", block_sets: int = 256) -> DataFrame:
    """One row for each row of ``docs``: d (its id), n_shingles, component_id, h (hash of its text).

    Two documents link when ``of`` times the size of the intersection of their sets of distinct ``width``-word
    shingles is at least ``above`` times that of the union; a component_id is the smallest id reachable by links.

    1. Equal sets are one class, so copies never meet each other.
    2. The global order of n-grams is cut into fragments, and classes that share a whole fragment are paired
       (``Fragments`` says why no link is lost). Pairs that differ in too many parts of the order go; components of
       the others are candidate clusters (``near_pairs``).
    3. Inside a cluster, blocks of classes meet in pairs; overlaps are counted fragment by fragment, summed for each
       pair of classes, and compared exactly. A cluster of any size is cut into tasks of ``block_sets`` classes a
       side; what comes out of each is a forest of its links.
    4. Components of the verified links, and the smallest id of each.

    Null or blank text: an empty set, linked with nothing, its own component. Null ids: never the smallest, unless
    all are null. Rows of one id and different texts are documents of their own; repeated rows are copies. Empty table:
    empty result. Other columns are not read, so none can clash. A very long text is read whole, in a block of its own.
    """
    release(docs.sparkSession)
    prints = stage(set_prints(docs, width, text, doc_id), "prints")
    buckets = max(1, math.ceil((prints.agg(F.sum("n").alias("n")).first().n or 0) / SHINGLES_PER_BUCKET))
    pairs, sets = shared_fragments(docs, width, above, of, buckets, text)
    clusters = components(near_pairs(pairs, sets, above, of, 8 * block_sets))
    release(docs.sparkSession)
    classes = prints.where("n > 0").groupBy("c1", "c2").agg(F.min("d").alias("low"))
    members = stage(classes.join(clusters, classes.c1 == clusters.node).select("root", "c1", "c2", F.col("low").alias("d")), "members")
    counts = members.groupBy("root").agg(F.ceil(F.count("*") / block_sets).cast("int").alias("blocks"))
    dealt = (members.join(counts, "root").withColumn("k", F.pmod(F.xxhash64("c1", "c2"), F.col("blocks")).cast("int"))
             .select("d", "root", "c1", "c2", "k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
             .select("d", "root", "c1", "c2", "k", F.least("k", "o").alias("i"), F.greatest("k", "o").alias("j")))
    texts = docs.select(F.col(doc_id).cast("long").alias("e"), F.col(text).alias("t"))
    held = members.select("d").distinct()
    # Members grow with the corpus, so the plan is the same at every size: a merge join, whose heavy keys Spark splits.
    near = texts.join(held.hint("merge"), F.col("e").eqNullSafe(F.col("d")), "left_semi")
    links = verified(dealt.join(near, F.col("d").eqNullSafe(F.col("e"))).select("root", "i", "j", "k", "c1", "c2", "t"), width, above, of)
    roots = components(stage(links, "pairs"))
    named = classes.withColumn("node", F.concat_ws(":", "c1", "c2")).join(roots, "node", "left")
    named = stage(named.select("c1", "c2", "low", F.coalesce("root", "node").alias("root")), "named")
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_class = named.join(lowest, "root").select(F.col("c1").alias("x"), F.col("c2").alias("y"), "component_id")
    joined = prints.join(by_class, F.expr("n > 0 AND c1 = x AND c2 = y"), "left")
    return joined.select("d", F.col("n").alias("n_shingles"),
                         F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("d")).alias("component_id"), "h")


def keep_one(docs: DataFrame, width: int = 5, above: int = 80, of: int = 100, text: str = "text",
             doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents linked, directly or by others, to one of a smaller id.

    Documents go by id and text: of one id with two texts, only the linked one goes; repeated rows stay or go together. Null
    ids, and null, empty and blank texts stay. An empty table stays empty. Other columns pass through, whatever their names.
    """
    lost, print_ = fresh(docs, "_lost"), fresh(docs, "_print")
    linked = link_classes(docs, width, above, of, text, doc_id).where("n_shingles > 0 AND d > component_id")
    gone = linked.select(F.col("d").alias(lost), F.col("h").alias(print_)).distinct()
    return docs.join(gone, (docs[doc_id] == F.col(lost)) & (F.xxhash64(docs[text]) == F.col(print_)), "left_anti")

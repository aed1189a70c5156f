"""Alignment of two tokenizers' tokens: ends are merged along diagonals in pieces of equal work, which are stitched into groups."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import stage
from .blocks import Vocabulary, block_name, give_back, mix, table_blocks
from .blocks import pack as pack_low
from .blocks import unpack as unpack_low
from .bpe import pieces as byte_level_pieces
from .bpe import vocabulary_path
from .common import fresh

BLOCK_BYTES = 8 << 20
# Text for which a bucket of id pairs is made.
BYTES_PER_BUCKET = 20 << 20
# Ends of both sides that one piece of the merge takes.
PIECE_WORK = 1 << 18
_UNITS_AT_ONCE = 8192
# Characters that are tokenized as one line, and that are aligned at once; a unit is never cut.
_LINE_CHARS = 1 << 12
_CHARS_AT_ONCE = 1 << 19
_TEXTS_AT_ONCE = 500
_PLACES_AT_ONCE = 1 << 18
_WIDE_GROUP = 1 << 12
_CLOSE_SPACES = re.compile(r"\s\s|^\s|\s\Z")
_WORD_START = re.compile(r"(?<=\S)(?= \S)")
_MARK = "▁"


# --- merge path ------------------------------------------------------------------------------------------------------

def diagonal_cuts(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where diagonals 0, work, 2 work, ... cross the merge path of two ascending lists: counts taken of each side.

    A binary search on every diagonal finds how many of its ends come from ``a`` (first where both are equal), so each
    piece between two cuts can be merged with no knowledge of the others.
    """
    total = len(a) + len(b)
    at = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, at - len(b)), np.minimum(at, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        i, j = middle[open_], (at - middle - 1)[open_]
        taken = a[i] <= b[j]
        low[open_] = np.where(taken, i + 1, low[open_])
        high[open_] = np.where(taken, high[open_], i)
    return low, at - low


def merge_piece(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of one piece: tokens (of a, of b) that hold the byte before each of its ends, and where both end there.

    ``i`` and ``j`` are the numbers of the piece's first tokens. The piece sees its own ends alone.
    """
    in_b = np.searchsorted(b, a)
    both = np.zeros(len(a), bool)
    inside = in_b < len(b)
    both[inside] = b[in_b[inside]] == a[inside]
    alone = np.ones(len(b), bool)
    alone[in_b[both]] = False
    of_a = np.concatenate([np.arange(len(a)), np.searchsorted(a, b[alone])])
    of_b = np.concatenate([in_b, np.flatnonzero(alone)])
    closes = np.concatenate([both, np.zeros(int(alone.sum()), bool)])
    order = np.lexsort((of_b, of_a))
    return of_a[order] + i, of_b[order] + j, closes[order]


def stitch(parts: list[tuple], a: np.ndarray, b: np.ndarray, cuts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of both sides up to the end of every group, from the overlaps of all pieces.

    A cut may part an end of ``a`` from the same end of ``b``: the end then closes the last overlap of the piece before, and
    the first overlap of the piece after, which took it for an end of ``b`` alone, is dropped. Groups that
    reach over a cut join by themselves, since only closing overlaps count.
    """
    last_a, last_b = [], []
    for k, (of_a, of_b, closes) in enumerate(parts):
        i, j = cuts[0][k], cuts[1][k]
        if len(of_a) and i and j < len(b) and cuts[1][k + 1] > j and a[i - 1] == b[j]:
            last_a.append(np.array([i])), last_b.append(np.array([j + 1]))
            of_a, of_b, closes = of_a[1:], of_b[1:], closes[1:]
        last_a.append(of_a[closes] + 1)
        last_b.append(of_b[closes] + 1)
    return (np.concatenate(last_a).astype(np.int64), np.concatenate(last_b).astype(np.int64)) if parts else (np.zeros(0, np.int64),) * 2


def merge_groups(a: np.ndarray, b: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of both sides up to the end of every group, for two ascending lists of ends that end alike."""
    cuts = diagonal_cuts(a, b, work)
    spans = zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:])
    return stitch([merge_piece(a[i:i2], b[j:j2], i, j) for i, i2, j, j2 in spans], a, b, cuts)


# --- the two tokenizers ----------------------------------------------------------------------------------------------

class Pair:
    """Two tokenizers, one of byte-level entries (A, with a space before the text) and one of pieces (B, which adds it).

    One pair is made for each Python worker. Texts are cut before a single space between two words, where both
    tokenizers always cut: the first takes a space into the word that follows, the second has no piece that goes on with its
    mark after another character, which is checked here.
    """
    _made: dict = {}

    @classmethod
    def of(cls, vocabulary: str, model: bytes) -> Pair:
        key = xxhash.xxh3_128_hexdigest(vocabulary.encode() + model)
        if key not in cls._made:
            cls._made[key] = cls(vocabulary, model)
        return cls._made[key]

    def __init__(self, vocabulary: str, model: bytes):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(vocabulary)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = byte_level_pieces(vocabulary)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace(_MARK, " ").encode() for i, n in enumerate(names)]
        if any(re.search(f"[^{_MARK}]{_MARK}", n) for n in names):
            raise ValueError("the second tokenizer has pieces across words")
        self.a_lengths = np.fromiter(map(len, self.a_bytes), np.int64)
        self.b_lengths = np.fromiter(map(len, self.b_bytes), np.int64)
        self.a_names = list(map(str, range(len(self.a_bytes))))
        self.b_names = list(map(str, range(len(self.b_bytes))))

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, their number by unit, ids of B, their number, and whether both spell the unit."""
        none = np.zeros(0, np.int64)
        made = [(none, none, none, none, none.astype(bool))]
        for start in range(0, len(units), _UNITS_AT_ONCE):
            made += self._encode(units[start:start + _UNITS_AT_ONCE])
        return tuple(map(np.concatenate, zip(*made)))

    def _encode(self, units: list[str]) -> list[tuple]:
        """``encode`` in parts. Units are tokenized in lines, which both tokenizers cut where the units meet; those of a line that
        is not spelled, or has a token across two units, one by one."""
        at = lines(units)
        mine, theirs = self._tokens(["".join(units[i:j]) for i, j in zip(at, at[1:])])
        if (whole := self._by_unit(units, mine, theirs)) is not None:
            return [whole]
        spelled = [self._by_unit(units[i:j], [x], [y]) for i, j, x, y in zip(at, at[1:], mine, theirs)]
        odd = [u for i, j, line in zip(at, at[1:], spelled) if line is None for u in units[i:j]]
        rest = zip(odd, *self._tokens(odd))
        return [self._one_by_one(*zip(*islice(rest, j - i))) if line is None else line for i, j, line in zip(at, at[1:], spelled)]

    def _one_by_one(self, units: list[str], mine: list[list[int]], theirs: list[list[int]]) -> tuple:
        spell = lambda ids, table: b"".join(map(table.__getitem__, ids))
        good = np.array([spell(x, self.a_bytes) == spell(y, self.b_bytes) == u.encode() for u, x, y in zip(units, mine, theirs)], bool)
        flat = [(np.array(list(chain.from_iterable(ids)), np.int64), np.array(list(map(len, ids)))) for ids in (mine, theirs)]
        return *flat[0], *flat[1], good

    def _tokens(self, lines: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a.encode_batch_fast(lines, add_special_tokens=False)], self.b.encode([x[1:] for x in lines], num_threads=1)

    def _by_unit(self, units: list[str], mine: list[list[int]], theirs: list[list[int]]) -> tuple | None:
        """The lines' ids as ``encode`` has them, if both tokenizers spell the units and have a token's end where each ends."""
        plain, out = [u.encode() for u in units], []
        ends = np.cumsum(np.fromiter(map(len, plain), np.int64, len(plain)))
        for lists, table, sizes in ((mine, self.a_bytes, self.a_lengths), (theirs, self.b_bytes, self.b_lengths)):
            ids = list(chain.from_iterable(lists))
            flat = np.array(ids, np.int64)
            token_ends = _bounds(sizes[flat])
            at = np.searchsorted(token_ends, ends, "right") - 1
            if (token_ends[at] != ends).any() or b"".join(map(table.__getitem__, ids)) != b"".join(plain):
                return None
            out += [flat, np.diff(at, prepend=0)]
        return *out, np.ones(len(units), bool)


def read_models(byte_vocabulary: str | None = None, piece_model: str | None = None) -> tuple[str, bytes]:
    """Both tokenizers' files, by default the installed public ones; they have a fixed size and travel with the tasks."""
    with open(byte_vocabulary or vocabulary_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    with open(piece_model or vocabulary_path("piece_bpe_32k.model"), "rb") as file:
        return vocabulary, file.read()


def units(text: str) -> list[str]:
    """A space and the text, cut before each single space between two characters that are not white space."""
    if _CLOSE_SPACES.search(text):
        return _WORD_START.split(" " + text)
    return [" " + word for word in text.split(" ")]


def lines(units: list[str]) -> list[int]:
    """Where lines of units begin, and the end. Only units that begin and end in no white space but their space share one:
    joined, they meet at a single space between two words, where ``units`` cuts. One with a mark, which is spelled as a space, is a
    line of its own."""
    lengths = np.fromiter(map(len, units), np.int64, len(units))
    alone = np.fromiter((len(u) < 2 or u[1].isspace() or u[-1].isspace() or _MARK in u for u in units), bool, len(units))
    line = (np.cumsum(lengths) - lengths) // _LINE_CHARS
    begins = alone | np.append(True, alone)[:-1] | (np.diff(line, prepend=-1) > 0)
    return [*np.flatnonzero(begins).tolist(), len(units)]


def portions(units: list[str]) -> Iterator[list[str]]:
    """The units in their order, about ``_CHARS_AT_ONCE`` characters at a time (at least one unit; none give one empty portion)."""
    at = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
    cuts = [0, *(np.flatnonzero(np.diff(at // _CHARS_AT_ONCE)) + 1).tolist(), len(units)]
    for i, j in zip(cuts, cuts[1:]):
        yield units[i:j]


# --- one block of documents ------------------------------------------------------------------------------------------

def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^63, compressed; their high halves only where there are any."""
    numbers = np.asarray(numbers, np.int64)
    low, high = pack_low(numbers & 0xFFFFFFFF), numbers >> 32
    return len(low).to_bytes(4, "little") + low + (pack_low(high) if high.any() else b"")


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    low, high = unpack_low(data[4:4 + n]).astype(np.int64), data[4 + n:]
    return low + (unpack_low(high).astype(np.int64) << 32) if high else low


def _bounds(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class Units:
    """The distinct units of a block, tokenized and aligned once: tokens, groups, links and the text of the groups.

    A portion of them at a time: its units stand one after the other, so their ends are two ascending lists, merged as one. A
    unit ends in both, so no group reaches over two. Portions bound what is held besides the results.
    """

    def __init__(self, units: list[str], pair: Pair):
        self.texts, counts, links = [], [], []
        for portion in portions(units):
            counted, linked = self._align(portion, pair)
            counts.append(counted)
            links.append(linked)
        self.good, self.n_a, self.n_b, self.n_groups, self.n_links, self.n_pairs = map(np.concatenate, zip(*counts))
        pairs, link_pair, link_times = zip(*links)
        self.pairs = np.unique(np.concatenate(pairs))
        self.link_pair = np.concatenate([np.searchsorted(self.pairs, x).astype(np.int32)[n] for x, n in zip(pairs, link_pair)])
        self.link_times = np.concatenate(link_times)

    def _align(self, units: list[str], pair: Pair) -> tuple[tuple, tuple]:
        """Numbers of every unit, and the portion's distinct pairs with their links by unit; texts go to ``texts``."""
        a, n_a, b, n_b, good = pair.encode(units)
        # Units that a tokenizer does not spell have no alignment; no document that holds one does.
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b = n_a * good, n_b * good
        to_a, to_b = merge_groups(np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b_lengths[b]))
        from_a, from_b = np.append(0, to_a)[:-1], np.append(0, to_b)[:-1]
        unit = np.searchsorted(_bounds(n_a), from_a, "right") - 1
        n_groups = np.bincount(unit, minlength=len(units))
        wide, high = to_a - from_a, to_b - from_b
        n_links = np.zeros(len(units), np.int64)
        np.add.at(n_links, unit, wide * high)
        self.texts += self._texts(a, b, from_a, to_a, from_b, to_b, n_groups, pair)
        n_pairs, *linked = self._link(a, b, unit, len(units), from_a, wide, from_b, high)
        return (good, n_a, n_b, n_groups, n_links, n_pairs), tuple(linked)

    def _texts(self, a, b, from_a, to_a, from_b, to_b, n_groups, pair) -> list[str]:
        a_names, b_names = [pair.a_names[i] for i in a.tolist()], [pair.b_names[i] for i in b.tolist()]
        groups = [f"{a_names[i]}|{b_names[j]}" if i2 - i == 1 == j2 - j else f"{','.join(a_names[i:i2])}|{','.join(b_names[j:j2])}"
                  for i, i2, j, j2 in zip(from_a.tolist(), to_a.tolist(), from_b.tolist(), to_b.tolist())]
        at = _bounds(n_groups).tolist()
        return [";".join(groups[x:y]) for x, y in zip(at, at[1:])]

    def _link(self, a, b, unit, n_units, from_a, wide, from_b, high) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct id pairs of every unit with the number of links; those of wide groups by their distinct ids.

        Returned: the number of pairs by unit, all distinct pairs, and by unit their numbers and how often they are linked."""
        small = wide * high <= _WIDE_GROUP
        product = (wide * high)[small]
        nth = _spread(np.zeros(len(product), np.int64), product)
        across = np.repeat(high[small], product)
        keys = [a[np.repeat(from_a[small], product) + nth // across] << 32 | b[np.repeat(from_b[small], product) + nth % across]]
        owners, times = [np.repeat(unit[small], product)], [np.ones(len(nth), np.int64)]
        for g in np.flatnonzero(~small):
            x, m = np.unique(a[from_a[g]:from_a[g] + wide[g]], return_counts=True)
            y, n = np.unique(b[from_b[g]:from_b[g] + high[g]], return_counts=True)
            keys.append((x[:, None] << 32 | y[None, :]).ravel())
            times.append((m[:, None] * n[None, :]).ravel())
            owners.append(np.full(len(keys[-1]), unit[g]))
        keys, owners, times = map(np.concatenate, (keys, owners, times))
        pairs, numbers = np.unique(keys, return_inverse=True)
        cells, inverse = np.unique(owners * (len(pairs) + 1) + numbers, return_inverse=True)
        owner, link_pair = np.divmod(cells, len(pairs) + 1)
        link_times = np.bincount(inverse, weights=times, minlength=len(cells)).astype(np.int64)
        return np.bincount(owner, minlength=n_units), pairs, link_pair.astype(np.int32), link_times

    def documents_by_pair(self, places: list[np.ndarray]) -> np.ndarray:
        """In how many documents, given by the numbers of their units, each pair of the block is linked."""
        out, at = np.zeros(len(self.pairs), np.int64), _bounds(self.n_pairs)
        start = 0
        while start < len(places):
            stop, held = start, 0
            while stop < len(places) and (stop == start or held + len(places[stop]) <= _PLACES_AT_ONCE):
                held += len(places[stop])
                stop += 1
            part = places[start:stop]
            owner = np.repeat(np.arange(len(part)), [len(p) for p in part])
            cells = np.unique(owner * (len(self.n_a) + 1) + np.concatenate([np.zeros(0, np.int64), *part]).astype(np.int64))
            owner, unit = np.divmod(cells, len(self.n_a) + 1)
            pairs = self.link_pair[_spread(at[unit], self.n_pairs[unit])]
            cells = np.unique(np.repeat(owner, self.n_pairs[unit]) * (len(self.pairs) + 1) + pairs)
            out += np.bincount(cells % (len(self.pairs) + 1), minlength=len(out))
            start = stop
        return out


def align(docs: DataFrame, vocabulary: str, model: bytes, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` with n_a, n_b, n_groups, n_links, n_best, count_sum (long) and ``groups_sha256`` of every document.

    Tokens of A (byte-level, of a space and the text) and of B (pieces, of the text) are cut into groups where both end; every
    token of A is linked with every token of B in its group. A pair of ids counts the documents that hold it linked;
    n_best counts links whose pair is the most frequent of its A id (ties included), count_sum sums the pairs' counts
    over links. groups_sha256 digests ``a1,a2|b1;a3|b2,b3``.

    1. A block of documents becomes numbers of its distinct units (words with what adheres to them). Their tokens' ends,
       one unit after the other, are two ascending lists, a portion of units at a time, merged along diagonals in pieces of
       equal work and stitched into groups (``merge_groups``). Results of a block are written once.
    2. Blocks send their distinct pairs, packed, with their number of documents to buckets by hash; the number of
       buckets grows with the text. A bucket sums its pairs and answers every block. An ``A`` id's highest count is a
       table no longer than the vocabulary, so the driver may hold it.
    3. Answers meet their block, whose units and then documents sum them up.

    Bounded memory: a block with its results (a document of more than ``block_bytes`` is a block of its own, whole) and a portion of
    its units (at least one, whole), or a bucket; a frequent word
    or pair is one entry a block. Null and empty texts, and those a tokenizer does not spell, have zeros and an empty
    digest and count for no pair. Repeated rows and ids are documents of their own. An empty table gives an empty result.
    Only ``text`` and ``keep`` are read, so no other column can clash; those of ``keep`` come before the results.
    """
    taken = docs.select(*keep)
    b, p = fresh(taken, "_block"), fresh(taken, "_places")
    sums = [fresh(taken, n) for n in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")]
    if sums != ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]:
        raise ValueError("keep has a column named as a result; rename it first")
    size = docs.agg(F.sum(F.octet_length(text)).alias("s")).first().s or 0
    buckets = max(1, math.ceil(size / BYTES_PER_BUCKET))
    fields = [docs.schema[c] for c in keep]
    block_fields = ["n_pairs", "link_pair", "link_times", "pair_a", "pair_b", "pair_docs", "pair_bucket"]
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in fields], T.StructField(b, T.StringType()), T.StructField(p, T.BinaryType()),
        *[T.StructField(n, T.LongType()) for n in sums[:4]], T.StructField(sums[4], T.StringType()),
        *[T.StructField(f"_{n}", T.BinaryType()) for n in block_fields]])

    def aligned(batches):
        pair = Pair.of(vocabulary, model)
        for sequence, block in enumerate(table_blocks(batches, text, block_bytes)):
            words, texts = Vocabulary(), block.column(text)
            # Few texts at a time are Python's.
            places = [words.numbers(units(x) if x else []) for i in range(0, len(texts), _TEXTS_AT_ONCE)
                      for x in texts.slice(i, _TEXTS_AT_ONCE).to_pylist()]
            kept, names = block.select(list(keep)), words.words()
            del block, texts, words
            name = block_name(sequence, len(names))
            found = Units(names, pair)
            del names
            places = [x if found.good[x].all() else x[:0] for x in places]
            many = found.documents_by_pair(places)
            bucket = (mix(found.pairs.astype(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            position = np.empty(len(order), np.int64)
            position[order] = np.arange(len(order))
            yield from documents(kept, name, places, found)
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            of_block = [found.n_pairs, position[found.link_pair], found.link_times, found.pairs[order] >> 32, found.pairs[order] & 0xFFFFFFFF,
                        many[order], np.diff(cuts)]
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, f.type) for f in kept.schema], pa.array([name]), pa.nulls(1, pa.binary()),
                 *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.array([pack(x)], pa.binary()) for x in of_block]],
                names=schema.fieldNames())
            # A suspended generator holds its names, and workers outlive their tasks.
            del kept, places, found, many, bucket, order, position, of_block
            give_back()

    def documents(kept, name, places, found):
        for start in range(0, len(places), 2000):
            part = places[start:start + 2000]
            at, flat = _bounds(np.array([len(x) for x in part], np.int64)), np.concatenate(part)
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[flat])])[at])
            digests = [sha256(";".join(map(found.texts.__getitem__, x.tolist())).encode()).hexdigest() if len(x) else "" for x in part]
            rows = kept.slice(start, 2000).combine_chunks()
            columns = [c.chunk(0) if c.num_chunks else pa.nulls(0, c.type) for c in rows.columns]
            totals = [total(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array([name] * len(part)), pa.array([pack(x) if len(x) else b"" for x in part], pa.binary()),
                 *[pa.array(x, pa.int64()) for x in totals], pa.array(digests, pa.string()),
                 *[pa.nulls(len(part), pa.binary())] * len(block_fields)], names=schema.fieldNames())

    made = stage(docs.select(*dict.fromkeys([*keep, text])).mapInArrow(aligned, schema), "aligned")
    of_blocks = made.where(F.col(p).isNull())

    def as_lists(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (b, "_pair_a", "_pair_b", "_pair_docs", "_pair_bucket")]
            for name, *packed in zip(*columns):
                a, b_, many, sizes = map(unpack, packed)
                at = _bounds(sizes)
                for i in np.flatnonzero(sizes):
                    part = slice(at[i], at[i + 1])
                    yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([name]), *[pa.array([pack(x[part])], pa.binary()) for x in (a, b_, many)]],
                                                     names=["bucket", "block", "a", "b", "docs"])

    def summed(group: pa.Table) -> pa.Table:
        give_back()
        lists = [[unpack(x) for x in group.column(c).to_pylist()] for c in ("a", "b", "docs")]
        a, b_, many = map(np.concatenate, lists)
        pairs, inverse = np.unique(a << 32 | b_, return_inverse=True)
        totals = np.bincount(inverse, weights=many, minlength=len(pairs)).astype(np.int64)
        at = _bounds(np.array([len(x) for x in lists[0]]))
        ids, first = np.unique(pairs >> 32, return_index=True)
        best = np.maximum.reduceat(totals, first)
        n = len(group)
        answers = [pack(totals[inverse[i:j]]) for i, j in zip(at, at[1:])]
        return pa.table({"block": pa.array([*group.column("block").to_pylist(), None]), "bucket": pa.array([*group.column("bucket").to_pylist(), None], pa.int32()),
                         "totals": pa.array([*answers, None], pa.binary()),
                         "ids": pa.array([None] * n + [ids.tolist()], pa.list_(pa.int64())), "best": pa.array([None] * n + [best.tolist()], pa.list_(pa.int64()))})

    lists = of_blocks.select(b, "_pair_a", "_pair_b", "_pair_docs", "_pair_bucket").mapInArrow(as_lists, "bucket int, block string, a binary, b binary, docs binary")
    answers = stage(lists.groupBy("bucket").applyInArrow(
        summed, "block string, bucket int, totals binary, ids array<long>, best array<long>"), "pairs")
    each = answers.where("block IS NULL").select(F.explode(F.arrays_zip("ids", "best")).alias("x")).select("x.ids", "x.best")
    # No longer than the vocabulary of A.
    highest = {r.ids: r.best for r in each.groupBy("ids").agg(F.max("best").alias("best")).collect()}
    most = np.zeros(max(highest, default=0) + 1, np.int64)
    most[list(highest)] = list(highest.values())

    out_schema = T.StructType([*fields, *[T.StructField(n, T.LongType()) for n in (*sums[:4], *sums[5:])], T.StructField(sums[4], T.StringType())])

    def placed(left: pa.Table, right: pa.Table) -> pa.Table:
        give_back()
        own = np.asarray(left.column(p).is_null())
        block, rows = left.filter(pa.array(own)), left.filter(pa.array(~own))
        if len(block) != 1:
            raise ValueError("a block came twice or not at all")
        n_pairs, link_pair, link_times, pair_a = (unpack(block.column(f"_{c}")[0].as_py()) for c in block_fields[:4])
        order = np.argsort(right.column("bucket").to_numpy()) if len(right) else []
        totals = np.concatenate([np.zeros(0, np.int64), *[unpack(right.column("totals")[int(i)].as_py()) for i in order]])
        if len(totals) != len(pair_a):
            raise ValueError("answers are missing")
        at = _bounds(n_pairs)
        by_unit = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[link_pair] * link_times)])[at])
        best, count = by_unit((totals == most[pair_a]).astype(np.int64)), by_unit(totals)
        places = [unpack(x) if x else np.zeros(0, np.int64) for x in rows.column(p).to_pylist()]
        sums_ = [[int(x[y].sum()) for y in places] for x in (best, count)]
        out = rows.select([*keep, *sums[:4]])
        for name, values in zip(sums[5:], sums_):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out.append_column(sums[4], rows.column(sums[4]))

    carried = made.drop("_pair_b", "_pair_docs", "_pair_bucket")
    replies = answers.where("block IS NOT NULL").select("block", "bucket", "totals")
    return carried.groupBy(b).cogroup(replies.groupBy("block")).applyInArrow(placed, out_schema)

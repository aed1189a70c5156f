"""Byte-pair encoding by a table of distinct words, and decoding by a table of pieces."""

from __future__ import annotations

import json
import math
import os
import re
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import Vocabulary, block_name, give_back, pack, table_blocks, unpack, word_hashes
from .common import fresh

# Text for which a bucket of words is made; a block has about one distinct word for 40 bytes.
BYTES_PER_BUCKET = 20 << 20
_WORDS_AT_ONCE = 8192
_PLACES_AT_ONCE = 1 << 18
_TEXTS_AT_ONCE = 500
_CLOSE_SPACES = re.compile(r"\s\s")
_WORD_START = re.compile(r"(?<=\S)(?= \S)")


def units(text: str, specials: re.Pattern | None) -> list[str]:
    """The text cut where the byte-level pre-tokenizer always cuts: before a space that a word follows, around a line
    feed between two words, and around special tokens. Encoding the parts one by one gives the ids of the whole.

    The pre-tokenizer takes one leading space into a word, and gives a run of white space all but its last
    character; so where white space stands next to white space, only spaces between two words are cuts.
    """
    if specials is not None and specials.search(text):
        return [u for i, part in enumerate(specials.split(text)) if part
                for u in ([part] if i % 2 else units(part, None))]
    if _CLOSE_SPACES.search(text):
        return _WORD_START.split(text)
    out: list[str] = []
    for i, line in enumerate(text.split("\n")):
        if i:
            out.append("\n")
        first, *rest = line.split(" ")
        if first:
            out.append(first)
        out.extend([" " + word for word in rest])
    return out


def number_words(texts: pa.ChunkedArray, specials: re.Pattern | None, places: bool = True) -> tuple[list[bytes], pa.Array, int]:
    """Packed numbers of every text's units (not wanted for words alone), the distinct units in the order of their
    numbers, and a digest of them.

    Few texts at a time are Python's, and the words leave as one Arrow array: as objects they take ten times as much.
    """
    vocabulary, packed = Vocabulary(), []
    for start in range(0, len(texts), _TEXTS_AT_ONCE):
        for text in texts.slice(start, _TEXTS_AT_ONCE).to_pylist():
            numbers = vocabulary.numbers(units(text, specials)) if text else None
            if places:
                packed.append(b"" if numbers is None else pack(numbers))
    words = pa.array(vocabulary.words(), pa.large_string())
    digest = xxhash.xxh3_64()
    for buffer in words.buffers()[1:]:
        digest.update(memoryview(buffer or b""))
    return packed, words, digest.intdigest()


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed public tokenizers are; any tokenizer file of that form will do."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read_vocabulary(path: str) -> str:
    """The tokenizer file's JSON; a vocabulary has a fixed size and travels with the tasks."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def _special_pattern(vocabulary: str) -> re.Pattern | None:
    added = json.loads(vocabulary).get("added_tokens") or []
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError("special tokens that take white space or whole words with them are not supported")
    names = sorted((t["content"] for t in added), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None


_made: dict = {}


def _tokenizer(vocabulary: str):
    """The vocabulary's tokenizer, made once in each Python worker."""
    key = xxhash.xxh3_128_digest(vocabulary.encode())
    if key not in _made:
        _made[key] = _new_tokenizer(vocabulary)
    return _made[key]


def _new_tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def pieces(vocabulary: str) -> list[bytes]:
    """Bytes of every id: the vocabulary writes each byte as one printable character."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    table = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
    loaded = json.loads(vocabulary)
    names = {i: t for t, i in loaded["model"]["vocab"].items()} | {t["id"]: t["content"] for t in loaded.get("added_tokens") or []}
    return [bytes(map(table.__getitem__, t)) if all(c in table for c in t) else t.encode()
            for t in (names.get(i, "") for i in range(max(names) + 1))]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with its text column replaced by the token ids, an array of integers in ``ids``.

    1. Texts are split into words; a block of documents (16 MB of text) becomes numbers of its own vocabulary. Only
       numbers, compressed, travel on, and each word of a block once.
    2. The blocks' words meet in buckets by hash, and each distinct word of the corpus is encoded once. A word that
       every text holds has one entry for each block, not one for each use, so no bucket is hot; the number of
       buckets grows with the text, so they stay bounded.
    3. Ids go back to (block, number) and meet the block's documents, where they are put in place by position.

    Bounded memory: a block and its vocabulary, or a bucket of words. Null and empty texts give an empty array. Repeated rows are encoded
    alike, an empty table gives an empty result, other columns pass through, one named as ``ids`` is replaced. Both
    passes over ``docs`` must see the same rows in the same order, as files give them; else the job fails.
    """
    specials = _special_pattern(vocabulary)
    others = [c for c in docs.columns if c not in (text, ids)]
    b, p = fresh(docs, "_block"), fresh(docs, "_places")
    narrow = docs.select(*others, text)
    size = docs.agg(F.sum(F.octet_length(text)).alias("s")).first().s or 0
    buckets = max(1, math.ceil(size / BYTES_PER_BUCKET))

    def as_numbers(batches):
        for sequence, block in enumerate(table_blocks(batches, text)):
            places, _, digest = number_words(block.column(text), specials)
            out = block.drop_columns([text]).append_column(b, pa.array([block_name(sequence, digest)] * len(block), pa.string()))
            yield from out.append_column(p, pa.array(places, pa.binary())).to_batches(max_chunksize=2000)
            del block, out, places
            give_back()

    def as_words(batches):
        for sequence, block in enumerate(table_blocks(batches, text)):
            _, words, digest = number_words(block.column(text), specials, places=False)
            name = block_name(sequence, digest)
            del block
            lengths = np.diff(np.asarray(words.buffers()[1]).view(np.int64)[:len(words) + 1]) if len(words) else np.zeros(0, np.int64)
            hashes = [word_hashes(words.slice(i, _WORDS_AT_ONCE).cast(pa.large_binary()).to_pylist()) for i in range(0, len(words), _WORDS_AT_ONCE)]
            bucket = (np.concatenate([np.zeros(0, np.uint64), *hashes]) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            for i in np.flatnonzero(np.diff(cuts)):
                at = order[cuts[i]:cuts[i + 1]]
                chars = pa.compress(words.take(pa.array(at)).buffers()[2].slice(0, int(lengths[at].sum())), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([name]), pa.array([pack(at)]), pa.array([pack(lengths[at])]), pa.array([chars])],
                    names=["bucket", "block", "at", "lengths", "chars"])
            del words, lengths, hashes, bucket, order
            give_back()

    def encoded(group: pa.Table) -> pa.Table:
        give_back()
        lengths = [unpack(x) for x in group.column("lengths").to_pylist()]
        chars = [pa.decompress(c, decompressed_size=int(n.sum()), codec="zstd", asbytes=True)
                 for c, n in zip(group.column("chars").to_pylist(), lengths)]
        bounds = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
        words = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(b"".join(chars))).dictionary_encode()
        tokenizer, counts, flat = _tokenizer(vocabulary), [], []
        for i in range(0, len(words.dictionary), _WORDS_AT_ONCE):
            part = [e.ids for e in tokenizer.encode_batch_fast(words.dictionary[i:i + _WORDS_AT_ONCE].to_pylist(), add_special_tokens=False)]
            counts.append(np.fromiter(map(len, part), np.int64, len(part)))
            flat.append(np.fromiter(chain.from_iterable(part), np.int32, int(counts[-1].sum())))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
        every = pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate(flat))).take(words.indices)
        offsets, flat, start, out = np.asarray(every.offsets), np.asarray(every.values), 0, []
        for n in lengths:
            mine = offsets[start:start + len(n) + 1]
            out.append((pack(np.diff(mine)), pack(flat[mine[0]:mine[-1]])))
            start += len(n)
        return pa.table({"block": group.column("block").combine_chunks(), "at": group.column("at").combine_chunks(),
                         "counts": pa.array([x for x, _ in out], pa.binary()), "ids": pa.array([y for _, y in out], pa.binary())})

    schema = T.StructType([*[docs.schema[c] for c in others], T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def placed(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            raise ValueError("the two passes over the documents differ; stage the input first")
        give_back()
        parts = lambda name: [np.zeros(0, np.uint32), *map(unpack, right.column(name).to_pylist())]
        order = np.argsort(np.concatenate(parts("at")))
        counts, flat = np.concatenate(parts("counts")), np.concatenate(parts("ids")).astype(np.int32)
        starts, lengths = (np.cumsum(counts, dtype=np.int64) - counts)[order], counts[order].astype(np.int64)
        packed, done, chunks = left.column(p).to_pylist(), 0, []
        while done < len(packed):
            # Some rows at a time: positions are many times as long as what is packed.
            rows, held = [], 0
            while done < len(packed) and (not rows or held < _PLACES_AT_ONCE):
                rows.append(unpack(packed[done]) if packed[done] else np.zeros(0, np.uint32))
                held += len(rows[-1])
                done += 1
            where = np.concatenate(rows)
            if len(where) and where.max() >= len(starts):
                raise ValueError("the two passes over the documents differ; stage the input first")
            n = lengths[where]
            ends = np.cumsum(n)
            at = np.repeat(starts[where] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
            bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)]
            chunks.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat[at], pa.int32())))
        return left.select(others).append_column(ids, pa.chunked_array(chunks, pa.list_(pa.int32())))

    carried = T.StructType([*[docs.schema[c] for c in others], T.StructField(b, T.StringType()), T.StructField(p, T.BinaryType())])
    numbers = narrow.mapInArrow(as_numbers, carried)
    lists = narrow.mapInArrow(as_words, "bucket int, block string, at binary, lengths binary, chars binary")
    table = lists.groupBy("bucket").applyInArrow(encoded, "block string, at binary, counts binary, ids binary")
    return numbers.groupBy(b).cogroup(table.groupBy("block")).applyInArrow(placed, schema)


def decode(tokens: DataFrame, vocabulary: str, ids: str = "ids", text: str = "text", digest: str | None = None) -> DataFrame:
    """``tokens`` with ``text``, the joined pieces of every row's ids, specials included.

    The id-to-piece table is as long as the vocabulary, so each task holds it, and ids meet their pieces by a gather.
    Bytes that are not UTF-8 become the replacement character. Null ids give an empty text. ``digest`` names a
    column for the SHA-256 of the ids as little-endian unsigned 32-bit integers.
    """
    table = pieces(vocabulary)
    keep = [c for c in tokens.columns if c not in (text, digest)]
    fields = [*[tokens.schema[c] for c in keep], T.StructField(text, T.StringType())]
    fields += [T.StructField(digest, T.StringType())] if digest else []

    def decoded(part: pa.RecordBatch, by_id: pa.Array) -> pa.RecordBatch:
        lists = part.column(ids).fill_null([])
        flat, bounds = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        joined = by_id.take(flat)
        at = np.frombuffer(joined.buffers()[1], np.int64)[:len(flat) + 1][bounds] if len(flat) else bounds * 0
        data = joined.buffers()[2].to_pybytes() if len(flat) else b""
        texts = [data[x:y].decode("utf-8", "replace") for x, y in zip(at, at[1:])]
        arrays = [part.column(c) for c in keep] + [pa.array(texts, pa.string())]
        if digest:
            numbers = np.asarray(flat, dtype="<u4")
            arrays.append(pa.array([sha256(numbers[x:y].tobytes()).hexdigest() for x, y in zip(bounds, bounds[1:])], pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])

    def run(batches):
        by_id = pa.array(table, pa.large_binary())
        for batch in batches:
            for start in range(0, len(batch), 1000):
                yield decoded(batch.slice(start, 1000), by_id)
            del batch
            give_back()

    return tokens.select(*keep).mapInArrow(run, T.StructType(fields))

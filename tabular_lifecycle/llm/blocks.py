"""Blocks of documents inside a task: texts as numbers of the block's own vocabulary, and hashes of words."""

from __future__ import annotations

import ctypes
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

BLOCK_BYTES = 16 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table_blocks(batches: Iterable[pa.RecordBatch], text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """The task's rows in their order, cut into tables of about ``block_bytes`` of text (at least one row each)."""
    held, size = [], 0
    for batch in batches:
        lengths = np.diff(np.frombuffer(batch.column(text).cast(pa.large_string()).buffers()[1], np.int64)[
            batch.column(text).offset:][:len(batch) + 1]) if len(batch) else np.zeros(0, np.int64)
        start = 0
        while start < len(batch):
            room = np.searchsorted(np.cumsum(lengths[start:]), max(1, block_bytes - size)) + 1
            part = batch.slice(start, min(room, len(batch) - start))
            held.append(part)
            size += int(lengths[start:start + len(part)].sum())
            start += len(part)
            if size >= block_bytes:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def block_name(sequence: int, digest: int) -> str:
    """Partition, number of the block in it and a digest of its vocabulary.

    Both passes over a table must cut it alike. Files do; for an input whose rows come in another order each time, the
    digest differs and the join of the two passes fails instead of mixing up numbers: stage such an input first.
    """
    return f"{TaskContext.get().partitionId()}-{sequence}-{digest & (2**64 - 1):016x}"


class Vocabulary:
    """Numbers from 0 in the order of first use."""

    def __init__(self):
        self._numbers = defaultdict(count().__next__)

    def numbers(self, words: list) -> np.ndarray:
        return np.fromiter(map(self._numbers.__getitem__, words), np.uint32, len(words))

    def words(self) -> list:
        return list(self._numbers)


def give_back() -> None:
    """Hand freed memory back to the machine: Python workers outlive their tasks, and what they keep counts for the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lower_words(text: str | None) -> list[bytes]:
    """Words between [\\x20\\x09-\\x0D], A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def pack(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, compressed: their low halves, then their high ones, which are mostly zero."""
    wide = np.ascontiguousarray(numbers, "<u4")
    halves = np.concatenate([wide & 0xFFFF, wide >> 16]).astype("<u2")
    return len(wide).to_bytes(4, "little") + pa.compress(halves.tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:4], "little")
    halves = np.frombuffer(pa.decompress(data[4:], decompressed_size=4 * n, codec="zstd", asbytes=True), "<u2").astype(np.uint32)
    return halves[:n] | halves[n:] << np.uint32(16)

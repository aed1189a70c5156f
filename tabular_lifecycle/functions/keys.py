"""Repeatable pseudo-random values from the row itself.

A hash of seed and row key does not depend on partitioning, so a recomputed task draws the same
numbers again, and another engine can draw them too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(keys: Sequence[str], seed: int) -> Column:
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """32 hexadecimal digits that put the rows in a random but repeatable order."""
    return _digest(keys, seed)


def row_noise(keys: Sequence[str], seed: int, max_noise: int = 20) -> Column:
    """One whole number in [0, max_noise] per row."""
    head = F.conv(F.substring(_digest(keys, seed), 1, 8), 16, 10).cast("bigint")
    return head % F.lit(max_noise + 1)

"""Reproducible pseudo-random order from a row key.

The hash text is built from integers and strings only, so every engine that
knows md5 gives the same order; nothing depends on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

HASH_BITS = 32


def key_text(keys: Sequence[str], seed: int) -> Column:
    parts = [F.col(k).cast("string") for k in keys]
    return F.concat_ws("|", *parts, F.lit(str(seed)))


def hash_order(keys: Sequence[str], seed: int = 42) -> Column:
    """Unsigned 32-bit number from the first eight hex digits of md5(key|seed)."""
    h = F.conv(F.substring(F.md5(key_text(keys, seed)), 1, 8), 16, 10).cast("bigint")
    # never null; saying so spares joins on it a null filter that would hash every row again
    return F.coalesce(h, F.lit(0).cast("bigint"))


def hash_rank_key(keys: Sequence[str], seed: int = 42) -> Column:
    """Sortable struct: the hash first, then the key itself against collisions."""
    return F.struct(hash_order(keys, seed).alias("h"), *[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])

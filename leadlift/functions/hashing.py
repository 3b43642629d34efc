"""Repeatable pseudo-random numbers from keys.

A task that runs twice after a lost executor draws the same numbers, which
``rand()`` does not promise once row order changes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _digest(keys: tuple[str | Column, ...], seed: int) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def hash_uniform(*keys: str | Column, seed: int) -> Column:
    """Uniform double in [0, 1) that depends only on the key values and the seed."""
    head = F.substring(_digest(keys, seed), 1, 8)
    return F.conv(head, 16, 10).cast("double") / F.lit(4294967296.0)


def hash_limit(share: Column) -> Column:
    """The text that the hashes of ``hash_below`` are less than for this share of keys."""
    first_out = F.ceil(F.greatest(share, F.lit(0.0)) * 4294967296.0)
    digits = F.lower(F.lpad(F.hex(first_out), 8, "0"))
    # No digit stands after an f. A share of 0 or none has no limit.
    return F.when(first_out >= 4294967296, "g").when((share > 0) & (first_out > 0), digits)


def hash_below(limit: Column, *keys: str | Column, seed: int) -> Column:
    """Whether ``hash_uniform`` of the keys is below the share of ``limit``: hexadecimal digits compare as their numbers do."""
    return limit > _digest(keys, seed)


"""Uniform numbers from hashed keys: the same for every partitioning and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key(*parts: Column | str | int) -> Column:
    return F.concat_ws("|", *(F.lit(str(p)) if isinstance(p, (str, int)) else p.cast("string") for p in parts))


def uniform(*parts: Column | str | int) -> Column:
    """A double in [0, 1) from the first 32 bits of the key's MD5."""
    return F.conv(F.substring(F.md5(key(*parts)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def hash_order(*parts: Column | str | int) -> Column:
    """A text whose order is random but fixed by the key."""
    return F.md5(key(*parts))

"""Seeded order keys: md5 of ``seed:part:part…``, the same value in any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: int | str, *parts: Column | str) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def key_word(key: Column) -> Column:
    """The first 32 bits of an order key as a number in [0, 2^32)."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def unit_draw(key: Column) -> Column:
    """Uniform in (0, 1]."""
    return (key_word(key) + 1) / F.lit(float(2**32 + 1))

"""Row predicates. Cheap tests stand before dear ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed
from .text import py_strip


def letter_profile(
    c: Column,
    required: str = fixed.REQUIRED_LETTERS,
    forbidden: str = fixed.FORBIDDEN_LETTERS,
    min_chars: int = fixed.MIN_PROFILE_CHARS,
    max_ratio: float = fixed.MAX_FORBIDDEN_RATIO,
) -> Column:
    """Long enough, holds a required letter, and at most ``max_ratio`` forbidden letters."""
    low, n = F.lower(c), F.length(c)
    ok = (
        (n >= min_chars)
        & low.rlike(f"[{required}]")
        & (F.try_divide(F.regexp_count(low, F.lit(f"[{forbidden}]")), n) <= max_ratio)
    )
    return F.coalesce(ok, F.lit(False))


def min_length(c: Column, n: int = fixed.MIN_TEXT_CHARS, strict: bool = False) -> Column:
    """Raw length, before cleaning: strictly above ``n`` (books, wiki) or at least ``n`` (web)."""
    return F.length(c) > n if strict else F.length(c) >= n


def length_between(c: Column, low: int = fixed.MIN_CODE_CHARS, high: int = fixed.MAX_CODE_CHARS) -> Column:
    return (F.length(c) > low) & (F.length(c) < high)


def not_blank(c: Column) -> Column:
    return py_strip(c) != ""

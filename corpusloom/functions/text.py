"""Cleaning expressions. All run inside the JVM except ``normalize_nfc`` (Arrow)."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed


def strip_role_headers(c: Column) -> Column:
    """Delete each header marker with everything up to the next newline.

    ``[^\\n]*`` instead of ``.*?``: Java's dot also stops at other line separators.
    """
    marker = fixed.HEADER_MARKER.replace("|", r"\|")
    return F.regexp_replace(c, marker + r"[^\n]*\n", "")


def strip_markers(c: Column) -> Column:
    """Delete the markers one kind after the other; a deletion may complete a later kind."""
    for marker in fixed.MARKERS:
        c = F.replace(c, F.lit(marker), F.lit(""))
    return c


def py_strip(c: Column) -> Column:
    return F.btrim(c, F.lit(fixed.WHITESPACE))


def sanitize_text(c: Column) -> Column:
    """Headers, then markers, then outer white space. Null becomes empty text.

    Every header and marker starts with ``<|``; text without it, nearly all text, skips the
    nine passes.
    """
    bare = F.when(F.contains(c, F.lit("<|")), strip_markers(strip_role_headers(c))).otherwise(c)
    return F.coalesce(py_strip(bare), F.lit(""))


def drop_invalid_utf8(c: Column) -> Column:
    """Drop undecodable bytes. Text that is valid as it stands keeps its U+FFFD characters."""
    return F.when(F.is_valid_utf8(c), c).otherwise(
        F.replace(F.make_valid_utf8(c), F.lit("�"), F.lit(""))
    )


@F.arrow_udf(T.StringType())
def _nfc(values: pa.Array) -> pa.Array:
    return pa.array([v if v is None else unicodedata.normalize("NFC", v) for v in values.to_pylist()], pa.string())


def normalize_nfc(c: Column) -> Column:
    """NFC, then the literal two-character-and-plus string ``\\s+`` becomes a space.

    The reference hands a pattern to a replacer that reads it literally; runs of white space
    stay as they are. Pure ASCII is NFC already and never leaves the JVM.
    """
    needs = F.when(c.rlike(r"[^\x00-\x7F]"), c)
    return F.replace(F.coalesce(_nfc(needs), c), F.lit(r"\s+"), F.lit(" "))


def utf8_bytes(c: Column, newline: bool = False) -> Column:
    n = F.octet_length(c)
    return (n + 1 if newline else n).cast("bigint")


def split_lines(c: Column) -> Column:
    """Lines at ``\\n`` or ``\\r\\n``; empty lines are left out, blank ones stay."""
    return F.filter(F.split(c, "\r?\n"), lambda line: line != "")

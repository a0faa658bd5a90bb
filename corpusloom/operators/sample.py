"""Upsampling, caps and byte-bounded samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import key_word, order_key
from ..functions.predicates import not_blank
from ..functions.text import utf8_bytes
from .order import prefix_sum, quantile_bucket


def upsample(df: DataFrame, n: int | Column) -> DataFrame:
    """Each row ``n`` times, ``copy_no`` 1 … n: a narrow explode."""
    n = F.lit(n) if isinstance(n, int) else n
    return df.withColumn("copy_no", F.explode(F.sequence(F.lit(1), n)))


def cap_per_source(
    df: DataFrame,
    limit: int,
    *,
    source: str = "source",
    order: str = "doc_id",
    eligible: Column | None = None,
    out: str = "nth",
) -> DataFrame:
    """The first ``limit`` rows of each source, in source order; ``out`` counts from 0.

    ``eligible`` counts only rows that pass it (and keeps only those); without it every row
    counts, whatever formatting makes of it later. Ranks come from bucket totals, so a huge
    source is neither sorted in one task nor shuffled beyond the buckets that reach the cap.
    """
    rows = df if eligible is None else df.filter(eligible)
    cut = quantile_bucket(rows, order)
    return prefix_sum(cut, [order], 1, by=[source], bucket="__bucket", stop=limit, out=out).drop("__bucket")


def cluster_sample_files(
    df: DataFrame, limit: int, seed: int, *, file: str = "file", order: str = "line_no", out: str = "nth"
) -> DataFrame:
    """Rows of whole files in a seeded file order until ``limit`` rows are reached."""
    cut = quantile_bucket(df, order)
    return prefix_sum(
        cut, [order], 1, by=[file], then=[order_key(seed, file), F.col(file)],
        bucket="__bucket", stop=limit, out=out,
    ).drop("__bucket")


def head_by_bytes(
    lines: DataFrame, limit: int = fixed.SAMPLE_BYTES, *, file: str = "file", order: str = "line_no", line: str = "line"
) -> DataFrame:
    """Non-blank lines in file order until their bytes, newlines included, exceed ``limit``.

    The line that crosses the limit stays: a line is in when the bytes before it are at most
    ``limit``.
    """
    rows = lines.filter(not_blank(F.col(line)))
    cut = quantile_bucket(rows, order)
    return prefix_sum(
        cut, [order], utf8_bytes(F.col(line), newline=True), by=[file], then=[F.col(file)],
        bucket="__bucket", stop=limit + 1, out="bytes_before",
    ).drop("__bucket")


def bernoulli_by_bytes(
    lines: DataFrame,
    seed: int,
    target: int = fixed.SAMPLE_BYTES,
    slack: int = fixed.SAMPLE_SLACK_BYTES,
    *,
    file: str = "file",
    order: str = "line_no",
    line: str = "line",
    total: Column | None = None,
) -> DataFrame:
    """A line sample of about ``target`` bytes; every line when the files are smaller.

    Each non-blank line passes with p = target / total file bytes. Once the bytes taken reach
    ``target + slack`` a file adds no more lines, but every file gives its first passing line.
    Lines that do so are exactly: bytes taken before < target + slack, or first of their file.
    """
    if total is None:
        total = lines.agg(F.sum(utf8_bytes(F.col(line), newline=True))).scalar()
    everything = total < target
    passes = not_blank(F.col(line)) & (
        key_word(order_key(seed, file, order)) / F.lit(float(2**32)) < F.lit(float(target)) / total
    )
    rows = lines.filter(everything | passes)
    cut = quantile_bucket(rows, order)
    laid = prefix_sum(
        cut, [order], utf8_bytes(F.col(line)), by=[file], then=[F.col(file)],
        bucket="__bucket", out="bytes_before", group_start="__file_start",
    )
    # Passing lines are never blank, so only a file's first one has no bytes of its file before it.
    first = F.col("bytes_before") == F.col("__file_start")
    keep = everything | (F.col("bytes_before") < target + slack) | first
    return laid.filter(keep).drop("__bucket", "__file_start")


def top_k(df: DataFrame, k: int, count: str, ties: Sequence[str]) -> DataFrame:
    """Rows with the ``k`` largest counts, ties in name order (``TakeOrderedAndProject``)."""
    return df.orderBy(F.col(count).desc(), *ties).limit(k)

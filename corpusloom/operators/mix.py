"""Bringing sources together: union, uniform interleave, windowed shuffle."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import order_key, unit_draw
from .order import prefix_sum, quantile_bucket, window_shuffle

# Gaps are counted in these units so that sums are whole numbers and equal in any grouping.
GAP_UNITS = 1 << 20


def union_sources(sources: Iterable[DataFrame | None]) -> DataFrame:
    """Bag union by column name; an absent source adds nothing."""
    return reduce(DataFrame.unionByName, [s for s in sources if s is not None])


def gap(seed: int, *ids: str) -> Column:
    """Exponential waiting time with mean 1, in ``GAP_UNITS``."""
    return F.floor(-F.ln(unit_draw(order_key(seed, *ids))) * GAP_UNITS).cast("bigint")


def interleave_uniform(
    df: DataFrame, seed: int, *, source: str = "source", order: str = "doc_id", ids: tuple[str, ...] = ("source", "doc_id")
) -> DataFrame:
    """Add ``arrival``, a position whose order draws uniformly among the sources still active.

    Every source is a Poisson process of rate 1: its n-th row sits at the sum of n exponential
    gaps. Waiting times have no memory, so at any moment each source that is not exhausted is
    equally likely to come next, whatever its size, and its own rows stay in order. The sums
    are running totals per source, over buckets rather than one task per source.
    """
    drawn = df.withColumn("__gap", gap(seed, *ids))
    cut = quantile_bucket(drawn, order)
    ties = [c for c in ids if c not in (source, order)]
    laid = prefix_sum(cut, [order, *ties], "__gap", by=[source], bucket="__bucket", out="__before")
    return laid.withColumn("arrival", F.col("__before") + F.col("__gap")).drop("__bucket", "__before", "__gap")


def mixed_position(
    df: DataFrame, n_sources: int, ids: tuple[str, ...] = ("source", "doc_id"), rows_per_bucket: int = 100_000
) -> DataFrame:
    """Row number along ``arrival``. A source passes about one row per ``GAP_UNITS``, so a stretch of
    ``rows_per_bucket / n_sources`` gaps holds at most about ``rows_per_bucket`` rows."""
    width = max(1, GAP_UNITS * rows_per_bucket // max(1, n_sources))
    bucket = F.floor(F.col("arrival") / width).cast("bigint")
    return prefix_sum(df, ["arrival", *ids], 1, bucket=bucket, out="position")


def mix(
    df: DataFrame, seed: int, n_sources: int, *, order: str = "doc_id", buffer: int = fixed.MIX_BUFFER,
    ids: tuple[str, ...] = ("source", "doc_id"),
) -> DataFrame:
    """Interleave, number, and shuffle in windows: adds ``position``, ``block`` and ``rank``."""
    laid = interleave_uniform(df, seed, order=order, ids=ids)
    return window_shuffle(mixed_position(laid, n_sources, ids), seed, "position", ids, buffer)

"""Token streams: cutting at end markers, looking at ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import eos_spans
from .order import prefix_sum, quantile_bucket, running


def split_at_eos(df: DataFrame, ids: str = "ids", eos_id: int = fixed.EOS_ID) -> DataFrame:
    """One row per sequence of an id array: adds ``seq_no`` from 0, replaces ``ids``.

    The end marker closes and belongs to its sequence; what follows the last one is a sequence
    too. Runs inside the row, without a shuffle.
    """
    rest = [c for c in df.columns if c != ids]
    spans = df.select(*rest, ids, F.posexplode(eos_spans(F.col(ids), eos_id)).alias("seq_no", "__span"))
    n = F.col("__span.last") - F.col("__span.first") + 1
    return spans.select(*rest, "seq_no", F.slice(ids, F.col("__span.first"), n).alias(ids))


def number_flat_sequences(flat: DataFrame, eos_id: int = fixed.EOS_ID) -> DataFrame:
    """Sequence number of each token in a flat ``(shard, pos, id)`` view, shards of any size."""
    ends = (F.col("id") == eos_id).cast("int")
    return prefix_sum(
        quantile_bucket(flat, "pos"), ["pos"], ends, by=["shard"], bucket="__bucket", out="seq_no"
    ).drop("__bucket")


def flatten_tokens(df: DataFrame, start: str = "start", ids: str = "ids") -> DataFrame:
    """Flat ``(pos, id)`` view of documents that know their start in the stream."""
    return df.select(F.posexplode(ids).alias("__i", "id"), start).select(
        (F.col(start) + F.col("__i")).alias("pos"), "id"
    )


def peek_tokens(
    df: DataFrame, start: int = 0, n: int = 200, *, order: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """Ids ``start`` … ``start + n - 1`` of the stream, a slice per document they touch.

    Bucket totals tell which stretch of the stream is needed; the rest is not sorted. A byte
    offset in a 16-bit stream is twice the token offset.
    """
    sized = df.withColumn("__n", F.size(ids))
    laid = running(sized, order, "__n", stop=start + n, out="start")
    first = F.greatest(F.lit(start) - F.col("start"), F.lit(0))
    stop = F.least(F.lit(start + n) - F.col("start"), F.col("__n").cast("bigint"))
    cut = F.slice(ids, (first + 1).cast("int"), (stop - first).cast("int"))
    return laid.filter(stop > first).select(
        order, (F.col("start") + first).alias("start"), cut.alias(ids)
    )

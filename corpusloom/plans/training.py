"""Training input and inspection of a token stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.arrays import clamp_ids
from ..functions.keys import order_key
from ..operators.encode import decode_bpe
from ..operators.order import cluster_grid, epochs, prefix_sum
from ..operators.pack import in_epochs, pack_stream, token_table, with_labels
from ..operators.tokens import peek_tokens


def clustered_stream(
    sizes: DataFrame, n_epochs: int, seed: int, *, order: str | Sequence[str] = "doc_id",
    limit_bytes: int = fixed.CLUSTER_BYTES, reshuffle: bool = True, shuffle: bool = True,
) -> DataFrame:
    """Documents ``(order…, n_tokens)`` laid end to end over several epochs: adds ``epoch``, ``cluster``, ``start``, ``end``.

    Clusters are permuted and documents inside them, drawn anew per epoch with ``reshuffle``. Without
    ``shuffle`` every epoch keeps the order of the documents.
    """
    order = [order] if isinstance(order, str) else list(order)
    sized = cluster_grid(sizes, "n_tokens", order, limit_bytes, total="__total")
    if not shuffle:
        first = F.col("bytes_before").cast("bigint") / 2
        placed = sized.withColumns({
            "start": first.cast("bigint"), "end": first.cast("bigint") + F.col("n_tokens"),
            "__total": (F.col("__total") / 2).cast("bigint"),
        })
        return in_epochs(placed.drop("n_tokens", "bytes_before"), n_epochs)
    rows = epochs(sized.drop("__total"), n_epochs)
    epoch = F.col("epoch") if reshuffle else F.lit(0)
    keyed = rows.withColumns(
        {"cluster_key": order_key(seed, epoch, "cluster"), "doc_key": order_key(seed, epoch, *order)}
    )
    # A cluster is bounded by its byte limit, so it can be a bucket of its own.
    bucket = F.concat_ws(":", F.format_string("%08d", "epoch"), "cluster_key", F.format_string("%012d", "cluster"))
    laid = prefix_sum(keyed, ["doc_key", *order], "n_tokens", bucket=bucket, out="start")
    return laid.withColumn("end", F.col("start") + F.col("n_tokens")).drop("n_tokens", "bytes_before")


def training_rows(
    docs: DataFrame, n_epochs: int, ctx: int, batch_size: int, vocab_size: int, seed: int,
    limit_bytes: int = fixed.CLUSTER_BYTES, *, order: str | Sequence[str] = "doc_id", reshuffle: bool = True,
    shuffle: bool = True,
) -> DataFrame:
    """Token documents to packed, clamped input and label rows over all epochs, each with the ``epoch`` it starts in.

    Token shards feed it directly: ``training_rows(read_token_shards(…), …, order=("shard", "start"))``.
    """
    sizes, tokens, order = token_table(docs.withColumn("ids", clamp_ids(F.col("ids"), vocab_size)), order)
    laid = clustered_stream(
        sizes, n_epochs, seed, order=order, limit_bytes=limit_bytes, reshuffle=reshuffle, shuffle=shuffle
    )
    return with_labels(pack_stream(laid, tokens, order, ctx + 1), batch_size)


def inspect_tokens(docs: DataFrame, vocab: DataFrame, start: int = 0, n: int = 200, order: str = "doc_id") -> DataFrame:
    """A stretch of the stream with its text, one row per document it touches."""
    peeked = peek_tokens(docs, start, n, order=order)
    return peeked.withColumn("text", decode_bpe(F.col("ids"), vocab))

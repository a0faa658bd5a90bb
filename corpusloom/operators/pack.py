"""Cutting an ordered stream of documents into rows of fixed length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import shift_inputs, shift_labels
from ..functions.keys import order_key
from ..session import stage
from .order import epochs, hex_bucket, prefix_sum, quantile_bucket


def token_table(
    df: DataFrame, order: str | Sequence[str], ids: str = "ids"
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The documents written once: ``(order…, n_tokens)`` for all work on the order, ``(order…, ids)`` to be joined
    when places are known, and the names that the order has in both. Nothing is encoded twice.

    The order is one unique column, or files and a unique place in them, as ``("shard", "start")``.
    """
    columns = [order] if isinstance(order, str) else list(order)
    names = [f"__o{i}" for i in range(len(columns))]
    keys = [F.col(c).alias(n) for c, n in zip(columns, names)]
    stored = stage(df.select(*keys, F.col(ids).alias("ids"), F.size(ids).alias("n_tokens")))
    return stored.select(*names, "n_tokens"), stored.select(*names, "ids"), names


def lay_out(sizes: DataFrame, order: Sequence[str], seed: int | None = None, total: str | None = None) -> DataFrame:
    """Add each document's place ``start`` … ``end`` in the stream, in ``order`` or, with a seed, shuffled."""
    if seed is None:
        files = list(order[:-1])
        laid = prefix_sum(
            quantile_bucket(sizes, order[-1]), [order[-1]], "n_tokens", bucket="__bucket", out="start", total=total,
            by=files, then=[F.col(c) for c in files] or None,
        ).drop("__bucket")
    else:
        keyed = sizes.withColumn("key", order_key(seed, *order))
        laid = prefix_sum(
            keyed, ["key", *order], "n_tokens", bucket=hex_bucket(keyed, "key"), out="start", total=total
        ).drop("key")
    return laid.withColumn("end", F.col("start") + F.col("n_tokens")).drop("n_tokens")


def _pieces(laid: DataFrame, length: int, period: int, keep: int, ids: str, by: list[str]) -> DataFrame:
    """``(row_id, at, piece)``: the parts of each document that fall in each row.

    The stream has periods of ``period`` tokens of which the first ``keep`` are used, cut in
    rows of ``length``.
    """
    per = keep // length
    whole = laid.filter(F.col("end") > F.col("start"))
    spread = whole.withColumn(
        "__p", F.explode(F.sequence(F.floor(F.col("start") / period), F.floor((F.col("end") - 1) / period)))
    )
    base = F.col("__p") * period
    if per == 1:
        low, high = base, base + keep
        rows = spread.select(*by, "start", ids, F.col("__p").alias("row_id"), F.greatest("start", low).alias("lo"),
                             F.least("end", high).alias("hi"))
    else:
        used = spread.select(*by, "start", ids, "__p", F.greatest("start", base).alias("__lo"),
                             F.least("end", base + keep).alias("__hi")).filter(F.col("__hi") > F.col("__lo"))
        first = F.floor((F.col("__lo") - base) / length)
        last = F.floor((F.col("__hi") - 1 - base) / length)
        parts = used.withColumn("__j", F.explode(F.sequence(first, last)))
        left = base + F.col("__j") * length
        rows = parts.select(*by, "start", ids, (F.col("__p") * per + F.col("__j")).alias("row_id"),
                            F.greatest("__lo", left).alias("lo"), F.least("__hi", left + length).alias("hi"))
    offset = (F.col("lo") - F.col("start") + 1).cast("int")
    size = (F.col("hi") - F.col("lo")).cast("int")
    return rows.filter(F.col("hi") > F.col("lo")).select(
        *by, "row_id", F.col("lo").alias("at"), F.slice(ids, offset, size).alias("piece")
    )


def pack_stream(
    laid: DataFrame, tokens: DataFrame, order: Sequence[str], length: int, *, period: int | None = None,
    keep: int | None = None,
) -> DataFrame:
    """Rows ``(row_id, tokens)`` of exactly ``length`` tokens from places ``start`` … ``end`` of documents.

    The ids join the places once. Documents are cut where rows end and each row puts its few pieces together: one
    shuffle of the tokens, and no row per token. The unfinished last row is left out. Where places have an
    ``epoch``, a row gets the epoch it starts in.
    """
    period, keep = period or length, keep or length
    epoch = ["epoch"] if "epoch" in laid.columns else []
    pieces = _pieces(laid.join(tokens, list(order)), length, period, keep, "ids", epoch)
    joined = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "piece"))), lambda x: x["piece"]))
    rows = pieces.groupBy("row_id").agg(joined.alias("tokens"), *[F.min("epoch").alias("epoch") for _ in epoch])
    return rows.filter(F.size("tokens") == length)


def with_labels(rows: DataFrame, batch_size: int) -> DataFrame:
    """Inputs, labels shifted once, and the batch a row belongs to."""
    rest = [c for c in rows.columns if c not in ("row_id", "tokens")]
    return rows.select(
        *rest, "row_id", F.floor(F.col("row_id") / batch_size).cast("bigint").alias("batch_id"),
        shift_inputs(F.col("tokens")).alias("input_ids"), shift_labels(F.col("tokens")).alias("labels"),
    )


def pack_rows(
    df: DataFrame, ctx: int, batch_size: int = 1, *, seed: int | None = None, order: str | Sequence[str] = "doc_id",
    discard_per_batch: bool = False,
) -> DataFrame:
    """Pack documents to rows of ``ctx + 1`` tokens: ``(row_id, batch_id, input_ids, labels)``.

    ``discard_per_batch`` loses ``batch_size`` tokens after every batch, as the reference's
    training loop does.
    """
    length = ctx + 1
    sizes, tokens, order = token_table(df, order)
    laid = lay_out(sizes, order, seed)
    if discard_per_batch:
        rows = pack_stream(laid, tokens, order, length, period=batch_size * (ctx + 2), keep=batch_size * length)
    else:
        rows = pack_stream(laid, tokens, order, length)
    return with_labels(rows, batch_size)


def pack_linear(
    df: DataFrame, ctx: int, batch_size: int, order: str | Sequence[str] = "doc_id", n_batches: int | None = None
) -> DataFrame:
    """File order, whole batches only; the tail shorter than one batch is dropped.

    ``n_batches``: so many batches; past the last whole batch the stream starts again at its first token.
    """
    length = ctx + 1
    sizes, tokens, order = token_table(df, order)
    laid = lay_out(sizes, order, total="__total")
    batch = batch_size * length
    usable = F.floor(F.col("__total") / batch) * batch
    rows = pack_stream(laid.withColumn("end", F.least("end", usable)).drop("__total"), tokens, order, length)
    if n_batches is not None:
        whole = sizes.agg((F.floor(F.sum("n_tokens") / batch) * batch_size).alias("whole"))  # one row
        last = F.lit(n_batches * batch_size) - 1 - F.col("row_id")
        again = F.when(last >= 0, F.sequence(F.lit(0), F.floor(last / F.col("whole")))).otherwise(F.array().cast("array<bigint>"))
        rows = rows.join(F.broadcast(whole), F.col("whole") > 0).withColumn("__round", F.explode(again))
        rows = rows.withColumn("row_id", F.col("row_id") + F.col("__round") * F.col("whole")).drop("whole", "__round")
    return with_labels(rows, batch_size)


def pack_across_epochs(
    df: DataFrame, n_epochs: int, ctx: int, batch_size: int = 1, *, seed: int, reshuffle: bool = True,
    shuffle: bool = True, order: str | Sequence[str] = "doc_id",
) -> DataFrame:
    """Several epochs as one endless stream: rows may begin in one epoch and end in the next.

    ``reshuffle`` draws a new order per epoch; without ``shuffle`` every epoch has the order of the documents.
    """
    sizes, tokens, order = token_table(df, order)
    if shuffle:
        key = order_key(seed, F.col("epoch"), *order) if reshuffle else order_key(seed, *order)
        keyed = epochs(sizes, n_epochs).withColumn("key", key)
        bucket = F.concat(F.format_string("%08d", "epoch"), hex_bucket(keyed, "key"))
        laid = prefix_sum(keyed, ["key", *order], "n_tokens", bucket=bucket, out="start")
        laid = laid.withColumn("end", F.col("start") + F.col("n_tokens"))
    else:
        laid = in_epochs(lay_out(sizes, order, total="__total"), n_epochs)
    return with_labels(pack_stream(laid.select(*order, "epoch", "start", "end"), tokens, order, ctx + 1), batch_size)


def in_epochs(laid: DataFrame, n_epochs: int) -> DataFrame:
    """Places of one unshuffled pass, with its length as ``__total``, repeated over the epochs."""
    rows = epochs(laid, n_epochs)
    past = F.col("epoch") * F.col("__total")
    return rows.withColumns({"start": F.col("start") + past, "end": F.col("end") + past}).drop("__total")

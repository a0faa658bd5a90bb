"""Running totals over a global order, and the orders built on them.

``prefix_sum`` is the one building block: rows fall in buckets that follow the order, a small
table holds one total per bucket, and only rows of one bucket meet in one task. No window ever
spans a whole source, file or corpus, so a source with a third of all rows is spread like any
other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.keys import order_key
from ..session import bucket_count, hex_digits, stage

# A table of bucket totals is broadcast only below this many rows (some 4 MiB).
BROADCAST_ROWS = 100_000


def hex_bucket(df: DataFrame, key: str, digits: int | None = None) -> Column:
    """Bucket of a hash key: its leading hex digits, even by construction."""
    return F.substring(key, 1, digits or hex_digits(df.sparkSession))


def quantile_bucket(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """Add ``__bucket`` for a numeric order column, cut at quantiles measured on the data.

    One pass over that one column. Buckets hold about equally many rows whatever the spread of
    the values, and so do the parts of a bucket that belong to one source or file.
    """
    n = buckets or bucket_count(df.sparkSession)
    value = df.select(F.col(column).cast("double").alias("v")).na.drop()
    cuts = value.approxQuantile("v", [i / n for i in range(1, n)], 1 / (4 * n))
    splits = [float("-inf"), *sorted(set(cuts or [0.0])), float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="__order", outputCol="__bucket", handleInvalid="keep")
    keyed = df.withColumn("__order", F.coalesce(F.col(column).cast("double"), F.lit(float("-inf"))))
    return cutter.transform(keyed).withColumn("__bucket", F.col("__bucket").cast("int")).drop("__order")


def prefix_sum(
    df: DataFrame,
    order: Sequence[Column | str],
    value: Column | str | int | dict[str, Column] = 1,
    *,
    by: Sequence[str] = (),
    bucket: Column | str,
    then: Sequence[Column] | None = None,
    stop: int | None = None,
    out: str = "before",
    total: str | None = None,
    group_start: str | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows that come earlier.

    order        unique order of the rows inside a bucket
    bucket       expression that never falls along ``order``
    by           groups that count on their own (sources, files, runs)
    then         order of the groups: one running total over all groups, laid end to end
    value        summed column; a dict of name to column adds one running total per name
    stop         keep only rows with ``out < stop``; buckets beyond it are dropped before the sort
    total        also add the sum of all values (of the group, or of everything with ``then``)
    group_start  also add the running total at the start of the row's group
    """
    spark = df.sparkSession
    if not isinstance(value, dict):
        value = {out: F.lit(value) if isinstance(value, int) else F.col(value) if isinstance(value, str) else value}
    values = {name: f"__v{i}" for i, name in enumerate(value)}
    out = next(iter(value))
    groups = [f"__g{i}" for i in range(len(by))]
    keyed = df.withColumns(
        {g: F.coalesce(F.col(c).cast("string"), F.lit("\0null")) for g, c in zip(groups, by)}
        | {"__b": F.col(bucket) if isinstance(bucket, str) else bucket}
        | {values[name]: c.cast("bigint") for name, c in value.items()}
    )
    keys = [*groups, "__b"]
    sums = [F.sum(v).alias(v) for v in values.values()]
    if then is not None:
        sums += [F.min(c).alias(f"__then{i}") for i, c in enumerate(then)]
    totals = keyed.groupBy(*keys).agg(*sums)
    if stop is not None:
        totals = stage(totals)  # one small row per bucket, read twice below

    def so_far(v: str, window) -> Column:
        return F.coalesce(F.sum(v).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    starts = totals.select(
        *[F.col(k).alias(f"{k}_s") for k in keys],
        *[so_far(v, Window.partitionBy(*groups).orderBy("__b")).alias(f"{v}_s") for v in values.values()],
        F.sum("__v0").over(Window.partitionBy(*groups)).alias("__everything"),
        F.lit(0).cast("bigint").alias("__gstart"),
    )
    if then is not None:
        names = [f"__then{i}" for i in range(len(then))]
        per_group = totals.groupBy(*groups).agg(
            *[F.sum(v).alias(v) for v in values.values()], *[F.min(n).alias(n) for n in names]
        )
        # One row per group: the list of files or sources, never their rows.
        along = Window.orderBy(*names, *groups)
        laid = per_group.select(
            *[F.col(g).alias(f"{g}_l") for g in groups],
            *[so_far(v, along).alias(f"{v}_l") for v in values.values()],
            F.sum("__v0").over(Window.partitionBy()).alias("__all"),
        )
        starts = starts.join(laid, [F.col(f"{g}_s") == F.col(f"{g}_l") for g in groups]).select(
            *[f"{k}_s" for k in keys],
            *[(F.col(f"{v}_s") + F.col(f"{v}_l")).alias(f"{v}_s") for v in values.values()],
            F.col("__all").alias("__everything"),
            F.col("__v0_l").alias("__gstart"),
        )
    small = False
    if stop is not None:
        # Buckets past the stop fall away; if few are left their rows need no shuffle to be dropped.
        starts = starts.filter(F.col("__v0_s") < stop)
        small = starts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    # Otherwise the join shares the shuffle of the window below and hashes the small side.
    starts = F.broadcast(starts) if small else starts.hint("shuffle_hash")

    inside = Window.partitionBy(*keys).orderBy(*order)
    joined = keyed.join(starts, [F.col(k) == F.col(f"{k}_s") for k in keys])
    added = {name: F.col(f"{v}_s") + so_far(v, inside) for name, v in values.items()}
    if total:
        added[total] = F.col("__everything")
    if group_start:
        added[group_start] = F.col("__gstart")
    result = joined.withColumns(added)
    if stop is not None:
        result = result.filter(F.col(out) < stop)
    helpers = [*keys, *values.values()]
    return result.drop(*helpers, *[f"{h}_s" for h in helpers], "__everything", "__gstart")


def running(df: DataFrame, column: str, value: Column | str | int = 1, **options) -> DataFrame:
    """``prefix_sum`` in the order of one unique numeric column, bucketed at its quantiles."""
    tie = options.pop("tie", ())
    cut = quantile_bucket(df, column)
    return prefix_sum(cut, [column, *tie], value, bucket="__bucket", **options).drop("__bucket")


def shuffle_docs(df: DataFrame, seed: int, id_col: str = "doc_id", key: str = "key") -> DataFrame:
    """Uniform permutation of whole documents: a global sort on a seeded hash of the id."""
    return df.withColumn(key, order_key(seed, id_col)).orderBy(key, id_col)


def with_shuffled_position(
    df: DataFrame, seed: int, id_col: str = "doc_id", value: Column | str | int = 1, out: str = "pos"
) -> DataFrame:
    """Position (or any running total) along the permutation of ``shuffle_docs``, unsorted."""
    keyed = df.withColumn("key", order_key(seed, id_col))
    return prefix_sum(keyed, ["key", id_col], value, bucket=hex_bucket(df, "key"), out=out)


def window_shuffle(
    df: DataFrame, seed: int, position: str, ids: Sequence[str], buffer: int = fixed.MIX_BUFFER
) -> DataFrame:
    """Cut a running order in blocks of ``buffer`` rows and redraw the order inside each block.

    Adds ``block`` and ``rank``; a block is bounded by ``buffer``, so ranking it is one small sort.
    """
    keyed = df.withColumns(
        {
            "block": F.floor(F.col(position) / buffer).cast("bigint"),
            "__key": order_key(seed, *ids),
        }
    )
    inside = Window.partitionBy("block").orderBy("__key", *ids)
    return keyed.withColumn("rank", (F.row_number().over(inside) - 1).cast("bigint")).drop("__key")


def epochs(df: DataFrame, n: int) -> DataFrame:
    """Repeat the rows for epochs 0 … n-1 (a narrow explode)."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def epoch_key(seed: int, id_col: str, reshuffle: bool = True) -> Column:
    """Order key of a document in its epoch; drawn anew per epoch when ``reshuffle``."""
    return order_key(seed, F.col("epoch"), id_col) if reshuffle else order_key(seed, id_col)


def cluster_grid(
    df: DataFrame, n_tokens: Column | str, order: str | Sequence[str] = "doc_id",
    limit_bytes: int = fixed.CLUSTER_BYTES, total: str | None = None,
) -> DataFrame:
    """Cluster number of consecutive documents on a fixed byte grid (2 bytes per token).

    A document belongs to the grid cell it starts in. Against the greedy rule the overshoot of
    a cluster is not carried on, and nothing has to be scanned in sequence. ``order`` is one
    numeric column, or files and a numeric place in them.
    """
    tokens = F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens
    *files, last = [order] if isinstance(order, str) else order
    laid = running(
        df, last, tokens * 2, out="bytes_before", by=files, then=[F.col(c) for c in files] or None, total=total
    )
    return laid.withColumn("cluster", F.floor(F.col("bytes_before") / limit_bytes).cast("bigint"))


#: Clusters per segment of ``cluster_greedy``; only sizes of documents meet in a segment.
SEGMENT_CLUSTERS = 32
#: Segments whose step functions are composed in one task.
SEGMENTS_TOGETHER = 16
STEPS = "segment bigint, upto bigint, opened bigint, closed bigint"
ENTRIES = "segment bigint, __opened bigint, __number bigint"


def _next_starts(ends: np.ndarray, opened: np.ndarray, limit: int) -> np.ndarray:
    """Where the next cluster starts, as an index into the segment, if one was opened at these bytes."""
    return np.searchsorted(ends, opened + limit, side="left") + 1


def _through(table: pd.DataFrame, opened: np.ndarray, closed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after one more segment; past its last step nothing closes."""
    at = np.searchsorted(table["upto"].to_numpy(), opened, side="left")
    met = at < len(table)
    at = np.minimum(at, len(table) - 1)
    return (
        np.where(met, table["opened"].to_numpy()[at], opened), closed + np.where(met, table["closed"].to_numpy()[at], 0),
    )


def compose_steps(pdf: pd.DataFrame) -> pd.DataFrame:
    """The step functions of consecutive segments, first to last, as one: ``(upto, opened, closed)``."""
    upto, opened, closed = (np.zeros(0, "int64") for _ in range(3))
    for _, table in pdf.sort_values(["segment", "upto"]).groupby("segment"):
        opened, closed = _through(table, opened, closed)
        # What was opened after the last step so far met no end yet: the new steps hold for it.
        more = table[table["upto"] > upto[-1]] if len(upto) else table
        upto, opened, closed = (
            np.concatenate([old, more[c].to_numpy()]) for old, c in ((upto, "upto"), (opened, "opened"), (closed, "closed"))
        )
        last = np.append((opened[1:] != opened[:-1]) | (closed[1:] != closed[:-1]), True)
        upto, opened, closed = upto[last], opened[last], closed[last]
    return pd.DataFrame({"upto": upto, "opened": opened, "closed": closed})


def _entries(tables: DataFrame, segments: int, together: int) -> DataFrame:
    """``(segment, __opened, __number)``: what each segment starts with."""

    def chain(pdf: pd.DataFrame, opened: int = 0, number: int = 0) -> pd.DataFrame:
        out, state = [], (np.array([opened]), np.array([number]))
        for segment, table in pdf.sort_values(["segment", "upto"]).groupby("segment"):
            out.append((segment, int(state[0][0]), int(state[1][0])))
            state = _through(table, *state)
        return pd.DataFrame(out, columns=["segment", "__opened", "__number"])

    if segments <= together:
        return tables.groupBy().applyInPandas(lambda pdf: chain(pdf), ENTRIES)
    grouped = tables.withColumn("group", F.floor(F.col("segment") / together).cast("bigint")).groupBy("group")

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        return compose_steps(pdf).assign(segment=pdf["group"].iloc[0])[["segment", "upto", "opened", "closed"]]

    above = _entries(stage(grouped.applyInPandas(whole, STEPS)), -(-segments // together), together)
    starts = above.withColumnRenamed("segment", "group").groupBy("group")
    return grouped.cogroup(starts).applyInPandas(
        lambda pdf, at: chain(pdf, int(at["__opened"].iloc[0]), int(at["__number"].iloc[0])), ENTRIES
    )


def cluster_greedy(
    sizes: DataFrame, order: str = "doc_id", limit_bytes: int = fixed.CLUSTER_BYTES,
    segment_clusters: int = SEGMENT_CLUSTERS, together: int = SEGMENTS_TOGETHER,
) -> DataFrame:
    """Greedy clusters over ``(order, n_tokens)`` rows: close once the bytes reach the limit.

    Exactly the clusters of one sequential scan, at any size. The stream is cut into segments of bytes. What a
    segment does depends on one number, the byte at which the cluster open at its begin was opened; as a
    function of it the byte opened last, and the clusters closed, are steps. The segments write down their steps
    in parallel; neighbours' functions are composed level by level, which keeps the steps of the first and adds
    none, so no task ever holds more than ``together`` segments' steps; the levels then fix, from the top down,
    what each segment starts with, and the segments number their documents in parallel.
    """
    segment_bytes = segment_clusters * limit_bytes
    laid = running(
        sizes.select(order, F.col("n_tokens").cast("bigint")), order,
        {"__bytes": 2 * F.col("n_tokens"), "__rank": F.lit(1)},
    ).withColumn("segment", F.floor(F.col("__bytes") / segment_bytes).cast("bigint"))

    def bounds(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
        pdf = pdf.sort_values("__rank", ignore_index=True)
        starts = pdf["__bytes"].to_numpy()
        return pdf, starts, starts + 2 * pdf["n_tokens"].to_numpy()

    def steps(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, starts, ends = bounds(pdf)
        n = len(pdf)
        # From a cluster opened at each document of the segment: the byte opened last, and how many close.
        last, closed = starts.copy(), np.zeros(n, "int64")
        follow = _next_starts(ends, starts, limit_bytes)
        for i in range(n - 1, -1, -1):
            j = follow[i]
            if j < n:
                last[i], closed[i] = last[j], closed[j] + 1
            elif j == n:
                last[i], closed[i] = ends[-1], 1
        # An earlier cluster closes with the document that reaches its limit: document k, if it was opened after
        # ends[k - 1] - limit and not after ends[k] - limit.
        reach = int(np.searchsorted(ends, starts[0] + limit_bytes, side="left"))
        rows = []
        for k in range(min(reach + 1, n)):
            out = (int(last[k + 1]), int(closed[k + 1]) + 1) if k + 1 < n else (int(ends[-1]), 1)
            if rows and rows[-1][1:] == out:
                rows[-1] = (int(ends[k]) - limit_bytes, *out)
            else:
                rows.append((int(ends[k]) - limit_bytes, *out))
        frame = pd.DataFrame(rows, columns=["upto", "opened", "closed"])
        return frame.assign(segment=pdf["segment"].iloc[0])[["segment", "upto", "opened", "closed"]]

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, starts, ends = bounds(pdf)
        cluster, opened, number, at = np.zeros(len(pdf), "int64"), pdf["__opened"].iloc[0], pdf["__number"].iloc[0], 0
        while at < len(pdf):
            end = int(_next_starts(ends, opened, limit_bytes))
            cluster[at:end] = number
            number += 1
            if end < len(pdf):
                opened = starts[end]
            at = end
        return pdf.assign(cluster=cluster)[[order, "n_tokens", "segment", "cluster"]]

    tables = stage(laid.groupBy("segment").applyInPandas(steps, STEPS))
    last = tables.agg(F.max("segment")).first()[0]
    entries = _entries(tables, 1 + (last or 0), together)
    return laid.join(entries, "segment").groupBy("segment").applyInPandas(
        assign, f"{order} bigint, n_tokens bigint, segment bigint, cluster bigint"
    )


def cluster_order_columns(seed: int, id_col: str, epoch: Column | None = None, cluster: Sequence[str] = ("cluster",)):
    """Sort columns that permute the clusters and the documents inside each, per epoch."""
    epoch = F.lit(0) if epoch is None else epoch
    return {
        "cluster_key": order_key(seed, epoch, *cluster),
        "doc_key": order_key(seed, epoch, id_col),
    }


def cluster_shuffle(df: DataFrame, seed: int, id_col: str = "doc_id", epoch: Column | None = None) -> DataFrame:
    """Global sort of clustered rows by cluster key, then document key."""
    names = cluster_order_columns(seed, id_col, epoch)
    return df.withColumns(names).orderBy("cluster_key", "cluster", "doc_key", id_col)

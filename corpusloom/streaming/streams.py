"""Streaming jobs. Transforms are stateless or windowed; sinks can be restarted.

``foreachBatch`` jobs write one folder per batch id and overwrite it when a batch is replayed,
so a restart from the checkpoint neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from .. import fixed
from ..functions.keys import order_key
from ..functions.layout import format_pretrain
from ..functions.predicates import min_length
from ..operators.encode import encode_bpe
from ..operators.filters import drop_empty_formatted
from ..operators.order import prefix_sum, quantile_bucket


def run_available(query: StreamingQuery) -> None:
    query.awaitTermination()


def append_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append rows as Parquet; the sink's log keeps a replayed batch from counting twice."""
    return (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_clean(docs: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Raw documents to formatted ones: filter, clean, lay out, drop empties. Stateless."""
    rows = docs.filter(min_length(F.col("text")) if predicate is None else predicate)
    return drop_empty_formatted(rows.select("doc_id", "source", format_pretrain(F.col("text")).alias("formatted")))


def stream_encode(docs: DataFrame, merges: DataFrame, vocab: DataFrame, text: str = "text") -> DataFrame:
    """Token ids of a stream of documents; narrow, so it overlaps with reading and writing."""
    rest = [c for c in docs.columns if c != text]
    return docs.select(*rest, encode_bpe(F.col(text), merges, vocab).alias("ids"))


def stream_cap(
    docs: DataFrame, limit: int, path: str, checkpoint: str, *, source: str = "source", order: str = "doc_id"
) -> StreamingQuery:
    """Admit exactly the first ``limit`` rows of each source, by batch and then by ``order``.

    The counts so far are a table of one row per source, one version per batch. A source that
    is full is dropped before any shuffle, and ranks inside a batch come from bucket totals, so
    a source that makes up most of the stream is not funnelled through one task.
    """
    rows_at, counts_at = f"{path}/rows", f"{path}/counts"

    def admit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = F.coalesce(F.col(source), F.lit("\0null"))
        batch = batch.withColumn("__name", name)
        if batch_id > 0:
            prior = spark.read.parquet(f"{counts_at}/batch={batch_id - 1}")
            batch = batch.join(prior, "__name", "left").withColumn("__had", F.coalesce("admitted", F.lit(0)))
            batch = batch.drop("admitted").filter(F.col("__had") < limit)
        else:
            prior = None
            batch = batch.withColumn("__had", F.lit(0).cast("bigint"))
        ranked = prefix_sum(
            quantile_bucket(batch, order), [order], 1, by=["__name"], bucket="__bucket", stop=limit, out="__nth"
        )
        taken = ranked.filter(F.col("__had") + F.col("__nth") < limit).drop("__bucket", "__had", "__nth")
        taken.write.mode("overwrite").parquet(f"{rows_at}/batch={batch_id}")
        written = spark.read.schema(taken.schema).parquet(f"{rows_at}/batch={batch_id}")
        counts = written.groupBy("__name").agg(F.count("*").alias("admitted"))
        if prior is not None:
            counts = counts.unionByName(prior).groupBy("__name").agg(F.sum("admitted").alias("admitted"))
        counts.write.mode("overwrite").parquet(f"{counts_at}/batch={batch_id}")

    return (
        docs.writeStream.foreachBatch(admit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


class _Admit(StatefulProcessor):
    """Counts a source's admitted rows and lets rows through up to the limit."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.admitted = handle.getValueState("admitted", "n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        had = before = self.admitted.get()[0] if self.admitted.exists() else 0
        for batch in rows:
            if had < self.limit:
                taken = batch.head(self.limit - had)
                had += len(taken)
                yield taken
        if had > before:
            self.admitted.update((had,))

    def close(self) -> None:
        pass


def stream_cap_by_state(docs: DataFrame, limit: int, *, source: str = "source") -> DataFrame:
    """Admit exactly ``limit`` rows of each source, in order of arrival, each batch read once.

    The count of a source is keyed state in RocksDB. Before the shuffle every task lets at most ``limit`` rows of a
    source pass, so a source that makes up most of a stream brings ``limit`` rows per task to its key and no more.
    """
    docs.sparkSession.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    schema = docs.schema
    at = schema.fieldNames().index(source)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: dict[str | None, int] = {}
        for batch in batches:
            keep = []
            for k, name in enumerate(batch.column(at).to_pylist()):
                passed[name] = passed.get(name, 0) + 1
                if passed[name] <= limit:
                    keep.append(k)
            yield batch.take(pa.array(keep, pa.int64()))

    few = docs.mapInArrow(first_rows, schema)
    return few.groupBy(source).transformWithStateInPandas(_Admit(limit), schema, "Append", "None")


def stream_buffer_shuffle(
    docs: DataFrame, seed: int, path: str, checkpoint: str, *, ids: tuple[str, ...] = ("doc_id",)
) -> StreamingQuery:
    """Each micro-batch is one buffer: shuffled, then written in order. The source's
    ``maxFilesPerTrigger`` sets its size."""

    def flush(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("key", order_key(f"{seed}:{batch_id}", *ids))
            .orderBy("key", *ids)
            .write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        )

    return (
        docs.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_totals(docs: DataFrame, text: str = "formatted") -> DataFrame:
    """Running counts per source; the aggregation combines before its shuffle."""
    return docs.groupBy("source").agg(F.count("*").alias("written"), F.sum(F.octet_length(text)).alias("bytes"))


def write_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the newest totals as a small table, replaced as a whole after every batch."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return (
        totals.writeStream.foreachBatch(replace).outputMode("complete")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def stream_rate(
    events: DataFrame, size: Column, width: str = "1 hour", delay: str = "10 minutes", ts: str = "ts"
) -> DataFrame:
    """Volume and speed per tumbling window; a window appears once the watermark has passed it.

    Rows behind the watermark are dropped, Spark's default.
    """
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    rows = timed.groupBy(F.window(ts, width)).agg(F.count("*").alias("n"), F.sum(size).alias("volume"))
    seconds = F.timestamp_diff("SECOND", F.col("window.start"), F.col("window.end"))
    return rows.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n", "volume",
        (F.col("volume") / seconds).alias("per_second"),
    )

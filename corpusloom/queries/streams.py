"""Streaming jobs run over the tables as file streams, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.tables import stream_docs
from ..streaming.streams import (
    append_files, run_available, stream_buffer_shuffle, stream_cap, stream_cap_by_state, stream_clean, stream_encode,
    stream_rate, stream_totals, write_totals,
)
from . import ORACLES, query
from .inputs import sql_pretrain, table
from .tokens import listed, tokenizer  # registers encode_bpe, whose SQL checks the stream as well


def doc_stream(spark, folder):
    schema = table(spark, folder, "documents").schema
    return stream_docs(spark, f"{folder}/documents.parquet*", schema)


CLEAN = f"""SELECT * FROM (SELECT doc_id, source, {sql_pretrain('text')} AS formatted FROM documents
    WHERE length(text) >= 300) WHERE formatted <> ''"""


@query("stream_clean", CLEAN)
def cleaned(spark, folder):
    path = scratch_dir(spark, "clean")
    run_available(append_files(stream_clean(doc_stream(spark, folder)), f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_cap",
    """SELECT doc_id, source FROM (SELECT doc_id, source,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nth FROM documents) WHERE nth <= 20""",
)
def capped(spark, folder):
    path = scratch_dir(spark, "cap")
    docs = doc_stream(spark, folder).select("doc_id", "source", "text")
    run_available(stream_cap(docs, 20, path, f"{path}/state"))
    return spark.read.parquet(f"{path}/rows").select("doc_id", "source")


@query("stream_cap_by_state", "SELECT source, least(count(*), 20) AS admitted FROM documents GROUP BY source")
def capped_by_state(spark, folder):
    """Which rows come first depends on the tasks; how many are admitted does not."""
    path = scratch_dir(spark, "cap-state")
    docs = doc_stream(spark, folder).select("doc_id", "source", "text")
    run_available(append_files(stream_cap_by_state(docs, 20), f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows").groupBy("source").agg(F.countDistinct("doc_id").alias("admitted"))


@query("stream_buffer_shuffle", "SELECT doc_id, md5(concat_ws(':', '61', '0', doc_id::VARCHAR)) AS key FROM documents")
def shuffled(spark, folder):
    path = scratch_dir(spark, "buffers")
    docs = doc_stream(spark, folder).select("doc_id", "source", "text")
    run_available(stream_buffer_shuffle(docs, 61, f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows").select("doc_id", "key")


@query(
    "stream_totals",
    f"SELECT source, count(*) AS written, sum(strlen(formatted))::BIGINT AS bytes FROM ({CLEAN}) GROUP BY source",
)
def totals(spark, folder):
    path = scratch_dir(spark, "totals")
    run_available(write_totals(stream_totals(stream_clean(doc_stream(spark, folder))), f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows")


@query(
    "stream_rate",
    """WITH binned AS (SELECT date_trunc('hour', ts) AS w, count(*) AS n, sum(event_id % 1000)::BIGINT AS volume
        FROM events GROUP BY 1)
    SELECT epoch(w)::BIGINT AS window_start, n, volume, round(volume / 3600::DOUBLE, 6) AS per_second FROM binned
    WHERE w + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""",
)
def rates(spark, folder):
    """Hourly volume; windows the watermark has not passed at the end stay out."""
    path = scratch_dir(spark, "rates")
    schema = table(spark, folder, "events").schema
    events = stream_docs(spark, f"{folder}/events.parquet*", schema)
    # Wall-clock times without a zone are read as UTC, whatever the session's zone is.
    seconds = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    events = events.withColumn("ts", F.timestamp_micros(seconds))
    run_available(append_files(stream_rate(events, F.col("event_id") % 1000), f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows").select(
        F.unix_seconds("window_start").alias("window_start"), "n", "volume", F.round("per_second", 6).alias("per_second")
    )


@query("stream_encode", ORACLES["encode_bpe"])
def encoded(spark, folder):
    path = scratch_dir(spark, "ids")
    merges, vocab = tokenizer(spark, folder)
    docs = doc_stream(spark, folder).select("doc_id", "text")
    run_available(append_files(stream_encode(docs, merges, vocab), f"{path}/rows", f"{path}/state"))
    return spark.read.parquet(f"{path}/rows").select("doc_id", listed(F.col("ids")).alias("ids"))

"""Restarts, late rows, exact caps."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from corpusloom.sources.tables import stream_docs
from corpusloom.streaming.streams import (
    append_files, run_available, stream_buffer_shuffle, stream_cap, stream_cap_by_state, stream_clean, stream_rate, stream_totals, write_totals,
)

SCHEMA = "doc_id long, source string, text string"


def add(spark, folder, first, n):
    spark.range(first, first + n, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 4).cast("string"))).alias("source"),
        F.repeat(F.lit("x"), (F.col("id") % 7 * 100).cast("int")).alias("text"),
    ).write.mode("append").parquet(folder)


def stream(spark, folder, **options):
    return stream_docs(spark, folder, spark.read.schema(SCHEMA).parquet(folder).schema, **options)


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    totals, totals_state = str(tmp_path / "totals"), str(tmp_path / "totals_state")
    for first in (0, 70, 140):
        add(spark, source, first, 70)
        run_available(append_files(stream_clean(stream(spark, source)), out, state))
        run_available(write_totals(stream_totals(stream_clean(stream(spark, source))), totals, totals_state))
    rows = spark.read.parquet(out)
    want = [i for i in range(210) if i % 7 * 100 >= 300]
    assert sorted(r.doc_id for r in rows.collect()) == want
    assert spark.read.parquet(totals).agg(F.sum("written")).first()[0] == len(want)


def test_cap_over_batches(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for first in (0, 20, 40, 60, 400):
        add(spark, source, first, 20)
    run_available(stream_cap(stream(spark, source, max_files=1), 9, out, state))
    first = spark.read.parquet(f"{out}/rows").groupBy("source").count().collect()
    assert {r.source: r["count"] for r in first} == {"hot": 9, "s0": 9, "s1": 9, "s2": 9, "s3": 9}
    add(spark, source, 500, 20)  # after a restart everything is full
    run_available(stream_cap(stream(spark, source, max_files=1), 9, out, state))
    assert spark.read.parquet(f"{out}/rows").count() == 45


def test_buffers_are_permutations(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for first in (0, 50, 100):
        add(spark, source, first, 50)
    run_available(stream_buffer_shuffle(stream(spark, source, max_files=1), 3, out, state))
    rows = spark.read.parquet(out)
    assert sorted(r.doc_id for r in rows.collect()) == list(range(150))
    assert sorted(r["count"] for r in rows.groupBy("batch").count().collect()) == [50, 50, 50]


def test_late_rows_are_dropped(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    noon = datetime(2024, 1, 1, 12)

    def arrive(*minutes):
        spark.createDataFrame([(noon + timedelta(minutes=m), 1) for m in minutes], "ts timestamp, n long").coalesce(1) \
            .write.mode("append").parquet(source)
        events = stream_docs(spark, source, spark.read.parquet(source).schema)
        run_available(append_files(stream_rate(events, F.col("n"), "10 minutes"), out, state))

    arrive(1, 2, 45)
    arrive(3, 46)  # 12:03 lies behind the watermark of 12:35
    arrive(120)
    rows = spark.read.parquet(out).orderBy("window_start").collect()
    assert [(r.window_start, r.n) for r in rows] == [(noon, 2), (noon + timedelta(minutes=40), 2)]


def test_cap_by_state_over_batches_and_a_restart(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for k in range(10):
        add(spark, source, 20 * k, 20)
    for _ in range(2):
        run_available(append_files(stream_cap_by_state(stream(spark, source, max_files=1), 9), out, state))
        rows = spark.read.parquet(out)
        assert {r.source: r["count"] for r in rows.groupBy("source").count().collect()} == {"hot": 9, "s0": 9, "s1": 9, "s2": 9, "s3": 9}
        assert rows.select("doc_id").distinct().count() == 45
        add(spark, source, 500, 20)  # after a restart everything is full

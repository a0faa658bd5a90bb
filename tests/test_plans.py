"""What the plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as job
from corpusloom.functions.layout import format_pretrain
from corpusloom.operators.filters import drop_nulls
from corpusloom.operators.sample import cap_per_source
from corpusloom.operators.report import tail_n
from corpusloom.queries.inputs import docs, run_log

FOLDER = "/root/testdata/sf0.001"
QUERIES = job.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# The lists that may meet in one task: bucket totals, files, vocabulary, pairs, grand totals.
SMALL = {
    "prefix_sum", "window_shuffle", "shuffle_docs", "interleave_mix", "cluster_grid", "pack_rows", "pack_shuffled",
    "pack_linear", "pack_epochs", "training_rows", "cluster_shuffle", "epochs",
}


@pytest.mark.parametrize("name", sorted(SMALL))
def test_only_bucket_totals_meet_in_one_task(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i + 1:i + 4])
            assert "HashAggregate" in below or "InMemoryTableScan" in below, below
    assert "BatchEvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize(
    "name", ["sanitize", "pretrain_format", "letter_profile_be", "quarantine", "chat_prompt", "instruct_format", "line_split"]
)
def test_expressions_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert not re.search("EvalPython|InPandas|InArrow|PythonUDF", text)


def test_columns_and_nulls_reach_the_scan(spark):
    df = drop_nulls(spark.read.parquet(f"{FOLDER}/documents.parquet"))
    text = plan(df.select(format_pretrain(F.col("text"))))
    assert re.search(r"ReadSchema: struct<text:string>", text) and "IsNotNull(text)" in text


def test_caps_drop_rows_before_the_shuffle(spark):
    text = plan(cap_per_source(docs(spark, FOLDER), 3))
    assert "BroadcastHashJoin" in text  # bucket totals, checked to be few
    above = text[: text.index("BroadcastHashJoin")]
    assert "Exchange hashpartitioning" in above


def test_latest_rows_are_cut_in_every_task(spark):
    assert plan(tail_n(run_log(spark, FOLDER))).count("WindowGroupLimit") == 2


def test_no_task_holds_a_hot_source(spark):
    """A source with a third of all rows is spread over the tasks that rank it."""
    from corpusloom.operators.order import running

    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("source")
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = running(rows, "doc_id", 1, by=["source"])
        hot = ranked.filter("source = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(hot) == 8 and max(r["count"] for r in hot) < 20_000 / 3 / 8 * 2

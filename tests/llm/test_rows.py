"""Stages decide per row: two rows with one id, null or not, of which only one is rejected, leaks or is a copy."""

import pytest

import corpus_pipeline as pipeline
from corpusloom.llm import near_sets, simhash

GOOD = "the house of the river and the garden under a stone near the old bridge"
LEAK = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def docs(spark, data):
    rows = [(i, t, "en", f"s{k}", 1) for k, (i, t) in enumerate(data)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def left(df):
    assert df.columns == pipeline.COLUMNS
    return sorted((r.source for r in df.collect()))


def test_language_id(spark, tmp_path):
    data = [(None, GOOD), (None, None), (None, "12 34"), (3, GOOD), (3, ""), (3, None)]
    assert left(pipeline.language_id(spark, docs(spark, data), str(tmp_path))) == ["s0", "s3"]


def test_drop_leaks(spark, tmp_path):
    bench = spark.createDataFrame([(1, LEAK)], "item_id bigint, text string")
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    data = [(None, GOOD), (None, "x " + LEAK), (3, GOOD), (3, LEAK), (None, None), (4, "y " + LEAK)]
    assert left(pipeline.drop_leaks(spark, docs(spark, data), str(tmp_path))) == ["s0", "s2", "s4"]


@pytest.mark.parametrize("keep_one", [simhash.keep_one, near_sets.keep_one])
def test_keep_one(spark, keep_one):
    other = " ".join(f"w{k}" for k in range(40))
    data = [(None, GOOD), (None, other), (5, other), (None, "something else that nobody says"), (7, LEAK), (7, LEAK), (7, "x y z a b c d")]
    got = left(keep_one(docs(spark, data)))
    assert got in (["s0", "s2", "s3", "s4", "s6"], ["s0", "s2", "s3", "s5", "s6"])

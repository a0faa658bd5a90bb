"""Columns named like the operators' helpers come back untouched, module by module."""

import pytest

from corpusloom.llm import decontaminate, line_dedup, near_sets, shards, simhash

HELPERS = [
    "__row", "__id", "__twin", "__removed", "__leaks", "__k1", "__k2", "__k3", "__block", "__cell", "__ends", "__r", "__rank",
    "__before", "__n", "row", "nth", "given", "told", "root", "key", "leaks", "twin", "of", "removed", "size", "h", "item", "part",
]


@pytest.fixture(scope="module")
def table(spark):
    text = "the house of the river and the garden under a stone near the old bridge number {}"
    rows = [(k, text.format(k) + f" word{k}" * 12, *(100 * k + j for j in range(len(HELPERS)))) for k in range(12)]
    layout = "doc_id bigint, text string, " + ", ".join(f"`{h}` bigint" for h in HELPERS)
    return spark.createDataFrame(rows, layout).repartition(3)


def untouched(table, got, dropped=()):
    assert [c for c in got.columns if c in table.columns] == table.columns
    for r in got.select(*table.columns).collect():
        assert [r[h] for h in HELPERS] == [100 * r.doc_id + j for j in range(len(HELPERS))]
    return got.count()


def test_line_dedup(table):
    assert untouched(table, line_dedup.deduplicate(table)) == 12


def test_decontaminate(spark, table):
    bench = spark.createDataFrame([(1, "word3 " * 12)], "item_id bigint, text string")
    assert untouched(table, decontaminate.clean(table, bench)) == 11


def test_shards(table):
    assert untouched(table, shards.shuffle_into_shards(table, 5)) == 12


@pytest.mark.parametrize("keep_one", [near_sets.keep_one, simhash.keep_one])
def test_keep_one(table, keep_one):
    assert untouched(table, keep_one(table)) >= 1

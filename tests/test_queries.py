"""Every registered query against its SQL twin at the smallest scale."""

import pytest
from check import compare, connect

import __spark_entry__ as job

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = job.queries(), job.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    verdict = compare(spark, con, QUERIES[name], ORACLES.get(name), FOLDER)
    assert verdict == "" or (name not in ORACLES and verdict.startswith("rows only"))


def test_entry(spark):
    rows = job.entry(spark)
    assert rows.columns == ["row_id", "batch_id", "input_ids", "labels"]
    assert rows.count() > 0

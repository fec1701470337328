"""Every registered query against its DuckDB counterpart on the given tables."""

import os

import pytest

from suite import ORACLES, QUERIES
from suite.compare import SIZES, difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert difference(spark, name, SF_DIR, con) is None
    assert SIZES[name] > 0


def test_sql_candidates_apart_from_each_other(spark, con):
    """Each prompt in a batch of its own: the stand-in can't see an item's other candidate."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        assert difference(spark, "make_sql", SF_DIR, con) is None
    finally:
        spark.conf.set(name, before)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["num_joins", "cmd_type", "n", "mean_query_tokens"] and df.count() > 0

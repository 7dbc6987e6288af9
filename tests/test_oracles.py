"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries with a Python step: pixels, header bytes, lines of CSV records, and text operators that are not native.
PYTHON_QUERIES = {
    "image_attributes", "image_channel_mean", "letterbox_images", "letterbox_sizes", "csv_round_trip", "op1_decontamination",
    "photo_dataset_report",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    built = QUERIES[name](spark, SF)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert any(step in plan for step in ("Python", "InPandas", "InArrow")) == (name in PYTHON_QUERIES)
    assert compare(spark, con, SF, lambda *_: built, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0

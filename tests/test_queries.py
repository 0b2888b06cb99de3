"""Every registered query against its DuckDB statement on the smallest given data."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))
import compare  # noqa: E402

from ridewright.checks.oracles import ORACLES  # noqa: E402
from ridewright.checks.queries import QUERIES  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    good, note = compare.compare(spark, duck, SMALL, name)
    assert good, note


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_stream")])
def test_no_query_pairs_all_rows(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_rows_of_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0

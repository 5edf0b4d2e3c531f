"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from oracle_check import connect, difference
from strata.workload.oracles import all_oracles
from strata.workload.queries import all_queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_oracle(spark, tables, name):
    assert difference(spark, tables, SF_DIR, name) is None


def test_entry(spark):
    assert entry_points.entry(spark).columns == [
        "repo_name", "repo_event_count", "start_dt", "end_dt",
    ]

"""Every registered query against its SQL twin on the smallest test set."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from check import TABLES, compare
from oracle_queries import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not Path(SF_DIR).exists():
        pytest.skip("no test tables here")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def test_every_query_has_a_twin():
    assert set(entry_module.report_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", list(entry_module.report_queries()))
def test_query_equals_its_sql_twin(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_no_query_needs_python_or_a_cross_join(spark):
    for name, query in entry_module.report_queries().items():
        plan = query(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, f"{name}: {node}"


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0

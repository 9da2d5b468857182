"""Every query against its SQL on the smallest tables, and the plans that matter at scale."""

import duckdb
import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from dossierkit.catalog import ORACLE, QUERIES
from dossierkit.catalog.common import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() == 25


def test_window_reaches_the_scan(spark, plan):
    text = plan(queries()["indicator_pivot"](spark, SF))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "o_custkey" in line)
    assert "o_orderpriority" not in scan
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text


def test_orders_are_cut_to_customers_before_the_join(spark, plan):
    lines = plan(queries()["indicator_pivot"](spark, SF)).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line and "o_custkey" in line)
    partial = next(i for i, line in enumerate(lines) if "HashAggregate" in line and "partial_sum(_value" in line)
    assert join < partial


def test_no_query_crosses_tables_or_runs_python_on_rows(spark, plan):
    for name in ("country_profile", "strength_matrix", "articles", "knn_top3", "first_available", "parse_shares", "alias_join"):
        text = plan(queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text

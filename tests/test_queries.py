"""Registered queries: DuckDB oracle at sf0.001, and plan properties."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from annotask.plans.catalog import ORACLE_SQL, QUERIES
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "answers" not in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


PLAN_QUERIES = [
    "multi_task_status",
    "client_batch_contains",
    "task_status_ids",
    "task_requests_json",
    "reject_tasks",
    "project_stats",
    "batch_status",
    "request_outcomes",
    "delivery_schema",
]


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_plans_stay_in_the_jvm(spark, name):
    plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_filters_and_pruning_reach_the_scan(spark):
    df = E.queries()["multi_task_status"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan
    read_schema = [line for line in plan.split("\n") if "ReadSchema" in line]
    assert read_schema and all("o_totalprice" not in line for line in read_schema)


@pytest.mark.parametrize("name", ["delivered_since", "date_window_completion", "landed_pages", "request_outcomes"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.queries()[name](spark, SF001)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert _rows(df.columns, rows) == _rows(dcols, res.fetchall())

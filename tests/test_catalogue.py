"""Every query against its SQL, and what the plans must and must not hold."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from corpweave import catalogue

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, db, name):
    frame = entry.queries()[name](spark, FOLDER)
    got = frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(frame.columns)
    assert sorted(names) == order
    places = [names.index(c) for c in order]
    wanted = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in order) for row in got), key=repr) == wanted


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_are_pruned(spark):
    plan = catalogue.industry_std(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in plan


def test_exact_matching_broadcasts_the_small_side_and_never_measures_distance(spark):
    plan = catalogue.exact_matches(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "levenshtein" not in plan


def test_golden_rows_grow_with_the_data(spark):
    larger = FOLDER.replace("sf0.001", "sf0.01")
    few, many = (catalogue.golden_registry(spark, folder).count() for folder in (FOLDER, larger))
    assert 0 < many <= 12 * few


def test_every_distance_occurs(spark):
    found = catalogue.fuzzy_matches_t3(spark, FOLDER.replace("sf0.001", "sf0.01"))
    assert {r[0] for r in found.select("name_distance").distinct().collect()} == {0, 1, 2, 3}

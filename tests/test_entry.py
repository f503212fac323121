import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare
from tallyfold.session import METHOD_LIMIT
from tallyfold.standin import catalog, oracle

NAMES = ("missing_drift", "outcome_by_answered", "contrast_group_vs_rest", "estimate_national_total",
         "benchmark_ratios")


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    return con


def test_every_query_of_the_survey_has_its_sql():
    assert set(catalog.QUERIES) == set(oracle.sql()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns == ["week_num", "geography", "race_var", "mean", "se", "metric"]


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf, db, name):
    ours = entry.queries()[name](spark, sf).toPandas()
    assert compare(name, ours, db.execute(entry.oracle_sql()[name]).df()).startswith("ok")


def test_microdata_is_read_once_for_all_families(spark, sf):
    plan = entry.queries()["assemble_estimates"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("orders.parquet") == 1
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert "o_orderpriority" not in plan


def test_wide_rows_are_left_to_methods_that_hotspot_compiles(spark, sf):
    key, usual, limit = METHOD_LIMIT
    assert spark.conf.get(key) == limit
    try:
        # a session that is not ours, and one whose owner chose a limit
        spark.conf.set(key, usual)
        entry.queries()["estimate_national_total"](spark, sf)
        assert spark.conf.get(key) == limit
        spark.conf.set(key, "20000")
        entry.queries()["estimate_national_total"](spark, sf)
        assert spark.conf.get(key) == "20000"
    finally:
        spark.conf.set(key, limit)

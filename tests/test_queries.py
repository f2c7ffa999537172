"""Every registered query against its DuckDB statement, and the shape of its plan."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from marketlens.plans import bindings  # noqa: E402
from marketlens.plans.bindings import BINDINGS  # noqa: E402

QUERIES = {name: build for name, build in driver.queries().items() if name in BINDINGS}
ORACLE = {name: sql for name, sql in driver.oracle_sql().items() if name in BINDINGS}
WITHOUT_ORACLE: set[str] = set()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def sortable(row):
    return tuple((value is not None, str(type(value)), value or 0) for value in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE[name])
    oracle_types = {column[0]: str(column[1]) for column in result.description}
    assert columns == sorted(oracle_types)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == oracle_types
    order = [list(oracle_types).index(column) for column in columns]
    expected = sorted((tuple(row[i] for i in order) for row in result.fetchall()), key=sortable)
    actual = sorted((tuple(row[column] for column in columns) for row in df.collect()), key=sortable)
    assert actual == expected


def test_every_query_but_the_named_ones_has_an_oracle():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_ORACLE


def test_queries_without_oracle_run(spark, sf_dir):
    for name in WITHOUT_ORACLE:
        assert QUERIES[name](spark, sf_dir).count() == 1


def test_entry_is_lazy_and_stable(spark):
    first, second = driver.entry(spark), driver.entry(spark)
    assert first.schema == second.schema
    assert 0 < first.count() <= 20


WRITERS = {
    "json_lines_scan",
    "json_array_scan",
    "inferred_key_audit",
    "materialised_table",
    "materialised_checkpoint",
    "materialised_cache",
    "materialised_genre_facts",
    "named_table",
    "observed_cleaning_report",
    "stored_genre_mix",
}


def plan_of(spark, sf_dir, name):
    return QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    for node in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITERS))
def test_building_a_plan_runs_no_job(monkeypatch, spark, sf_dir, name):
    """Opening a table reads a file footer; that aside, no job runs."""
    opened, read = {}, bindings.table
    monkeypatch.setattr(
        bindings,
        "table",
        lambda s, d, t: opened[t] if t in opened else opened.setdefault(t, read(s, d, t)),
    )
    QUERIES[name](spark, sf_dir)
    spark.sparkContext.setJobGroup(f"lazy {name}", name)
    try:
        QUERIES[name](spark, sf_dir)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"lazy {name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0


@pytest.mark.parametrize(
    "name", ["top_publishers", "price_bands", "genre_shelf", "genre_value", "platform_reach"]
)
def test_unread_reviews_cost_no_join(spark, sf_dir, name):
    assert "Join" not in plan_of(spark, sf_dir, name)


@pytest.mark.parametrize(
    "name, columns",
    [
        ("line_status_census", "l_returnflag:string,l_linestatus:string"),
        ("orders_per_year", "o_orderdate:timestamp_ntz"),
        ("largest_customers", "o_custkey:bigint"),
        ("quantity_bands", "l_quantity:double"),
        ("word_prevalence", "text:string"),
    ],
)
def test_scans_read_only_what_is_used(spark, sf_dir, name, columns):
    assert f"ReadSchema: struct<{columns}>" in plan_of(spark, sf_dir, name)


def test_date_range_reaches_the_scan(spark, sf_dir):
    plan = plan_of(spark, sf_dir, "shipments_per_month")
    assert "GreaterThanOrEqual(l_shipdate" in plan


@pytest.mark.parametrize(
    "name", ["top_publishers", "best_rated_games", "genre_shelf", "language_prevalence"]
)
def test_top_k_does_not_sort_everything(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_top_k_per_group_is_cut_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(spark, sf_dir, "publisher_genres")


@pytest.mark.parametrize("name", ["price_bands", "cleaning_report", "publisher_concentration"])
def test_one_scan_per_report(spark, sf_dir, name):
    plan = plan_of(spark, sf_dir, name)
    assert plan.count("part.parquet") == 1


@pytest.mark.parametrize(
    "name",
    ["price_bands", "discounts_by_band", "age_group_flags", "quantity_bands"],
)
def test_band_reports_shuffle_once(spark, sf_dir, name):
    assert plan_of(spark, sf_dir, name).count("Exchange ") == 1


def test_medians_shuffle_only_grid_points(spark, sf_dir):
    """Facts are shuffled once, collapsed; the window and the last aggregate share a partitioning."""
    plan = plan_of(spark, sf_dir, "customer_cohort_orders")
    above_the_join = plan.split("Join")[0]
    assert above_the_join.count("Exchange ") == 2


ORDERED = sorted(
    name for name, sql in ORACLE.items() if re.search(r"ORDER BY [^()]*\Z", sql)
)


@pytest.mark.parametrize("name", ORDERED)
def test_order_is_that_of_the_oracle(spark, duck, sf_dir, name):
    """Where the statement ends on an order, rows come in that order, ties included."""
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert [tuple(row[c] for c in columns) for row in df.collect()] == result.fetchall()


def test_many_orders_are_checked():
    assert len(ORDERED) >= 10

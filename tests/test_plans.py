"""Plan shape: what must hold however large the tables are."""

from __future__ import annotations

import re

import pytest

from tillweave.registered import QUERIES

# Queries that store something first; their final plan only reads that back.
STAGED = {
    "src_two_feeds", "csv_round_trip", "star_load_counts", "surrogate_key", "feed_order_ids",
    "scenario_new_ids", "scenario_project", "forecast_total",
}
PLANNED = sorted(set(QUERIES) - STAGED)


def plan_of(df) -> str:
    # Paths are cut short in plans otherwise.
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "2000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    """Plan as if no table were small enough to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


PER_FEED = {
    "clean_union", "flag_labels", "profile_bad_dates", "profile_suspicious_dates", "clean_audit",
    "profile_issues",
}


# One pass per feed, per rule of the load check, or per distinct count.
SCANS = {"profile_shape": 3, "fact_chain": 3, "star_load_check": 4, "report_summary_stats": 4}


def scans_of_lines(plan: str) -> int:
    """Scans of the stored order lines and of the table the raw feeds come from."""
    return len(re.findall(r"FileScan parquet[^\n]*(?:lineitem\.parquet|/versions/\w+/orders)", plan))


@pytest.mark.parametrize("name", PLANNED)
def test_plan_holds_at_any_size(spark, sf_dir, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert bad not in plan
    # Nothing is hinted for broadcast: the engine decides by size.
    assert "BroadcastHashJoin" not in plan
    assert scans_of_lines(plan) <= SCANS.get(name, 2 if name in PER_FEED else 1)


LOCATED = sorted(
    n
    for n in QUERIES
    if re.search(r"state|fact_sheet|qa_insight|sql_surface|join_orders", n) and not n.startswith("cube_")
)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("cube_")))
def test_cubes_spare_the_lines(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert scans_of_lines(plan) == 0 and re.search(r"FileScan parquet[^\n]*/cube-", plan)


@pytest.mark.parametrize("name", LOCATED)
def test_located_reports_do_not_shuffle_lines_by_restaurant(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert scans_of_lines(plan) == 1
    if name in ("qa_state", "dash_top_states", "join_orders_restaurants"):
        # These join the lines themselves: the stored dimension is small enough to send.
        assert "hashpartitioning(restaurant_id" not in plan


def test_columns_are_pruned_and_filters_pushed(spark, sf_dir):
    plan = plan_of(QUERIES["verify_orders_by_chain"](spark, sf_dir))
    assert re.search(r"/orders[^\n]*ReadSchema: struct<>", plan)
    plan = plan_of(QUERIES["clean_feed"](spark, sf_dir))
    assert "EqualTo(l_linestatus,F)" in plan


def test_counting_lines_joins_nothing(spark, sf_dir):
    assert "Join" not in plan_of(QUERIES["verify_total_orders"](spark, sf_dir))


def test_located_reports_aggregate_before_the_join(spark, sf_dir, no_broadcast):
    plan = plan_of(QUERIES["report_top_states"](spark, sf_dir))
    join = re.search(r"SortMergeJoin \[restaurant_id[^\n]*\n(.*)", plan, re.S).group(1)
    # Below the join both sides are already grouped by restaurant.
    assert re.search(r"HashAggregate\(keys=\[restaurant_id", join)
    assert "TakeOrderedAndProject" in plan

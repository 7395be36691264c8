"""Report conventions: null keys, rounding, ties, distinct counts, filters."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillweave.functions import numbers as N
from tillweave.operators.filters import keep_selected
from tillweave.operators.star import Star
from tillweave.plans import facts, shaped
from tillweave.plans.catalogue import CATALOGUE, mean, total
from tillweave.plans.report import ReportSpec, run_report

ALL = {"season": ["Spring", "Summer", "Fall", "Winter"]}


def star_of(lines):
    return Star.from_lines(lines)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_true_division_of_whole_units(make_lines):
    lines = make_lines({}).withColumn("order_total_cost", F.lit(3_499_999).cast("bigint"))
    row = one(run_report(CATALOGUE["fact_gender"], Star(lines)))
    assert row.revenue_m == 3.5


def test_null_keys_kept_by_sql_reports_and_dropped_by_the_dashboard(make_lines):
    star = star_of(make_lines({"has_children": None}, {"gender": None}))
    assert run_report(CATALOGUE["report_children"], star).count() == 2
    assert {r.gender for r in run_report(CATALOGUE["report_gender"], star).collect()} == {None, "F"}
    assert [r.gender for r in run_report(CATALOGUE["dash_gender"], star).collect()] == ["F"]


def test_full_season_selection_drops_undated_rows_but_an_empty_one_does_not(make_lines):
    star = star_of(make_lines({}, {"season": None, "order_purchase_date": None}))
    spec = CATALOGUE["dash_kpis"]
    assert one(run_report(spec, star, ALL)).revenue == 100.0
    assert one(run_report(spec, star, {"season": []})).revenue == 200.0


def test_selecting_everything_equals_the_not_null_filter(make_lines):
    lines = make_lines({}, {"season": None}, {"season": "Fall"})
    kept = keep_selected(lines, ALL)
    assert kept.exceptAll(lines.where("season IS NOT NULL")).isEmpty()
    assert kept.count() == 2


@pytest.mark.parametrize(
    "value,half_up,half_even", [("2.5", 3.0, 2.0), ("3.5", 4.0, 4.0), ("0.5", 1.0, 0.0)]
)
def test_rounding_modes(make_lines, value, half_up, half_even):
    star = star_of(make_lines({"profit": Decimal(value)}))
    up = ReportSpec((), (total("p", "profit", 1, 0),))
    even = ReportSpec((), (total("p", "profit", 1, 0, mode=N.HALF_EVEN),))
    assert one(run_report(up, star)).p == half_up
    assert one(run_report(even, star)).p == half_even


def test_mean_rounding(make_lines):
    star = star_of(make_lines({"profit": Decimal("0.25")}, {"profit": Decimal("0.0")}))
    spec = ReportSpec((), (mean("p", "profit", 2, mode=N.HALF_EVEN), mean("q", "profit", 2)))
    assert tuple(one(run_report(spec, star))) == (0.12, 0.13)


def test_exact_sum_beyond_bigint(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big,), (big,), (-5,)], "v bigint")
    dtype = df.schema["v"].dataType
    assert df.agg(N.exact_sum(F.col("v"), dtype)).first()[0] == 2 * big - 5


def test_top_k_tie_goes_to_the_smaller_key(make_lines):
    rows = [{"item_description": d, "quantity": q} for d, q in (("d", 5), ("b", 3), ("c", 3), ("a", 1))]
    star = star_of(make_lines(*rows))
    top = run_report(CATALOGUE["report_products"], star, limit=2).collect()
    assert [r.item_description for r in top] == ["d", "b"]
    last = shaped.bottom_products(star, 2).collect()
    assert [r.item_description for r in last] == ["c", "a"]
    bottom = run_report(CATALOGUE["dash_bottom_products"], star, limit=2).collect()
    assert [r.item_description for r in bottom] == ["a", "b"]


def test_bare_category_differs_from_grouping_by_it(make_lines):
    star = star_of(make_lines({"item_category": "B"}, {"item_category": "A"}))
    assert one(run_report(CATALOGUE["report_products"], star)).item_category == "A"
    assert run_report(CATALOGUE["dash_top_products"], star).count() == 2


def test_orders_are_counted_across_chains_and_nulls_ignored(make_lines):
    star = star_of(make_lines({}, {"chain": "south"}, {"order_number": None}))
    row = one(run_report(CATALOGUE["dash_kpis"], star))
    assert row.orders == 1 and row.revenue == 300.0


def test_located_report_regroups_exactly(make_lines):
    lines = make_lines(
        {"restaurant_id": 1, "restaurant_state": "Ohio", "order_number": 1},
        {"restaurant_id": 2, "restaurant_state": "Ohio", "order_number": 1},
        {"restaurant_id": 2, "restaurant_state": "Utah", "order_number": 2, "profit": Decimal("1")},
        {"restaurant_id": None, "restaurant_state": "Iowa"},
    )
    rows = run_report(CATALOGUE["dash_top_states"], star_of(lines)).collect()
    assert [(r.restaurant_state, r.profit, r.revenue, r.orders) for r in rows] == [
        ("Ohio", 17.0, 300.0, 2)
    ]


def test_summary_stats(make_lines):
    star = star_of(make_lines({"order_total_cost": Decimal("1")}, {"customer_id": "c2", "quantity": 3}))
    row = one(run_report(CATALOGUE["report_summary_stats"], star))
    assert (row.mean_order_value, row.min_order_value, row.max_order_value) == (50.5, 1.0, 100.0)
    assert (row.mean_quantity, row.unique_orders, row.unique_customers) == (2.5, 1, 2)


def test_approximate_distinct_is_an_option(make_lines):
    star = star_of(make_lines({}, {"order_number": 2}))
    row = one(run_report(CATALOGUE["report_chain_comparison"], star, approx_distinct=0.05))
    assert row.total_orders == 2


def test_season_spine_shows_missing_seasons(make_lines):
    rows = shaped.season_spine(star_of(make_lines({}, {"season": None}))).collect()
    assert [r.season for r in rows] == ["Spring", "Summer", "Fall", "Winter"]
    assert [r.revenue_k for r in rows] == [0.1, None, None, None]


def test_dashboard_seasons_in_calendar_order(make_lines):
    star = star_of(make_lines({"season": "Winter"}, {"season": "Fall"}, {"season": "Spring"}))
    assert [r.season for r in shaped.dash_season(star, ALL).collect()] == ["Spring", "Fall", "Winter"]


def _dated(y, m, chain):
    return {"order_purchase_date": dt.date(y, m, 1), "order_year": y, "order_month": m,
            "order_month_name": dt.date(y, m, 1).strftime("%B"), "chain": chain}


def test_spine_gives_every_chain_every_period(make_lines):
    star = star_of(make_lines(_dated(2018, 1, "a"), _dated(2018, 5, "a"), _dated(2018, 3, "b")))
    rows = shaped.monthly_spine(star).orderBy("chain", "month_start").collect()
    assert [(r.chain, r.period, r.revenue_k) for r in rows] == [
        ("a", "January 2018", 0.1), ("a", "March 2018", None), ("a", "May 2018", 0.1),
        ("b", "January 2018", None), ("b", "March 2018", 0.1), ("b", "May 2018", None),
    ]


def test_method_share(make_lines):
    star = star_of(make_lines({}, {}, {}, {"order_purchase_method": "Delivery"}, {"chain": "south"}))
    share = {(r.chain, r.order_purchase_method): r.share_pct for r in shaped.method_share(star).collect()}
    assert share == {("north", "Dine In"): 75.0, ("north", "Delivery"): 25.0, ("south", "Dine In"): 100.0}


def test_state_table_text(make_lines):
    star = star_of(make_lines({"order_total_cost": Decimal("12340000"), "profit": Decimal("50000")}))
    row = one(shaped.dash_state_table(star, {}))
    assert (row.state, row.revenue, row.profit, row.locations) == ("Ohio", "$12.3M", "$0.0M", 1)


def test_kpi_cards(make_lines):
    star = star_of(make_lines(*[{"order_number": i, "order_total_cost": Decimal("1234.5")} for i in range(1200)]))
    assert tuple(one(shaped.kpi_cards(star, {}))) == ("$1.5M", "$0.0M", "1,200", "1", "$1,234")


def test_states_of_one_chain_match_the_ranked_form(make_lines):
    lines = make_lines(
        {"restaurant_id": 1, "restaurant_state": "Ohio"},
        {"restaurant_id": 2, "restaurant_state": "Utah", "profit": Decimal("9")},
        {"restaurant_id": 1, "chain": "south"},
    )
    star = star_of(lines)
    north = [tuple(r) for r in shaped.states_for_chain(star, "north", {}).collect()]
    ranked = shaped.states_per_chain(star, {}).where("chain = 'north'").orderBy("state_rank")
    assert north == [(r.restaurant_state, r.profit_k) for r in ranked.collect()]
    assert north[0][0] == "Utah"
    assert shaped.states_for_chain(star, "north", {"chain": ["south"]}).isEmpty()


def test_state_share_runs_to_one(make_lines):
    lines = make_lines(
        {"profit": Decimal("6")}, {"restaurant_id": 2, "restaurant_state": "Utah", "profit": Decimal("2")}
    )
    rows = shaped.state_share(star_of(lines)).orderBy("state_rank").collect()
    assert [(r.restaurant_state, r.share, r.cum_share) for r in rows] == [
        ("Ohio", 0.75, 0.75), ("Utah", 0.25, 1.0)
    ]


def test_fact_sheet_agrees_with_the_separate_reports(make_lines):
    lines = make_lines(
        {"season": "Spring", "item_category": "A"},
        {"season": "Fall", "item_category": "B", "profit": Decimal("3000000")},
        {"season": None, "restaurant_id": 2, "restaurant_state": "Utah", "gender": "M"},
        {"chain": "south", "restaurant_id": 2, "order_purchase_method": "Delivery"},
    )
    star = star_of(lines)
    sheet = {(r.section, r.pick, r.measure): (r.label, r.value) for r in facts.fact_sheet(star).collect()}
    assert sheet["category", "1", "profit_m"] == ("B", 3.0)
    assert sheet["season", "last", "revenue_m"][0] == "Spring"
    assert ("season", "3", "revenue_m") not in sheet
    assert sheet["chain", "1", "restaurants"] == ("north", 2.0)
    assert sheet["chain", "2", "restaurants"] == ("south", 1.0)
    assert sheet["state", "1", "profit_m"] == ("Ohio", 3.0)
    assert sheet["method", "1", "orders"] == ("Dine In", 3.0)


def test_headings(make_lines):
    report = run_report(CATALOGUE["fact_gender"], star_of(make_lines({})))
    assert shaped.with_headings(report).columns == ["Gender", "Avg Order", "Revenue M"]


def test_chain_sums_add_up(make_lines):
    star = star_of(make_lines({}, {"chain": "south", "profit": Decimal("0.3333")}))
    by_chain = run_report(replace(CATALOGUE["dash_totals"], dims=("chain",)), star).collect()
    assert sum(r.profit for r in by_chain) == one(run_report(CATALOGUE["dash_totals"], star)).profit

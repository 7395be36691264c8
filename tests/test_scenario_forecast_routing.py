"""Scenario projection, series, forecast, question routing and sources."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.operators import forecast as Fc
from tillweave.operators import routing
from tillweave.operators import scenario as Sc
from tillweave.operators import series as Sr
from tillweave.operators.star import Star
from tillweave.plans import facts
from tillweave.session import scratch_path
from tillweave.sources import feeds as Feeds
from tillweave.sources import warehouse as W

PARAMS = Sc.ScenarioParams(growth={"north": 0.08, "south": 0.07}, uplift_method="Delivery",
                           id_prefix={"north": "N2024"})


def projected(lines, params=PARAMS):
    return Sc.project_values(lines, params).orderBy("row_ordinal").collect()


@pytest.mark.parametrize(
    "day,moved",
    [
        (dt.date(2016, 2, 29), dt.date(2022, 2, 28)),
        (dt.date(2018, 2, 28), dt.date(2024, 2, 28)),
        (dt.date(2018, 12, 31), dt.date(2024, 12, 31)),
        (None, None),
    ],
)
def test_dates_move_and_the_season_stays(make_lines, day, moved):
    row = projected(make_lines({"order_purchase_date": day, "season": "Fall"}))[0]
    assert row.order_purchase_date == moved and row.season == "Fall"
    assert row.order_year == (moved.year if moved else None)


def test_money_rounds_half_to_even(make_lines):
    flat = Sc.ScenarioParams(default_growth=0.0)
    rows = projected(
        make_lines({"profit": Decimal("2.5")}, {"profit": Decimal("3.5")}, {"profit": None}), flat
    )
    assert [r.profit for r in rows] == [2, 4, None]


def test_uplift_applies_to_the_rounded_total_only(make_lines):
    row = projected(make_lines({"order_purchase_method": "Delivery", "order_total_cost": Decimal("9.5")}))[0]
    # 9.5 * 1.08 = 10.26 -> 10 -> 10.5 -> 10
    assert (row.order_total_cost, row.profit) == (10, 9)


def test_growth_differs_by_chain(make_lines):
    rows = projected(make_lines({}, {"chain": "south"}, {"chain": "other"}))
    assert [r.order_total_cost for r in rows] == [108, 107, 108]


def test_no_growth_is_identity(make_lines):
    flat = Sc.ScenarioParams(years=0, default_growth=0.0, uplift=1.0, uplift_method="Delivery")
    lines = make_lines({}, {"order_purchase_method": "Delivery"})
    same = Sc.project_values(lines, flat)
    before = lines.select(*[F.col(c).cast("bigint") for c in S.MONEY_COLUMNS])
    assert same.select(*S.MONEY_COLUMNS).exceptAll(before).isEmpty()


def test_ids_count_from_zero_per_chain_and_are_never_cut(make_lines):
    lines = make_lines({}, {}, {"chain": "south"})
    rows = Sc.new_customer_ids(lines, PARAMS, ["row_ordinal"]).collect()
    assert {r.customer_id for r in rows} == {"N2024000000", "N2024000001", "south000000"}
    short = Sc.ScenarioParams(id_digits=1)
    many = make_lines(*[{} for _ in range(12)])
    ids = {r.customer_id for r in Sc.new_customer_ids(many, short, ["row_ordinal"]).collect()}
    assert "north11" in ids and len(ids) == 12


def test_projection_keeps_the_shape(make_lines):
    lines = make_lines({}, {"chain": "south"})
    out = Sc.project(lines, PARAMS, ["row_ordinal"])
    assert out.columns == lines.columns and out.count() == 2


def test_verify_and_totals(make_lines):
    star = Sc.project_values(make_lines({}, {"chain": "south"}), PARAMS)
    rows = Sc.totals(star).collect()
    (whole,) = [r for r in rows if r.is_total]
    assert whole.chain is None and whole.revenue_m == pytest.approx(215 / 1e6)
    assert {r.chain for r in rows if not r.is_total} == {"north", "south"}
    check = {r.chain: (r.rows, r.start_date) for r in Sc.verify(star).collect()}
    assert check == {"north": (1, "2024-03-05"), "south": (1, "2024-03-05")}


# --- series ------------------------------------------------------------------


def test_chain_series_add_up_to_the_combined_one(make_lines):
    lines = make_lines({}, {"chain": "south"}, {"order_purchase_date": None})
    by_chain = Sr.monthly_by_chain(lines)
    assert Sr.combine(by_chain).first().y == 200
    both = {r.series: r.y for r in Sr.with_combined(by_chain).collect()}
    assert both == {"north": 100, "south": 100, "ALL": 200}
    named = Sr.monthly_by_chain(make_lines({"chain": "ALL"}, {}))
    with pytest.raises(Exception, match="name the combined series"):
        Sr.with_combined(named).collect()
    assert {r.series for r in Sr.with_combined(named, "every").collect()} == {"ALL", "north", "every"}


def test_partial_last_month_can_be_dropped(make_lines):
    lines = make_lines(
        {"order_purchase_date": dt.date(2018, 4, 30)}, {"order_purchase_date": dt.date(2018, 5, 1)}
    )
    assert Sr.monthly_by_chain(lines).count() == 2
    kept = Sr.monthly_by_chain(lines, drop_partial_last_month=True).collect()
    assert [r.ds for r in kept] == [dt.date(2018, 4, 1)]


# --- forecast ----------------------------------------------------------------


def month(i):
    return dt.date(2018 + i // 12, i % 12 + 1, 1)


def series_frame(spark, values, name="s"):
    return spark.createDataFrame(
        [(name, month(i), float(v)) for i, v in enumerate(values)], "series string, ds date, y double"
    )


def test_line_without_season_is_continued(spark):
    out = Fc.forecast(series_frame(spark, [100 + 5 * i for i in range(24)])).collect()
    assert len(out) == 36
    for r in out:
        i = (r.ds.year - 2018) * 12 + r.ds.month - 1
        assert r.yhat == pytest.approx(100 + 5 * i)
        assert r.lower == pytest.approx(r.yhat) and r.is_future == (i >= 24)


def test_straight_line_follows_the_published_steps(spark):
    values = [(1000 + 20 * i) * (1 + 0.3 * math.sin(math.pi * i / 6)) for i in range(36)]
    n, ts = len(values), list(range(36))
    mt, my = sum(ts) / n, sum(values) / n
    slope = sum((t - mt) * (y - my) for t, y in zip(ts, values)) / sum((t - mt) ** 2 for t in ts)
    intercept = my - slope * mt
    trend = [intercept + slope * t for t in range(48)]
    raw = [sum(values[i] / trend[i] for i in range(m, n, 12)) / 3 for m in range(12)]
    index = [r / (sum(raw) / 12) for r in raw]
    residual = [values[i] - trend[i] * index[i % 12] for i in ts]
    centre = sum(residual) / n
    sigma = math.sqrt(sum((r - centre) ** 2 for r in residual) / (n - 1))
    straight = Fc.ForecastParams(changes=0, waves=0)
    out = Fc.forecast(series_frame(spark, values), straight).orderBy("ds").collect()
    for i, r in enumerate(out):
        assert r.yhat == pytest.approx(trend[i] * index[i % 12], rel=1e-9)
        assert r.upper - r.yhat == pytest.approx(1.959964 * sigma, rel=1e-6)


def _design(params, n):
    rows = []
    for i in range(n):
        s = i / (n - 1)
        waves = [
            f(2 * math.pi * (k + 1) / 12 * (i % 12 + 1))
            for k in range(params.waves)
            for f in (math.sin, math.cos)
        ]
        waves += [w * s for w in waves]
        rows.append([1.0, s, *[max(s - c, 0.0) for c in params.breaks], *waves])
    return np.array(rows)


def test_weights_solve_the_normal_equations(spark):
    params = Fc.ForecastParams(changes=5, waves=1)
    values = [1000 + 30 * i - 45 * max(i - 25, 0) + 80 * math.sin(i) for i in range(50)]
    x, y = _design(params, 50), np.array(values) / max(map(abs, values))
    want = np.linalg.solve(x.T @ x + np.diag(params.penalties), x.T @ y)
    row = Fc.broken_trend(series_frame(spark, values), params).first()
    assert row.weights == pytest.approx(list(want), abs=1e-9)
    assert row.scale == max(map(abs, values)) and row.span == 49


def test_a_planted_break_is_followed(spark):
    values = [1000 + 10 * i + 40 * max(i - 30, 0) for i in range(60)]
    season = [1 + 0.2 * math.sin(math.pi * i / 6) for i in range(72)]
    frame = series_frame(spark, [v * s for v, s in zip(values, season)])
    model = Fc.fit(Fc.decompose(frame)).first()
    assert model.first_slope == pytest.approx(10, abs=6)
    assert model.slope == pytest.approx(50, rel=0.1)
    future = Fc.future_only(Fc.forecast(frame)).orderBy("ds").collect()
    for i, r in enumerate(future, start=60):
        assert r.yhat == pytest.approx((1000 + 10 * i + 40 * (i - 30)) * season[i], rel=0.06)
    straight = Fc.future_only(Fc.forecast(frame, Fc.ForecastParams(changes=0, waves=0)))
    last = straight.orderBy(F.desc("ds")).first()
    true = (1000 + 10 * 71 + 40 * 41) * season[71]
    assert abs(future[-1].yhat - true) < abs(last.yhat - true) / 2


def test_bounds_widen_with_the_changes_of_the_past(spark):
    def widths(values, **how):
        out = Fc.forecast(series_frame(spark, values), Fc.ForecastParams(**how)).orderBy("ds").collect()
        return [(r.upper - r.lower, r.seasonal, r.is_future) for r in out]

    broken = [1000 + 10 * i + 40 * max(i - 30, 0) for i in range(60)]
    past = [w for w, _, future in widths(broken, mode=Fc.ADDITIVE) if not future]
    ahead = [w for w, _, future in widths(broken, mode=Fc.ADDITIVE) if future]
    assert max(past) == pytest.approx(min(past)) and ahead[0] > past[0]
    assert all(b > a for a, b in zip(ahead, ahead[1:]))
    steady = [w for w, _, _ in widths([100 + 5 * i for i in range(36)])]
    assert max(steady) == pytest.approx(0, abs=1e-3)
    line = [w for w, _, _ in widths(broken, changes=0, waves=0)]
    assert max(line) == pytest.approx(min(line))


def test_additive_mode_recovers_a_seasonal_pattern(spark):
    season = [10, -10, 5, -5, 0, 0, 20, -20, 3, -3, 0, 0]
    values = [500 + season[i % 12] for i in range(36)]
    out = Fc.forecast(series_frame(spark, values), Fc.ForecastParams(mode=Fc.ADDITIVE))
    for r in Fc.future_only(out).collect():
        assert r.yhat == pytest.approx(500 + season[r.ds.month - 1], abs=2.0)


def test_unseen_months_get_a_neutral_index(spark):
    out = Fc.future_only(Fc.forecast(series_frame(spark, [10, 20, 30]))).collect()
    unseen = [r for r in out if r.ds.month > 3]
    assert all(r.seasonal == 1.0 for r in unseen) and len(out) == 12


def test_single_month_is_flat(spark):
    out = Fc.future_only(Fc.forecast(series_frame(spark, [50]))).collect()
    assert {r.yhat for r in out} == {50.0}


def test_floor_and_horizon(spark):
    falling = series_frame(spark, [100 - 9 * i for i in range(12)])
    out = Fc.forecast(falling, Fc.ForecastParams(horizon=3, floor_zero=True))
    future = Fc.future_only(out).collect()
    assert len(future) == 3 and all(r.yhat >= 0 and r.lower >= 0 for r in future)


def test_series_are_independent(spark):
    a, b = series_frame(spark, range(10, 34), "a"), series_frame(spark, range(500, 476, -1), "b")
    alone = Fc.forecast(a).select("ds", "yhat")
    together = Fc.forecast(a.unionByName(b)).where("series = 'a'").select("ds", "yhat")
    left = {r.ds: r.yhat for r in alone.collect()}
    right = {r.ds: r.yhat for r in together.collect()}
    assert left == pytest.approx(right)


def test_summary_total_and_long_form(spark):
    prediction = Fc.forecast(series_frame(spark, [1_234_567] * 24))
    table = Fc.summary(prediction)
    row = table.orderBy("month_start").first()
    assert (row.month, row.forecast_m, row.arm_below_m) == ("January 2020", 1.23, 0.0)
    assert Fc.horizon_total(table).first().total_forecast_m == 14.76
    labels = {r.label: r["count"] for r in Fc.long_frame(prediction).groupBy("label").count().collect()}
    assert labels == {"history": 24, "forecast": 12}


# --- questions ---------------------------------------------------------------


@pytest.mark.parametrize(
    "text,intent",
    [
        ("WHERE do we earn most?", "state"),
        ("Which items sell in spring by state", "state"),
        ("Which menu do men like", "item"),
        ("What do we sell in Spring?", "item"),
        ("was the fall good", "season"),
        ("which kind pays", "category"),
        ("how many comments", "gender"),
        ("how much revenue", "default"),
        ("", "default"),
    ],
)
def test_first_matching_rule_wins(spark, text, intent):
    df = spark.createDataFrame([(text,)], "question string")
    assert routing.route(df).first().intent == intent


def test_long_questions_are_read_whole(spark):
    df = spark.createDataFrame([("x" * 50_000 + " winter",)], "question string")
    assert routing.route(df).first().intent == "season"


def test_insight(spark, make_lines):
    star = Star.from_lines(make_lines({"profit": Decimal("1500")}, {"chain": "south", "quantity": 9}))
    questions = spark.createDataFrame([("which state",), ("best item",), ("total",)], "question string")
    got = {
        r.question: r.insight
        for r in routing.answer(routing.route(questions), facts.top_answers(star)).collect()
    }
    assert got == {
        "which state": "Top state: Ohio (Profit K 1.5)",
        "best item": "Top item: soup (Category Starters)",
        "total": "Top default: north (Revenue M 0.00)",
    }


# --- sources -----------------------------------------------------------------


def test_csv_round_trip_keeps_types_and_nulls(spark, make_lines):
    lines = make_lines({"gender": None, "order_number": None}, {}).select(*S.LINE_COLUMNS)
    path = scratch_path(spark, "test-csv")
    Feeds.write_csv(lines, path)
    back = Feeds.read_csv(spark, path, S.line_schema(), line_ends=True)
    assert back.schema == S.line_schema()
    assert back.exceptAll(lines).isEmpty() and back.count() == 2


def test_optional_source(spark):
    missing = Feeds.read_optional_csv(spark, scratch_path(spark, "none"), S.FORECAST_SUMMARY)
    assert missing.count() == 0
    assert Fc.horizon_total(missing).count() == 0


def test_audit_log_appends(spark):
    folder = scratch_path(spark, "test-log")
    run = spark.createDataFrame([("load", "rows", 1)], "step string, metric string, value long")
    assert W.append_log(run, folder, "first") == "first"
    second = W.append_log(run, folder)
    rows = spark.read.parquet(folder).collect()
    assert {r.run_id for r in rows} == {"first", second} and all(r.logged_at for r in rows)

"""Cleaning on hand-made raw feeds."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave import schema as S
from tillweave.functions import cleaning as C
from tillweave.operators import cleaning as Clean
from tillweave.operators import quality as Q
from tillweave.sources import sample_tables as B

RAW = {
    "customer_id": "c1",
    "order_number": "12",
    "restaurant_id": 7,
    "restaurant_city": "Springfield",
    "restaurant_state": "Ohio",
    "restaurant_zip_code": 11111,
    "order_purchase_date": "2018-07-04",
    "order_purchase_time": "09:30:15",
    "order_purchase_method": "Delivery",
    "coupon_y_n": "Y",
    "order_alcohol_purchased": 1,
    "customer_with_children": 0,
    "gender_customer_payee": "M",
    "item_number": 3,
    "item_description": "soup",
    "item_code": "S3",
    "item_category": "salad",
    "quantity": 2,
    "menu_price": Decimal("5.00"),
    "item_total_cost": Decimal("10.00"),
    "profit": Decimal("8.0000"),
    "order_total_cost": Decimal("100.00"),
}

CONFIG = Clean.FeedConfig("north", 0, category_map={"salad": "Salads"}, sentinel_year=1970)


def raw_feed(spark, *rows, extra=None):
    schema = S.raw_schema({**(extra or {}), S.ROW_ORDINAL: T.LongType()})
    numbered = [{**RAW, S.ROW_ORDINAL: i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame(
        [tuple(row.get(f.name) for f in schema.fields) for row in numbered], schema
    )


def clean_one(spark, cfg=CONFIG, **row):
    return Clean.clean_feed(raw_feed(spark, row), cfg).first()


def test_clean_row(spark):
    row = clean_one(spark)
    assert row.chain == "north" and row.order_number == 12
    assert row.order_purchase_date == dt.date(2018, 7, 4)
    assert (row.order_month, row.order_month_name, row.order_year) == (7, "July", 2018)
    assert (row.season, row.order_purchase_time, row.time_of_day) == ("Summer", "09:30", "AM")
    assert (row.coupon_used, row.alcohol_purchased, row.has_children) == ("Yes", "Yes", "No")
    assert (row.gender, row.item_category) == ("M", "Salads")


def test_output_columns(spark):
    df = Clean.clean_feed(raw_feed(spark, {}), CONFIG)
    assert tuple(df.columns) == (*S.LINE_COLUMNS, *S.BOOKKEEPING)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2018-02-28", dt.date(2018, 2, 28)),
        ("2018-02-28 13:00:00", dt.date(2018, 2, 28)),
        ("2018-02-30", None),
        ("43101", None),
        ("soon", None),
        ("", None),
        (None, None),
        ("1970-01-01", None),
    ],
)
def test_dates(spark, text, expected):
    row = clean_one(spark, order_purchase_date=text)
    assert row.order_purchase_date == expected
    if expected is None:
        assert (row.order_month, row.order_month_name, row.order_year, row.season) == (None,) * 4


def test_extra_date_format(spark):
    cfg = Clean.FeedConfig("north", 0, date_formats=("dd/MM/yyyy",))
    assert clean_one(spark, cfg, order_purchase_date="28/02/2018").order_purchase_date == dt.date(2018, 2, 28)


def test_serial_numbers_become_sentinel_dates(spark):
    serials = spark.createDataFrame([(43101,)], "order_purchase_date bigint")
    parsed = Clean.parse_dates(serials, CONFIG)
    assert parsed.first()[0] == dt.date(1970, 1, 1)
    assert Clean.null_sentinel_dates(parsed, CONFIG).first()[0] is None


@pytest.mark.parametrize(
    "text,expected",
    [("12", 12), ("12.0", 12), ("12.5", None), ("A12", None), ("", None), (None, None), ("nan", None)],
)
def test_order_numbers(spark, text, expected):
    assert clean_one(spark, order_number=text).order_number == expected


@pytest.mark.parametrize(
    "text,clock,half",
    [
        ("00:00:00", "00:00", "AM"),
        ("11:59:59", "11:59", "AM"),
        ("12:00:00", "12:00", "PM"),
        ("25:00:00", None, "PM"),
        ("late", None, "PM"),
        (None, None, "PM"),
    ],
)
def test_times_and_unknown_time_is_pm(spark, text, clock, half):
    row = clean_one(spark, order_purchase_time=text)
    assert (row.order_purchase_time, row.time_of_day) == (clock, half)


def test_unmapped_flag_is_null_but_unmapped_category_stays(spark):
    row = clean_one(
        spark, coupon_y_n="?", order_alcohol_purchased=9, customer_with_children=None,
        item_category="Pho",
    )
    assert (row.coupon_used, row.alcohol_purchased, row.has_children) == (None, None, None)
    assert row.item_category == "Pho"


def test_category_from_dictionary_table(spark):
    df = spark.createDataFrame([("salad",), ("Pho",), (None,)], "item_category string")
    words = spark.createDataFrame([("salad", "Salads")], "raw string, shown string")
    got = Clean.map_from_table(df, "item_category", words, "raw", "shown").collect()
    assert {r[0] for r in got} == {"Salads", "Pho", None}


@pytest.mark.parametrize("month", range(1, 13))
def test_seasons(spark, month):
    expected = {12: "Winter", 1: "Winter", 2: "Winter"}.get(
        month, "Spring" if month < 6 else "Summer" if month < 9 else "Fall"
    )
    assert spark.range(1).select(C.season_of(F.lit(month))).first()[0] == expected


def test_profit_spelling(spark):
    feed = raw_feed(spark, {}).withColumnRenamed("profit", "Profit")
    assert "profit" in Clean.clean_feed(feed, CONFIG).columns


def test_drop_all_null(spark):
    extra = {"item_product_cost": T.DoubleType()}
    feed = raw_feed(spark, {}, {}, extra=extra)
    assert "item_product_cost" not in Q.drop_all_null(feed, ["item_product_cost", "quantity"]).columns
    kept = feed.withColumn("item_product_cost", F.lit(1.0))
    assert "item_product_cost" in Q.drop_all_null(kept, ["item_product_cost"]).columns


def test_merge_keeps_duplicates_and_fills_missing(spark):
    a = Clean.clean_feed(raw_feed(spark, {}, {}), CONFIG)
    b = Clean.clean_feed(raw_feed(spark, {}), Clean.FeedConfig("south", 1)).drop("gender")
    merged = Clean.merge_feeds([a, b])
    assert merged.count() == 3
    assert merged.where("chain = 'south'").first().gender is None


def test_audit_counts(spark):
    feed = raw_feed(
        spark,
        {"order_purchase_date": "1970-01-01"},
        {"order_purchase_date": "x", "order_number": "y"},
        {"order_purchase_time": "z", "item_category": "Pho"},
    )
    audit = {r.metric: r.value for r in Q.clean_audit(feed, CONFIG).collect()}
    assert audit == {
        "rows": 3,
        "unparsed_dates": 1,
        "out_of_range_dates": 0,
        "sentinel_dates": 1,
        "suspicious_dates": 1,
        "unparsed_order_numbers": 1,
        "unparsed_times": 1,
        "relabelled_categories": 2,
    }


def test_issue_table_lists_only_what_happened(spark):
    cfg = Clean.FeedConfig("south", 1, drop_columns=("item_product_cost",))
    feed = raw_feed(spark, {}, {}, extra={"item_product_cost": T.DoubleType()})
    issues = {(r.issue, r.rows) for r in Q.issue_table([(feed, cfg)]).collect()}
    assert issues == {("empty_column", 2), ("untagged_rows", 2)}


def test_null_profile(spark, make_lines):
    lines = make_lines({"gender": None}, {}, {})
    rows = Q.null_profile(lines, S.LINE_COLUMNS).collect()
    assert [(r.column_name, r.nulls, r.null_pct) for r in rows] == [("gender", 1, 33.33)]


def test_serial_text_is_a_corrupt_date(spark):
    feed = raw_feed(
        spark,
        {"order_purchase_date": "43101"},
        {"order_purchase_date": "20180704"},
        {"order_purchase_date": "1500-01-01"},
    )
    audit = {r.metric: r.value for r in Q.clean_audit(feed, CONFIG).collect()}
    found = [audit[m] for m in ("sentinel_dates", "unparsed_dates", "out_of_range_dates")]
    assert found == [1, 1, 1]
    assert Q.bad_dates(Clean.parse_dates(feed, CONFIG), CONFIG).first().bad_dates == 1
    wide = Clean.FeedConfig("north", 0, first_date="1400-01-01", date_formats=("yyyyMMdd",))
    dates = [r.order_purchase_date for r in Clean.clean_feed(feed, wide).collect()]
    assert dates == [dt.date(1970, 1, 1), dt.date(2018, 7, 4), dt.date(1500, 1, 1)]

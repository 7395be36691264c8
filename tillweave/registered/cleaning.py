"""Each cleaning step on its own, then whole feeds and their union."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.functions import cleaning as C
from tillweave.operators import cleaning as Clean
from tillweave.operators import quality as Q
from tillweave.operators.filters import keep_known, keep_selected
from tillweave.plans import shaped
from tillweave.registered import base as R
from tillweave.registered.base import registered
from tillweave.sources import sample_tables as B


@registered("clean_feed", f"SELECT {R.SHOWN_LINE} FROM lines WHERE chain = 'F'")
def clean_feed(spark, sf_dir):
    """The whole pipeline over the first feed's raw text."""
    cleaned = Clean.clean_feed(B.raw_feed(spark, sf_dir, B.FEED_A), B.FEED_A)
    return R.iso_dates(cleaned.drop(*S.BOOKKEEPING))


@registered("clean_union", f"SELECT {R.SHOWN_LINE} FROM lines")
def clean_union(spark, sf_dir):
    """Both feeds cleaned, aligned and merged."""
    cleaned = [Clean.clean_feed(B.raw_feed(spark, sf_dir, cfg), cfg) for cfg in B.FEEDS]
    return R.iso_dates(Clean.merge_feeds(cleaned).drop(*S.BOOKKEEPING))


def _dated(spark, sf_dir):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = F.col("o_orderkey")
    junk = (
        F.when(key % 50 == 0, F.lit("not a date"))
        .when(key % 50 == 1, F.lit("2021-02-30"))
        .when(key % 50 == 2, F.lit("43101"))
        .otherwise(text)
    )
    return B.table(spark, sf_dir, "orders").select(
        key.alias("order_number"), junk.alias("order_purchase_date")
    )


_DATED = """(SELECT o_orderkey AS order_number,
    CASE WHEN o_orderkey % 50 IN (0, 1) THEN NULL
         WHEN o_orderkey % 50 = 2 THEN DATE '1970-01-01'
         ELSE CAST(o_orderdate AS DATE) END AS day
  FROM orders)"""


@registered(
    "parse_dates", f"SELECT order_number, strftime(day, '%Y-%m-%d') AS parsed FROM {_DATED}"
)
def parse_dates(spark, sf_dir):
    parsed = Clean.parse_dates(_dated(spark, sf_dir), B.FEED_A)
    return parsed.select("order_number", F.col("order_purchase_date").cast("string").alias("parsed"))


@registered(
    "null_sentinel_dates",
    f"""SELECT order_number, strftime(CASE WHEN year(day) <> 1995 THEN day END, '%Y-%m-%d') AS kept,
          CASE WHEN year(day) = 1995 THEN 1 ELSE 0 END AS was_sentinel
        FROM {_DATED}""",
)
def null_sentinel_dates(spark, sf_dir):
    parsed = Clean.parse_dates(_dated(spark, sf_dir), B.FEED_A)
    day = F.col("order_purchase_date")
    flagged = parsed.withColumn(
        "was_sentinel", F.when(F.year(day) == B.SENTINEL_YEAR, 1).otherwise(0)
    )
    return Clean.null_sentinel_dates(flagged, B.FEED_A).select(
        "order_number", day.cast("string").alias("kept"), "was_sentinel"
    )


@registered(
    "parse_order_number",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 50 IN (0, 2) THEN NULL ELSE o_orderkey END
         AS order_number FROM orders""",
)
def parse_order_number(spark, sf_dir):
    key = F.col("o_orderkey")
    text = key.cast("string")
    raw = (
        F.when(key % 50 == 0, F.concat(F.lit("N/A "), text))
        .when(key % 50 == 1, F.concat(text, F.lit(".0")))
        .when(key % 50 == 2, F.lit(""))
        .otherwise(text)
    )
    orders = B.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("order_number"))
    return Clean.parse_order_number(orders, B.FEED_A)


@registered(
    "map_category",
    """SELECT p_partkey AS item_number, p_type AS raw_category,
         CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'LARGE' THEN 'Large'
              WHEN 'SMALL' THEN 'Small' ELSE p_type END AS category_first,
         CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promo'
              WHEN 'SMALL' THEN 'Small' ELSE p_type END AS category_second
       FROM part""",
)
def map_category(spark, sf_dir):
    """Both feeds' dictionaries, one as an expression and one as a dictionary table."""
    parts = B.table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_number"),
        F.col("p_type").alias("raw_category"),
        F.col("p_type").alias("item_category"),
        F.col("p_type").alias("category_second"),
    )
    first = Clean.map_category(parts, B.FEED_A).withColumnRenamed("item_category", "category_first")
    dictionary = spark.createDataFrame(
        list(B.FEED_B.category_map.items()), "raw string, shown string"
    )
    return Clean.map_from_table(first, "category_second", dictionary, "raw", "shown")


_CLOCK = """(SELECT event_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE ts END AS t FROM events)"""


@registered(
    "normalize_time", f"SELECT event_id, strftime(t, '%H:%M') AS order_purchase_time FROM {_CLOCK}"
)
def normalize_time(spark, sf_dir):
    events = B.event_clock(spark, sf_dir)
    return events.select("event_id", C.clock_text(F.col("raw_time")).alias("order_purchase_time"))


@registered(
    "time_of_day",
    f"""SELECT event_id, CASE WHEN hour(t) < 12 THEN 'AM' ELSE 'PM' END AS time_of_day
        FROM {_CLOCK}""",
)
def time_of_day(spark, sf_dir):
    events = B.event_clock(spark, sf_dir).withColumnRenamed("raw_time", "order_purchase_time")
    return Clean.add_times(events, B.FEED_A).select("event_id", "time_of_day")


@registered(
    "calendar_cols",
    f"""SELECT order_number, CAST(month(day) AS INTEGER) AS order_month,
          strftime(day, '%B') AS order_month_name, CAST(year(day) AS INTEGER) AS order_year
        FROM {_DATED}""",
)
def calendar_cols(spark, sf_dir):
    parsed = Clean.parse_dates(_dated(spark, sf_dir), B.FEED_A)
    return Clean.add_calendar(parsed).drop("order_purchase_date")


@registered(
    "season_col",
    f"""SELECT order_number,
          CASE WHEN month(day) IN (12, 1, 2) THEN 'Winter' WHEN month(day) IN (3, 4, 5) THEN 'Spring'
               WHEN month(day) IN (6, 7, 8) THEN 'Summer' WHEN day IS NOT NULL THEN 'Fall' END
            AS season
        FROM {_DATED}""",
)
def season_col(spark, sf_dir):
    parsed = Clean.parse_dates(_dated(spark, sf_dir), B.FEED_A)
    return Clean.add_season(Clean.add_calendar(parsed), B.FEED_A).select("order_number", "season")


@registered(
    "flag_labels",
    "SELECT chain, row_ordinal, coupon_used, alcohol_purchased, has_children, gender FROM lines",
)
def flag_labels(spark, sf_dir):
    raw = ["coupon_y_n", "order_alcohol_purchased", "customer_with_children",
           "gender_customer_payee", S.ROW_ORDINAL]
    sides = [
        Clean.tag_feed(Clean.add_labels(B.raw_feed(spark, sf_dir, cfg, raw), cfg), cfg)
        for cfg in B.FEEDS
    ]
    return Clean.merge_feeds(sides).select(
        "chain", S.ROW_ORDINAL, "coupon_used", "alcohol_purchased", "has_children", "gender"
    )


_SECOND_FEED = [c if c != "profit" else "Profit" for c in S.RAW_FIELDS] + ["item_product_cost"]


@registered(
    "drop_all_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) AS known, 0 AS all_null, 1 AS kept"
        " FROM lineitem WHERE l_linestatus = 'O'"
        for c in _SECOND_FEED[:-1]
    )
    + " UNION ALL SELECT 'item_product_cost', CAST(0 AS BIGINT), 1, 0",
)
def drop_all_null(spark, sf_dir):
    """Known values of every column of the second feed, and which columns are then left."""
    raw = B.raw_feed(spark, sf_dir, B.FEED_B).drop(S.ROW_ORDINAL)
    left = Q.drop_all_null(raw, raw.columns).columns
    found = Q.all_null_columns(raw, raw.columns)
    return found.withColumn("kept", F.col("column_name").isin(left).cast("int"))


@registered(
    "distinct_periods",
    """SELECT DISTINCT order_year, order_month, order_month_name || ' ' || order_year AS period
       FROM lines WHERE order_purchase_date IS NOT NULL""",
)
def distinct_periods(spark, sf_dir):
    columns = ["order_purchase_date", "order_year", "order_month", "order_month_name"]
    return shaped.distinct_periods(R.dataset(spark, sf_dir, columns))


@registered(
    "filter_not_null",
    """SELECT chain, row_ordinal, item_number, season FROM lines
       WHERE order_purchase_date IS NOT NULL AND has_children IS NOT NULL""",
)
def filter_not_null(spark, sf_dir):
    columns = ["chain", S.ROW_ORDINAL, "item_number", "season"]
    lines = R.lines(spark, sf_dir, [*columns, "order_purchase_date", "has_children"])
    return keep_known(lines, ["order_purchase_date", "has_children"]).select(*columns)


@registered(
    "filter_multi_select",
    """SELECT chain, row_ordinal, item_number, season, gender FROM lines
       WHERE season IN ('Spring', 'Winter') AND gender IN ('BUILDING', 'MACHINERY')""",
)
def filter_multi_select(spark, sf_dir):
    """Two filters set, one left empty: the empty one does not filter."""
    chosen = {"chain": [], "season": ["Spring", "Winter"], "gender": ["BUILDING", "MACHINERY"]}
    columns = ["chain", S.ROW_ORDINAL, "item_number", "season", "gender"]
    return keep_selected(R.lines(spark, sf_dir, columns), chosen)

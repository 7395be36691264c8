"""Table schemas and the column groups the rest of the package refers to."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PROFIT = T.DecimalType(18, 4)

# Bookkeeping columns: which feed a row came from and where it stood in that
# feed.  Together they define "first row wins" and sequential numbering.
FEED_RANK = "feed_rank"
ROW_ORDINAL = "row_ordinal"
BOOKKEEPING = (FEED_RANK, ROW_ORDINAL)

LOCATION_COLUMNS = ("restaurant_city", "restaurant_state", "restaurant_zip_code")
MONEY_COLUMNS = ("menu_price", "item_total_cost", "profit", "order_total_cost")

RAW_FIELDS = {
    "customer_id": T.StringType(),
    "order_number": T.StringType(),
    "restaurant_id": T.LongType(),
    "restaurant_city": T.StringType(),
    "restaurant_state": T.StringType(),
    "restaurant_zip_code": T.LongType(),
    "order_purchase_date": T.StringType(),
    "order_purchase_time": T.StringType(),
    "order_purchase_method": T.StringType(),
    "coupon_y_n": T.StringType(),
    "order_alcohol_purchased": T.IntegerType(),
    "customer_with_children": T.IntegerType(),
    "gender_customer_payee": T.StringType(),
    "item_number": T.LongType(),
    "item_description": T.StringType(),
    "item_code": T.StringType(),
    "item_category": T.StringType(),
    "quantity": T.LongType(),
    "menu_price": MONEY,
    "item_total_cost": MONEY,
    "profit": PROFIT,
    "order_total_cost": MONEY,
}

LINE_FIELDS = {
    "chain": T.StringType(),
    "customer_id": T.StringType(),
    "order_number": T.LongType(),
    "restaurant_id": T.LongType(),
    "restaurant_city": T.StringType(),
    "restaurant_state": T.StringType(),
    "restaurant_zip_code": T.LongType(),
    "order_purchase_date": T.DateType(),
    "order_purchase_time": T.StringType(),
    "time_of_day": T.StringType(),
    "order_month": T.IntegerType(),
    "order_month_name": T.StringType(),
    "order_year": T.IntegerType(),
    "season": T.StringType(),
    "order_purchase_method": T.StringType(),
    "coupon_used": T.StringType(),
    "alcohol_purchased": T.StringType(),
    "gender": T.StringType(),
    "has_children": T.StringType(),
    "item_number": T.LongType(),
    "item_description": T.StringType(),
    "item_code": T.StringType(),
    "item_category": T.StringType(),
    "quantity": T.LongType(),
    "menu_price": MONEY,
    "item_total_cost": MONEY,
    "profit": PROFIT,
    "order_total_cost": MONEY,
}

LINE_COLUMNS = tuple(LINE_FIELDS)
# What a stored line holds: money of a projected line is whole units.
STORED_FIELDS = {**LINE_FIELDS, FEED_RANK: T.IntegerType(), ROW_ORDINAL: T.LongType()}
FACT_COLUMNS = tuple(c for c in LINE_COLUMNS if c not in LOCATION_COLUMNS)

# Primary keys of the star.  An item number may be used by both chains, so the
# product key includes the chain.
TABLE_KEYS = {
    "restaurants": ("restaurant_id",),
    "products": ("item_number", "chain"),
    "customers": ("customer_id",),
}


def struct_of(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


def raw_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """Schema of a raw feed; `extra` adds feed-specific columns."""
    return struct_of({**RAW_FIELDS, **(extra or {})})


def line_schema() -> T.StructType:
    """Schema of cleaned, merged order lines."""
    return struct_of(LINE_FIELDS)


FORECAST_SUMMARY = struct_of(
    {
        "series": T.StringType(),
        "month_start": T.DateType(),
        "month": T.StringType(),
        "forecast_m": T.DoubleType(),
        "lower_m": T.DoubleType(),
        "upper_m": T.DoubleType(),
    }
)

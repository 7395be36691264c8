from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillweave import schema as S  # noqa: E402
from tillweave.session import build_session, clear_scratch  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


_DEFAULTS = {
    "chain": "north",
    "customer_id": "c1",
    "order_number": 1,
    "restaurant_id": 1,
    "restaurant_city": "Springfield",
    "restaurant_state": "Ohio",
    "restaurant_zip_code": 11111,
    "order_purchase_date": dt.date(2018, 3, 5),
    "order_purchase_time": "10:15",
    "time_of_day": "AM",
    "order_month": 3,
    "order_month_name": "March",
    "order_year": 2018,
    "season": "Spring",
    "order_purchase_method": "Dine In",
    "coupon_used": "No",
    "alcohol_purchased": "No",
    "gender": "F",
    "has_children": "No",
    "item_number": 1,
    "item_description": "soup",
    "item_code": "S1",
    "item_category": "Starters",
    "quantity": 2,
    "menu_price": Decimal("5.00"),
    "item_total_cost": Decimal("10.00"),
    "profit": Decimal("8.0000"),
    "order_total_cost": Decimal("100.00"),
}


@pytest.fixture(scope="session")
def make_lines(spark):
    """Lines from partial rows; the row's place in the list is its ordinal."""

    def build(*rows):
        schema = S.struct_of(
            {**S.LINE_FIELDS, "feed_rank": S.T.IntegerType(), "row_ordinal": S.T.LongType()}
        )
        full = []
        for i, row in enumerate(rows):
            values = {**_DEFAULTS, "feed_rank": 0, "row_ordinal": i, **row}
            full.append(tuple(values[f.name] for f in schema.fields))
        return spark.createDataFrame(full, schema)

    return build

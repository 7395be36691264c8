"""Binding of the sample tables to raw feeds.

Line status plays the chain, supplier the restaurant, market segment the
gender, order priority the purchase method.  Junk is planted by fixed key
rules so that every lenient step has something to do.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.functions import cleaning as C
from tillweave.operators.cleaning import FeedConfig
from tillweave.operators.scenario import ScenarioParams

SENTINEL_YEAR = 1995

FEED_A = FeedConfig(
    chain="F",
    rank=0,
    category_map={"ECONOMY": "Economy", "LARGE": "Large", "SMALL": "Small"},
    sentinel_year=SENTINEL_YEAR,
    suspicious_before=1997,
)
FEED_B = FeedConfig(
    chain="O",
    rank=1,
    category_map={"ECONOMY": "Economy", "PROMO": "Promo", "SMALL": "Small"},
    sentinel_year=SENTINEL_YEAR,
    suspicious_before=1997,
    drop_columns=("item_product_cost",),
)
FEEDS = (FEED_A, FEED_B)

SCENARIO = ScenarioParams(
    years=6,
    growth={"F": 0.08, "O": 0.07},
    uplift_method="5-LOW",
    uplift=1.05,
    id_prefix={"F": "F2024", "O": "O2024"},
)

# What the dashboard filters offer; all chosen by default.
DEFAULT_SELECTION = {
    "chain": ["F", "O"],
    "season": list(C.SEASONS),
    "gender": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "order_purchase_method": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}

# Order in which new customer ids are given out.
LINE_ORDER = [
    S.ROW_ORDINAL, "item_number", "restaurant_id", "quantity", "item_total_cost", "profit",
    "order_total_cost",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Column rules of the binding, as SQL text.  The sample money columns are
# doubles of two decimals; scaling them to whole cents first is exact and much
# cheaper per row than a double-to-decimal cast.


def _units(units: str, scale: int) -> str:
    unit = format(Decimal(1).scaleb(-scale), "f")
    return f"CAST(CAST({units} AS DECIMAL(18,0)) * {unit}BD AS DECIMAL(18,{scale}))"


def _money(column: str) -> str:
    return _units(f"CAST(rint({column} * 100D) AS BIGINT)", S.MONEY.scale)


def _net() -> str:
    cents = "CAST(rint(l_extendedprice * 100D) AS BIGINT)"
    kept = "(100 - CAST(rint(l_discount * 100D) AS BIGINT))"
    return _units(f"{cents} * {kept}", S.PROFIT.scale)


_SECONDS = "(l_orderkey * 7919 % 86400)"
_HOUR, _MINUTE, _SECOND = f"{_SECONDS} DIV 3600", f"{_SECONDS} % 3600 DIV 60", f"{_SECONDS} % 60"


def _clock(*parts: str) -> str:
    return "concat_ws(':', " + ", ".join(f"lpad(CAST({p} AS STRING), 2, '0')" for p in parts) + ")"


_PLACE_COLUMNS = S.LOCATION_COLUMNS
_PART_COLUMNS = ("item_description", "item_code", "item_type", "menu_price")


#: Columns of each table that expressions of the binding may name.
_LINE_FIELDS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
_ORDER_FIELDS = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
_PLACE_SQL = {
    "restaurant_city": "n_name",
    "restaurant_state": "n_name",
    "restaurant_zip_code": "CAST(n_nationkey + 10000 AS BIGINT)",
}
_PART_SQL = {
    "item_description": "p_name",
    "item_code": "p_brand",
    "item_type": "p_type",
    "menu_price": _money("p_retailprice"),
}


def _assemble(
    lines: DataFrame,
    spark: SparkSession,
    sf_dir: str,
    line_sql: dict[str, str],
    order_sql: dict[str, str],
    need: set[str],
) -> DataFrame:
    """Lines with the needed columns, joining only the tables those come from.

    Every key resolves in the sample tables, so leaving a join out changes no
    row; the load checks that every line finds its dimensions.  No join is
    hinted: small sides are broadcast by their size and large ones shuffled,
    with skew handled by adaptive execution.  What is shuffled are the columns
    of the tables as they are; all columns that are made of them, and are wider,
    are made behind the joins.  Parts come last, so lines of a part are stored
    together and the product dimension combines them before it shuffles.
    """
    made = {n: e for n, e in {**line_sql, **order_sql}.items() if n in need}
    wants_place = bool(need & set(_PLACE_COLUMNS))
    wants_customer = wants_place or "gender" in need
    wants_order = bool(need & set(order_sql)) or wants_customer
    wants_part = bool(need & set(_PART_COLUMNS))

    frame = lines.select(*_LINE_FIELDS)
    if wants_order:
        orders = table(spark, sf_dir, "orders").select(*_ORDER_FIELDS)
        if wants_customer:
            customers = table(spark, sf_dir, "customer").select(
                "c_custkey", "c_nationkey", "c_mktsegment"
            )
            made["gender"] = "c_mktsegment"
            if wants_place:
                nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
                customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
                made |= _PLACE_SQL
            orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        frame = frame.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if wants_part:
        parts = table(spark, sf_dir, "part").select(
            "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice"
        )
        frame = frame.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        made |= _PART_SQL
    return frame.selectExpr(*[f"{e} AS {n}" for n, e in made.items() if n in need])


def _raw_line_sql(cfg: FeedConfig) -> dict[str, str]:
    number = "CAST(l_orderkey AS STRING)"
    if cfg.rank == FEED_A.rank:
        number = f"CASE WHEN l_orderkey % 50 = 0 THEN concat('N/A ', {number}) ELSE {number} END"
    clock = _clock(_HOUR, _MINUTE, _SECOND)
    columns = {
        S.ROW_ORDINAL: "l_orderkey * 10 + l_linenumber",
        "order_number": number,
        "restaurant_id": "l_suppkey",
        "order_purchase_time": f"CASE WHEN l_orderkey % 50 = 1 THEN 'closed' ELSE {clock} END",
        "coupon_y_n": "CASE WHEN l_discount > 0 THEN 'Y' ELSE 'N' END",
        "order_alcohol_purchased": "CASE WHEN l_tax > 0 THEN 1 ELSE 0 END",
        "customer_with_children": "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'N' THEN 0 ELSE 9 END",
        "item_number": "l_partkey",
        "quantity": "CAST(l_quantity AS BIGINT)",
        "item_total_cost": _money("l_extendedprice"),
        "Profit": _net(),
    }
    if "item_product_cost" in cfg.drop_columns:
        columns["item_product_cost"] = "CAST(NULL AS DOUBLE)"
    return columns


_RAW_ORDER_SQL = {
    "customer_id": "CAST(o_custkey AS STRING)",
    "order_purchase_date": "CASE WHEN l_orderkey % 97 = 0 THEN 'not a date'"
    " ELSE date_format(o_orderdate, 'yyyy-MM-dd') END",
    "order_purchase_method": "o_orderpriority",
    "order_total_cost": _money("o_totalprice"),
}


_RAW_NAMES = {"gender_customer_payee": "gender", "item_category": "item_type"}


def raw_feed(
    spark: SparkSession, sf_dir: str, cfg: FeedConfig, columns: Iterable[str] | None = None
) -> DataFrame:
    """One chain's raw feed: text dates, numbers and times, coded flags, planted junk."""
    every = [c if c != "profit" else "Profit" for c in S.RAW_FIELDS] + [S.ROW_ORDINAL]
    wanted = list(columns or [*every, *cfg.drop_columns])
    need = {_RAW_NAMES.get(c, c) for c in wanted}
    source = table(spark, sf_dir, "lineitem").where(F.col("l_linestatus") == cfg.chain)
    frame = _assemble(source, spark, sf_dir, _raw_line_sql(cfg), _RAW_ORDER_SQL, need)
    return frame.select(*[F.col(_RAW_NAMES.get(c, c)).alias(c) for c in wanted])


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions: every user turn of the conversations, and one about every part."""
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("question_id"),
        F.col("text").alias("question"),
    )
    # One question form per remainder of the part key.
    forms = (
        "Which state buys the %s most?",
        "How many units of %s did we sell in Spring?",
        "Was Fall good for the %s?",
        "What kind of %s pays best?",
        "Do women or men order the %s?",
        "Is the %s on the menu for men?",
        "How much did the %s bring in?",
    )
    form = F.element_at(
        F.array(*[F.lit(f) for f in forms]), (F.col("p_partkey") % len(forms) + 1).cast("int")
    )
    parts = table(spark, sf_dir, "part").select(
        F.concat_ws("-", F.lit("part"), F.col("p_partkey").cast("string")).alias("question_id"),
        F.replace(form, F.lit("%s"), F.col("p_name")).alias("question"),
    )
    return turns.unionByName(parts)


def event_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw clock text of every event, every fiftieth unreadable."""
    text = F.date_format("ts", "HH:mm:ss")
    junk = F.when(F.col("event_id") % 50 == 0, F.lit("25:61:00")).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", junk.alias("raw_time"))

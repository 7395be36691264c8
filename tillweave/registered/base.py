"""Registry, dataset builders and the SQL shared by the checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.operators.cleaning import clean_feed, merge_feeds
from tillweave.operators.scenario import project, project_values
from tillweave.operators.star import Star
from tillweave.plans.catalogue import CATALOGUE
from tillweave.plans.report import ReportSpec, run_report
from tillweave.session import ON_CLEAR, folder_state, scratch_path
from tillweave.sources import sample_tables as B
from tillweave.sources.warehouse import write_star

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

CALENDAR = {"order_month", "order_month_name", "order_year"}


def registered(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = PRELUDE + sql
        return fn

    return keep


_STARS: dict[tuple, Star] = {}
ON_CLEAR.append(_STARS.clear)


def load_star(spark: SparkSession, sf_dir: str) -> Star:
    """The sample feeds, cleaned, merged and loaded as a star."""
    feeds = [clean_feed(B.raw_feed(spark, sf_dir, cfg), cfg) for cfg in B.FEEDS]
    return write_star(spark, merge_feeds(feeds), scratch_path(spark, "star"))


def load_projected_star(spark: SparkSession, sf_dir: str) -> Star:
    """The loaded lines, projected and loaded as a star of their own."""
    projected = project(stored_star(spark, sf_dir).lines, B.SCENARIO, B.LINE_ORDER, unique=True)
    return write_star(spark, projected, scratch_path(spark, "projected-star"))


def stored_star(spark: SparkSession, sf_dir: str, projected: bool = False) -> Star:
    """The star of these tables, loaded by the application's first query that needs it.

    It is loaded anew once scratch data was cleared or a table in the folder was written anew.
    """
    key = (spark.sparkContext.applicationId, sf_dir, projected, folder_state(spark, sf_dir))
    if key not in _STARS:
        load = load_projected_star if projected else load_star
        _STARS[key] = load(spark, sf_dir)
    return _STARS[key]


def lines(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame:
    """The asked-for columns of the stored order lines."""
    return stored_star(spark, sf_dir).lines.select(*dict.fromkeys(columns))


def dataset(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str],
    projected: bool = False,
    located: bool = False,
) -> Star:
    """The stored star, reduced to what a report reads.

    The projected dataset is computed from the stored lines: projecting values
    is arithmetic within a row.  It also needs the columns its rules look at.
    Restaurants are the same in both.
    """
    need = set(columns) - set(S.LOCATION_COLUMNS)
    asked = sorted(need)
    if projected:
        if need & CALENDAR:
            need.add("order_purchase_date")
        if "order_total_cost" in need:
            need.add("order_purchase_method")
        if need & set(S.MONEY_COLUMNS):
            need.add("chain")
    orders = lines(spark, sf_dir, sorted(need))
    if projected:
        orders = project_values(orders, B.SCENARIO)
    places = stored_star(spark, sf_dir).restaurants if located else None
    return Star(orders=orders.select(*asked), restaurants=places)


def star_for(
    spark: SparkSession,
    sf_dir: str,
    spec: ReportSpec,
    projected: bool = False,
    selection: Mapping | None = None,
    extra: Iterable[str] = (),
) -> Star:
    columns = spec.columns(selection) | set(extra)
    return dataset(spark, sf_dir, columns, projected, spec.located())


def register_report(
    name: str,
    sql: str,
    projected: bool = False,
    selection: Mapping | None = None,
    spec: ReportSpec | None = None,
) -> None:
    """Register a catalogue report under its own name."""
    chosen = spec or CATALOGUE[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        star = star_for(spark, sf_dir, chosen, projected, selection)
        return run_report(chosen, star, selection)

    registered(name, sql)(run)


def iso_dates(df: DataFrame) -> DataFrame:
    """Dates as ISO text and decimals as doubles, so that both engines show one value."""
    shown = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        col = F.col(f.name)
        if kind == "date":
            col = col.cast("string")
        elif kind == "decimal":
            col = col.cast("double")
        shown.append(col.alias(f.name))
    return df.select(*shown)


# --- SQL ---------------------------------------------------------------------

LINES_SQL = """
lines AS (
  SELECT l.l_linestatus AS chain,
    CASE WHEN l.l_linestatus = 'F' THEN 0 ELSE 1 END AS feed_rank,
    l.l_orderkey * 10 + l.l_linenumber AS row_ordinal,
    CAST(o.o_custkey AS VARCHAR) AS customer_id,
    CASE WHEN l.l_linestatus = 'F' AND l.l_orderkey % 50 = 0 THEN NULL
         ELSE l.l_orderkey END AS order_number,
    l.l_suppkey AS restaurant_id,
    n.n_name AS restaurant_city,
    n.n_name AS restaurant_state,
    CAST(n.n_nationkey + 10000 AS BIGINT) AS restaurant_zip_code,
    d.day AS order_purchase_date,
    CASE WHEN l.l_orderkey % 50 <> 1
         THEN printf('%02d:%02d', d.seconds // 3600, d.seconds % 3600 // 60) END
      AS order_purchase_time,
    CASE WHEN l.l_orderkey % 50 <> 1 AND d.seconds < 43200 THEN 'AM' ELSE 'PM' END
      AS time_of_day,
    CAST(month(d.day) AS INTEGER) AS order_month,
    strftime(d.day, '%B') AS order_month_name,
    CAST(year(d.day) AS INTEGER) AS order_year,
    CASE WHEN month(d.day) IN (12, 1, 2) THEN 'Winter'
         WHEN month(d.day) IN (3, 4, 5) THEN 'Spring'
         WHEN month(d.day) IN (6, 7, 8) THEN 'Summer'
         WHEN d.day IS NOT NULL THEN 'Fall' END AS season,
    o.o_orderpriority AS order_purchase_method,
    CASE WHEN l.l_discount > 0 THEN 'Yes' ELSE 'No' END AS coupon_used,
    CASE WHEN l.l_tax > 0 THEN 'Yes' ELSE 'No' END AS alcohol_purchased,
    c.c_mktsegment AS gender,
    CASE l.l_returnflag WHEN 'R' THEN 'Yes' WHEN 'N' THEN 'No' END AS has_children,
    l.l_partkey AS item_number,
    p.p_name AS item_description,
    p.p_brand AS item_code,
    CASE WHEN p.p_type = 'ECONOMY' THEN 'Economy'
         WHEN p.p_type = 'SMALL' THEN 'Small'
         WHEN p.p_type = 'LARGE' AND l.l_linestatus = 'F' THEN 'Large'
         WHEN p.p_type = 'PROMO' AND l.l_linestatus = 'O' THEN 'Promo'
         ELSE p.p_type END AS item_category,
    CAST(l.l_quantity AS BIGINT) AS quantity,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS menu_price,
    CAST(l.l_extendedprice AS DECIMAL(18,2)) AS item_total_cost,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))
      AS DECIMAL(18,4)) AS profit,
    CAST(o.o_totalprice AS DECIMAL(18,2)) AS order_total_cost
  FROM lineitem l
  JOIN (SELECT *, (o_orderkey * 7919) % 86400 AS seconds,
               CASE WHEN year(o_orderdate) <> 1995 AND o_orderkey % 97 <> 0
                    THEN CAST(o_orderdate AS DATE) END AS day
        FROM orders) d ON d.o_orderkey = l.l_orderkey
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN part p ON p.p_partkey = l.l_partkey
)"""

PLACES_SQL = """
places AS (
  SELECT restaurant_id, restaurant_city, restaurant_state,
         restaurant_zip_code AS restaurant_zip, chain
  FROM (SELECT *, row_number() OVER (
          PARTITION BY restaurant_id
          ORDER BY feed_rank, row_ordinal, restaurant_city, restaurant_state,
                   restaurant_zip_code, chain) AS place_rank
        FROM lines)
  WHERE place_rank = 1
)"""

_FACTOR = "CASE chain WHEN 'F' THEN CAST(1.08 AS DOUBLE) ELSE CAST(1.07 AS DOUBLE) END"


def _grown(column: str) -> str:
    return f"CAST(round_even(CAST({column} AS DOUBLE) * {_FACTOR}, 0) AS BIGINT)"


SCENARIO_SQL = f"""
grown AS (
  SELECT * REPLACE (
    CAST(order_purchase_date + INTERVAL 6 YEAR AS DATE) AS order_purchase_date,
    CAST(order_year + 6 AS INTEGER) AS order_year,
    {_grown("menu_price")} AS menu_price,
    {_grown("item_total_cost")} AS item_total_cost,
    {_grown("profit")} AS profit,
    {_grown("order_total_cost")} AS order_total_cost)
  FROM lines
),
scen AS (
  SELECT * REPLACE (
    CASE WHEN order_purchase_method = '5-LOW'
         THEN CAST(round_even(CAST(order_total_cost AS DOUBLE) * CAST(1.05 AS DOUBLE), 0) AS BIGINT)
         ELSE order_total_cost END AS order_total_cost)
  FROM grown
)"""

PICKED_SQL = """
picked AS (
  SELECT * FROM scen
  WHERE chain IN ('F', 'O')
    AND season IN ('Spring', 'Summer', 'Fall', 'Winter')
    AND gender IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
    AND order_purchase_method IN
      ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')
)"""

PRELUDE = f"WITH {LINES_SQL},{PLACES_SQL},{SCENARIO_SQL},{PICKED_SQL}\n"


# A whole order line as both engines show it: ISO dates, money as DOUBLE.
SHOWN_LINE = ", ".join(
    {
        "order_purchase_date": "strftime(order_purchase_date, '%Y-%m-%d') AS order_purchase_date",
        **{c: f"CAST({c} AS DOUBLE) AS {c}" for c in S.MONEY_COLUMNS},
    }.get(c, c)
    for c in S.LINE_COLUMNS
)


def total(column: str, power: int = 0, digits: int | None = 2) -> str:
    """Sum divided by ten to the power, rounded half up, as DOUBLE."""
    exact = f"CAST(SUM({column}) AS DECIMAL(28,4))"
    if power:
        exact = f"{exact} * {format(10 ** -power, f'.{power}f')}"
    return f"CAST(ROUND({exact}, {digits}) AS DOUBLE)"


def plain(column: str, divisor: int = 1) -> str:
    """Sum as DOUBLE, unrounded."""
    whole = f"CAST(SUM({column}) AS DOUBLE)"
    return whole if divisor == 1 else f"{whole} / {divisor}"


def mean(column: str, digits: int | None = 2) -> str:
    value = f"CAST(SUM({column}) AS DOUBLE) / COUNT({column})"
    return value if digits is None else f"ROUND({value}, {digits})"


def count_of(column: str) -> str:
    return f"COUNT(DISTINCT {column})"


UNITS = "CAST(SUM(quantity) AS BIGINT)"

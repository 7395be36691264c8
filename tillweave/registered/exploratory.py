"""Exploratory reports over the base dataset."""

from __future__ import annotations

from tillweave.plans import shaped
from tillweave.plans.catalogue import CATALOGUE
from tillweave.registered import base as R
from tillweave.registered.base import count_of, mean, registered, total

_REV, _PROFIT = "order_total_cost", "profit"
_SEGMENT = (
    f"{total(_REV, 3)} AS revenue_k, {mean(_REV)} AS avg_order, COUNT(*) AS orders"
)

R.register_report(
    "report_chain_comparison",
    f"""SELECT chain, {total(_REV, 6)} AS revenue_m, {total(_PROFIT, 6)} AS profit_m,
          {count_of("order_number")} AS total_orders
        FROM lines GROUP BY chain""",
)

_TREND_SQL = f"""SELECT chain, order_year, order_month, MIN(order_month_name) AS order_month_name,
          {total(_REV, 3)} AS revenue_k, {total(_PROFIT, 3)} AS profit_k,
          MIN(order_month_name) || ' ' || order_year AS period
        FROM lines WHERE order_purchase_date IS NOT NULL
        GROUP BY chain, order_year, order_month"""


def _trend_star(spark, sf_dir):
    return R.star_for(spark, sf_dir, CATALOGUE["report_monthly_trend"])


@registered("report_monthly_trend", _TREND_SQL)
def report_monthly_trend(spark, sf_dir):
    return shaped.monthly_trend(_trend_star(spark, sf_dir))


@registered(
    "report_monthly_spine",
    f"""SELECT c.chain, strftime(make_date(m.order_year, m.order_month, 1), '%Y-%m-%d')
            AS month_start, strftime(make_date(m.order_year, m.order_month, 1), '%B %Y') AS period,
          t.revenue_k, t.profit_k
        FROM (SELECT DISTINCT chain FROM lines WHERE order_purchase_date IS NOT NULL) c
        CROSS JOIN (SELECT DISTINCT order_year, order_month FROM lines
                    WHERE order_purchase_date IS NOT NULL) m
        LEFT JOIN ({_TREND_SQL}) t ON t.chain = c.chain
          AND t.order_year = m.order_year AND t.order_month = m.order_month""",
)
def report_monthly_spine(spark, sf_dir):
    return R.iso_dates(shaped.monthly_spine(_trend_star(spark, sf_dir)))


_SEASON_SQL = f"""SELECT chain, season, {total(_REV, 3)} AS revenue_k, {mean(_REV)} AS avg_order
        FROM lines WHERE season IS NOT NULL GROUP BY chain, season"""

R.register_report("report_season", _SEASON_SQL)


@registered(
    "report_season_reindexed",
    f"""SELECT c.chain, s.season, r.revenue_k, r.avg_order, CAST(s.season_rank AS INTEGER)
            AS season_rank
        FROM (SELECT DISTINCT chain FROM lines WHERE season IS NOT NULL) c
        CROSS JOIN (VALUES ('Spring', 1), ('Summer', 2), ('Fall', 3), ('Winter', 4))
          s(season, season_rank)
        LEFT JOIN ({_SEASON_SQL}) r ON r.chain = c.chain AND r.season = s.season""",
)
def report_season_reindexed(spark, sf_dir):
    return shaped.season_spine(R.star_for(spark, sf_dir, CATALOGUE["report_season"]))


R.register_report(
    "report_gender", f"SELECT chain, gender, {_SEGMENT} FROM lines GROUP BY chain, gender"
)
R.register_report(
    "report_top_states",
    f"""SELECT r.restaurant_state, {total("o.profit", 3)} AS profit_k,
          {total("o.order_total_cost", 3)} AS revenue_k
        FROM lines o JOIN places r ON o.restaurant_id = r.restaurant_id
        GROUP BY r.restaurant_state
        ORDER BY profit_k DESC, restaurant_state LIMIT 10""",
)

_PRODUCTS_SQL = f"""SELECT item_description, MIN(item_category) AS item_category,
          {R.UNITS} AS units_sold, {total(_PROFIT, 3)} AS profit_k
        FROM lines GROUP BY item_description"""

R.register_report("report_products", _PRODUCTS_SQL)
R.register_report(
    "report_products_top10",
    _PRODUCTS_SQL + " ORDER BY units_sold DESC, item_description LIMIT 10",
    spec=CATALOGUE["report_products"].with_limit(10),
)


@registered(
    "report_products_bottom10",
    _PRODUCTS_SQL + " ORDER BY units_sold, item_description DESC LIMIT 10",
)
def report_products_bottom10(spark, sf_dir):
    return shaped.bottom_products(R.star_for(spark, sf_dir, CATALOGUE["report_products"]))


R.register_report(
    "report_category",
    f"""SELECT item_category, {total(_PROFIT, 3)} AS profit_k, {mean(_PROFIT)} AS avg_profit,
          {R.UNITS} AS units_sold
        FROM lines GROUP BY item_category""",
)
R.register_report(
    "report_time_of_day",
    f"SELECT chain, time_of_day, {_SEGMENT} FROM lines GROUP BY chain, time_of_day",
)
R.register_report(
    "report_children",
    f"SELECT chain, has_children, {_SEGMENT} FROM lines GROUP BY chain, has_children",
)
R.register_report(
    "report_method",
    f"""SELECT chain, order_purchase_method, COUNT(*) AS orders, {total(_PROFIT, 3)} AS profit_k
        FROM lines GROUP BY chain, order_purchase_method""",
)


@registered(
    "report_method_share",
    """SELECT chain, order_purchase_method, orders,
          CAST(orders * 100 AS DOUBLE) / SUM(orders) OVER (PARTITION BY chain) AS share_pct
        FROM (SELECT chain, order_purchase_method, COUNT(*) AS orders
              FROM lines GROUP BY chain, order_purchase_method)""",
)
def report_method_share(spark, sf_dir):
    return shaped.method_share(R.star_for(spark, sf_dir, CATALOGUE["report_method"]))


def _extreme(fn: str, column: str) -> str:
    return f"CAST(ROUND({fn}({column}), 2) AS DOUBLE)"


R.register_report(
    "report_summary_stats",
    f"""SELECT chain, COUNT(*) AS total_rows,
          {mean(_REV)} AS mean_order_value, {_extreme("MIN", _REV)} AS min_order_value,
          {_extreme("MAX", _REV)} AS max_order_value,
          {mean(_PROFIT)} AS mean_profit, {_extreme("MIN", _PROFIT)} AS min_profit,
          {_extreme("MAX", _PROFIT)} AS max_profit,
          {mean("quantity")} AS mean_quantity, {mean("menu_price")} AS mean_menu_price,
          {count_of("order_number")} AS unique_orders,
          {count_of("customer_id")} AS unique_customers,
          {count_of("restaurant_id")} AS unique_restaurants
        FROM lines GROUP BY chain""",
)

"""Dashboard reports over the projected dataset, with all filters at their defaults."""

from __future__ import annotations

from tillweave.plans import shaped
from tillweave.plans.catalogue import CATALOGUE
from tillweave.registered import base as R
from tillweave.registered.base import count_of, plain, registered
from tillweave.sources.sample_tables import DEFAULT_SELECTION as PICK

_REV, _PROFIT = "order_total_cost", "profit"


def _even(sql: str, digits: int) -> str:
    factor = 10**digits
    return f"round_even(({sql}) * {factor}, 0) / {factor}"


def _raw_mean(column: str) -> str:
    return R.mean(column, None)


def _report(name: str, sql: str, **kw) -> None:
    R.register_report(name, sql, projected=True, selection=PICK, **kw)


def _star(spark, sf_dir, name, extra=()):
    return R.star_for(spark, sf_dir, CATALOGUE[name], True, PICK, extra)


_report(
    "dash_kpis",
    f"""SELECT {plain(_REV)} AS revenue, {plain(_PROFIT)} AS profit,
          {count_of("order_number")} AS orders, {count_of("restaurant_id")} AS restaurants,
          {_raw_mean(_REV)} AS avg_order
        FROM picked""",
)


def _millions_text(column: str) -> str:
    exact = f"CAST(SUM({column}) AS DECIMAL(28,0)) * 0.000001"
    return f"'$' || CAST(round_even({exact}, 1) AS VARCHAR) || 'M'"


@registered(
    "dash_kpi_cards",
    f"""SELECT {_millions_text(_REV)} AS total_revenue, {_millions_text(_PROFIT)} AS total_profit,
          format('{{:,}}', {count_of("order_number")}) AS unique_orders,
          format('{{:,}}', {count_of("restaurant_id")}) AS restaurants,
          '$' || format('{{:,}}', CAST(round_even({_raw_mean(_REV)}, 0) AS BIGINT))
            AS avg_order_value
        FROM picked""",
)
def dash_kpi_cards(spark, sf_dir):
    return shaped.kpi_cards(_star(spark, sf_dir, "dash_totals"), PICK)


_report(
    "dash_chain",
    f"""SELECT chain, {plain(_REV)} AS revenue, {plain(_PROFIT)} AS profit,
          {count_of("order_number")} AS orders
        FROM picked GROUP BY chain""",
)


@registered(
    "dash_monthly",
    f"""SELECT strftime(order_purchase_date, '%Y-%m') AS period, chain,
          {plain(_REV, 1000)} AS revenue_k
        FROM picked WHERE order_purchase_date IS NOT NULL
        GROUP BY strftime(order_purchase_date, '%Y-%m'), chain""",
)
def dash_monthly(spark, sf_dir):
    columns = {"chain", "order_purchase_date", _REV, *PICK}
    return shaped.dash_monthly(R.dataset(spark, sf_dir, columns, projected=True), PICK)


@registered(
    "dash_season",
    f"""SELECT season, {plain(_REV, 1_000_000)} AS revenue_m,
          CASE season WHEN 'Spring' THEN 1 WHEN 'Summer' THEN 2 WHEN 'Fall' THEN 3 ELSE 4 END
            AS season_rank
        FROM picked GROUP BY season""",
)
def dash_season(spark, sf_dir):
    return shaped.dash_season(_star(spark, sf_dir, "dash_season"), PICK)


@registered(
    "dash_method",
    """SELECT order_purchase_method, orders,
          CAST(orders * 100 AS DOUBLE) / SUM(orders) OVER () AS share_pct
        FROM (SELECT order_purchase_method, COUNT(*) AS orders FROM picked
              GROUP BY order_purchase_method)""",
)
def dash_method(spark, sf_dir):
    return shaped.dash_method(R.dataset(spark, sf_dir, set(PICK), projected=True), PICK)


_report(
    "dash_gender",
    f"SELECT gender, {plain(_REV, 1_000_000)} AS revenue_m FROM picked GROUP BY gender",
)
_report(
    "dash_category",
    f"""SELECT item_category, {plain(_PROFIT)} AS profit, {R.UNITS} AS units,
          {plain(_PROFIT, 1_000_000)} AS profit_m
        FROM picked GROUP BY item_category""",
)
_report(
    "dash_category_chain",
    f"""SELECT chain, item_category, {plain(_PROFIT, 1000)} AS profit_k
        FROM picked GROUP BY chain, item_category""",
)

_UNITS_SQL = f"""SELECT item_description, item_category, {R.UNITS} AS units
        FROM picked GROUP BY item_description, item_category"""

_report(
    "dash_top_products",
    _UNITS_SQL + " ORDER BY units DESC, item_description, item_category LIMIT 10",
)
_report(
    "dash_bottom_products",
    _UNITS_SQL + " ORDER BY units, item_description, item_category LIMIT 10",
)
_report(
    "dash_product_table",
    f"""SELECT item_description, item_category, chain, {R.UNITS} AS units_sold,
          {plain(_PROFIT)} AS total_profit, {_even(_raw_mean(_PROFIT), 2)} AS avg_profit,
          {_even(_raw_mean("menu_price"), 2)} AS menu_price
        FROM picked GROUP BY item_description, item_category, chain""",
)

_BY_STATE = "FROM picked o JOIN places r ON o.restaurant_id = r.restaurant_id"

_report(
    "dash_top_states",
    f"""SELECT r.restaurant_state, {plain("o.profit")} AS profit,
          {plain("o.order_total_cost")} AS revenue, {count_of("o.order_number")} AS orders,
          {plain("o.profit", 1_000_000)} AS profit_m,
          {plain("o.order_total_cost", 1_000_000)} AS revenue_m
        {_BY_STATE} GROUP BY r.restaurant_state
        ORDER BY profit DESC, restaurant_state LIMIT 10""",
)


@registered(
    "dash_state_table",
    f"""SELECT r.restaurant_state AS state, {_millions_text("o.order_total_cost")} AS revenue,
          {_millions_text("o.profit")} AS profit, {count_of("o.restaurant_id")} AS locations
        {_BY_STATE} GROUP BY r.restaurant_state""",
)
def dash_state_table(spark, sf_dir):
    return shaped.dash_state_table(_star(spark, sf_dir, "dash_states"), PICK)


def _one_chain(chain: str) -> str:
    return f"""SELECT r.restaurant_state, {plain("o.profit", 1000)} AS profit_k
        {_BY_STATE} WHERE o.chain = '{chain}' GROUP BY r.restaurant_state
        ORDER BY profit_k DESC, restaurant_state LIMIT 10"""


@registered("report_states_one_chain", _one_chain("F"))
def report_states_one_chain(spark, sf_dir):
    return shaped.states_for_chain(_star(spark, sf_dir, "states_by_chain"), "F", PICK)


@registered("report_states_other_chain", _one_chain("O"))
def report_states_other_chain(spark, sf_dir):
    return shaped.states_for_chain(_star(spark, sf_dir, "states_by_chain"), "O", PICK)


@registered(
    "report_states_per_chain",
    f"""SELECT chain, restaurant_state, profit_k, CAST(state_rank AS INTEGER) AS state_rank
        FROM (SELECT *, row_number() OVER (PARTITION BY chain
                ORDER BY profit_k DESC, restaurant_state) AS state_rank
              FROM (SELECT o.chain, r.restaurant_state, {plain("o.profit", 1000)} AS profit_k
                    {_BY_STATE} GROUP BY o.chain, r.restaurant_state))
        WHERE state_rank <= 10""",
)
def report_states_per_chain(spark, sf_dir):
    return shaped.states_per_chain(_star(spark, sf_dir, "states_by_chain"), PICK)

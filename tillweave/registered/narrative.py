"""Figures a written report quotes, over the projected dataset."""

from __future__ import annotations

from tillweave.plans import facts, shaped
from tillweave.plans.catalogue import CATALOGUE
from tillweave.registered import base as R
from tillweave.registered.base import count_of, mean, registered, total

_REV, _PROFIT = "order_total_cost", "profit"


def _report(name: str, sql: str) -> None:
    R.register_report(name, sql, projected=True)


_CHAIN_SQL = f"""SELECT chain, {total(_REV, 6)} AS revenue_m, {total(_PROFIT, 6)} AS profit_m,
          {count_of("order_number")} AS orders, {count_of("restaurant_id")} AS restaurants,
          {mean(_REV)} AS avg_order
        FROM scen GROUP BY chain"""
_report("fact_chain", _CHAIN_SQL)

_ITEMS_SQL = f"""SELECT item_description, MIN(item_category) AS item_category,
          {R.UNITS} AS units, {total(_PROFIT, 3)} AS profit_k
        FROM scen GROUP BY item_description"""
_report("fact_top5_items", _ITEMS_SQL + " ORDER BY units DESC, item_description LIMIT 5")
_report("fact_bottom5_items", _ITEMS_SQL + " ORDER BY units, item_description LIMIT 5")

_STATE_SQL = f"""SELECT r.restaurant_state, {total("o.profit", 6)} AS profit_m
        FROM scen o JOIN places r ON o.restaurant_id = r.restaurant_id
        GROUP BY r.restaurant_state"""
_report("fact_top5_states", _STATE_SQL + " ORDER BY profit_m DESC, restaurant_state LIMIT 5")

_SEASON_SQL = f"""SELECT season, {total(_REV, 6)} AS revenue_m
        FROM scen WHERE season IS NOT NULL GROUP BY season"""
_report("fact_season", _SEASON_SQL)

_GENDER_SQL = f"""SELECT gender, {mean(_REV)} AS avg_order, {total(_REV, 6)} AS revenue_m
        FROM scen GROUP BY gender"""
_report("fact_gender", _GENDER_SQL)

_CATEGORY_SQL = f"""SELECT item_category, {total(_PROFIT, 6)} AS profit_m,
          {mean(_PROFIT)} AS avg_profit
        FROM scen GROUP BY item_category"""
_report("fact_category", _CATEGORY_SQL)

_METHOD_SQL = f"""SELECT order_purchase_method, COUNT(*) AS orders, {total(_PROFIT, 6)} AS profit_m
        FROM scen GROUP BY order_purchase_method"""
_report("fact_method", _METHOD_SQL)

_report(
    "fact_summary",
    f"""SELECT chain, COUNT(*) AS total_rows, {mean(_REV)} AS mean_order,
          CAST(MIN({_REV}) AS DOUBLE) AS min_order, CAST(MAX({_REV}) AS DOUBLE) AS max_order,
          {mean(_PROFIT)} AS mean_profit, CAST(MAX({_PROFIT}) AS DOUBLE) AS max_profit
        FROM scen GROUP BY chain""",
)


def _ranked(section: str, source: str, label: str, order: str, measures: list[str], top: int,
            last: bool) -> str:
    """Picks of one section in long form."""
    inner = f"""(SELECT *, row_number() OVER (ORDER BY {order}, {label}) AS place,
                   COUNT(*) OVER () AS size FROM ({source}))"""
    rows = []
    for m in measures:
        cols = f"'{section}' AS section, {{pick}} AS pick, {label} AS label, '{m}' AS measure, " \
               f"CAST({m} AS DOUBLE) AS value FROM {inner}"
        rows.append("SELECT " + cols.format(pick="CAST(place AS VARCHAR)") + f" WHERE place <= {top}")
        if last:
            rows.append("SELECT " + cols.format(pick="'last'") + " WHERE place = size")
    return " UNION ALL ".join(rows)


@registered(
    "fact_sheet",
    " UNION ALL ".join(
        [
            _ranked("season", _SEASON_SQL, "season", "revenue_m DESC", ["revenue_m"], 3, True),
            _ranked("state", _STATE_SQL, "restaurant_state", "profit_m DESC", ["profit_m"], 5, False),
            _ranked("category", _CATEGORY_SQL, "item_category", "profit_m DESC", ["profit_m"], 3, True),
            _ranked("method", _METHOD_SQL, "order_purchase_method", "orders DESC",
                    ["orders", "profit_m"], 3, False),
            _ranked("chain", _CHAIN_SQL, "chain", "chain",
                    ["revenue_m", "profit_m", "avg_order", "restaurants"], 999, False),
            _ranked("gender", _GENDER_SQL, "gender", "gender", ["revenue_m", "avg_order"], 999, False),
        ]
    ),
)
def fact_sheet(spark, sf_dir):
    columns = ["season", "chain", "restaurant_id", "item_category", "order_purchase_method",
               "gender", "quantity", _REV, _PROFIT]
    return facts.fact_sheet(R.dataset(spark, sf_dir, columns, projected=True, located=True))


@registered(
    "fact_state_share",
    f"""SELECT CAST(row_number() OVER w AS INTEGER) AS state_rank, restaurant_state,
          CAST(p AS DOUBLE) / 1000000 AS profit_m,
          CAST(p AS DOUBLE) / CAST(SUM(p) OVER () AS DOUBLE) AS share,
          CAST(SUM(p) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
            / CAST(SUM(p) OVER () AS DOUBLE) AS cum_share
        FROM (SELECT r.restaurant_state, CAST(SUM(o.profit) AS DECIMAL(28,4)) AS p
              FROM scen o JOIN places r ON o.restaurant_id = r.restaurant_id
              GROUP BY r.restaurant_state)
        WINDOW w AS (ORDER BY p DESC, restaurant_state)""",
)
def fact_state_share(spark, sf_dir):
    return shaped.state_share(R.star_for(spark, sf_dir, CATALOGUE["dash_states"], True))

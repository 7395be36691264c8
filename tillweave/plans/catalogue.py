"""The report catalogue.

Three families share the runner but not the conventions:

* `eda` and `fact` reports keep null group keys and round half up;
* `dash` reports drop null group keys and round half to even;
* `qa` reports answer routed questions over the whole dataset.
"""

from __future__ import annotations

from tillweave.functions.numbers import HALF_EVEN
from tillweave.plans.report import AVG, COUNT, DISTINCT, MAX, MIN, SUM, Measure, ReportSpec

K, M = 1_000, 1_000_000

REVENUE, PROFIT = "order_total_cost", "profit"


def total(name: str, column: str, divisor: int = 1, digits: int | None = None, **kw) -> Measure:
    return Measure(name, SUM, column, divisor, digits, **kw)


def mean(name: str, column: str, digits: int | None = 2, **kw) -> Measure:
    return Measure(name, AVG, column, 1, digits, **kw)


def least(name: str, column: str) -> Measure:
    return Measure(name, MIN, column, 1, 2)


def greatest(name: str, column: str) -> Measure:
    return Measure(name, MAX, column, 1, 2)


def distinct(name: str, column: str) -> Measure:
    return Measure(name, DISTINCT, column)


rows = Measure("orders", COUNT)
revenue_k = total("revenue_k", REVENUE, K, 2)
revenue_m = total("revenue_m", REVENUE, M, 2)
profit_k = total("profit_k", PROFIT, K, 2)
profit_m = total("profit_m", PROFIT, M, 2)
avg_order = mean("avg_order", REVENUE)
avg_profit = mean("avg_profit", PROFIT)
units_sold = total("units_sold", "quantity")
orders_distinct = distinct("orders", "order_number")

_segment = (revenue_k, avg_order, rows)

CATALOGUE: dict[str, ReportSpec] = {
    # --- load verification -------------------------------------------------
    "verify_total_orders": ReportSpec((), (Measure("total_orders", COUNT),)),
    "verify_orders_by_chain": ReportSpec(
        ("chain",), (Measure("total_orders", COUNT),), order=("chain",)
    ),
    "verify_total_profit": ReportSpec((), (total("total_profit", PROFIT, 1, 2),)),
    # --- exploratory reports -------------------------------------------------
    "report_chain_comparison": ReportSpec(
        ("chain",), (revenue_m, profit_m, distinct("total_orders", "order_number"))
    ),
    "report_monthly_trend": ReportSpec(
        ("chain", "order_year", "order_month"),
        (revenue_k, profit_k),
        not_null=("order_purchase_date",),
        carry=(("order_month_name", "order_month_name"),),
        order=("order_year", "order_month", "chain"),
    ),
    "report_season": ReportSpec(
        ("chain", "season"), (revenue_k, avg_order), not_null=("season",)
    ),
    "report_gender": ReportSpec(("chain", "gender"), _segment),
    "report_top_states": ReportSpec(
        ("restaurant_state",), (profit_k, revenue_k), order=("-profit_k",), limit=10
    ),
    "report_products": ReportSpec(
        ("item_description",),
        (units_sold, profit_k),
        carry=(("item_category", "item_category"),),
        order=("-units_sold",),
    ),
    "report_category": ReportSpec(
        ("item_category",), (profit_k, avg_profit, units_sold), order=("-profit_k",)
    ),
    "report_time_of_day": ReportSpec(("chain", "time_of_day"), _segment),
    "report_children": ReportSpec(("chain", "has_children"), _segment),
    "report_method": ReportSpec(("chain", "order_purchase_method"), (rows, profit_k)),
    "report_summary_stats": ReportSpec(
        ("chain",),
        (
            Measure("total_rows", COUNT),
            mean("mean_order_value", REVENUE),
            least("min_order_value", REVENUE),
            greatest("max_order_value", REVENUE),
            mean("mean_profit", PROFIT),
            least("min_profit", PROFIT),
            greatest("max_profit", PROFIT),
            mean("mean_quantity", "quantity"),
            mean("mean_menu_price", "menu_price"),
            distinct("unique_orders", "order_number"),
            distinct("unique_customers", "customer_id"),
            distinct("unique_restaurants", "restaurant_id"),
        ),
    ),
    # --- dashboard reports ---------------------------------------------------
    "dash_kpis": ReportSpec(
        (),
        (
            total("revenue", REVENUE),
            total("profit", PROFIT),
            orders_distinct,
            distinct("restaurants", "restaurant_id"),
            mean("avg_order", REVENUE, None),
        ),
    ),
    "dash_totals": ReportSpec(
        (),
        (
            total("revenue", REVENUE, exact=True),
            total("profit", PROFIT, exact=True),
            orders_distinct,
            distinct("restaurants", "restaurant_id"),
            mean("avg_order", REVENUE, None),
        ),
    ),
    "dash_chain": ReportSpec(
        ("chain",),
        (
            total("revenue", REVENUE, 1, 0, mode=HALF_EVEN),
            total("profit", PROFIT, 1, 0, mode=HALF_EVEN),
            orders_distinct,
        ),
        keep_null_keys=False,
    ),
    "dash_gender": ReportSpec(
        ("gender",), (total("revenue_m", REVENUE, M),), keep_null_keys=False
    ),
    "dash_season": ReportSpec(
        ("season",), (total("revenue_m", REVENUE, M),), keep_null_keys=False
    ),
    "dash_category": ReportSpec(
        ("item_category",),
        (
            total("profit", PROFIT),
            total("units", "quantity"),
            total("profit_m", PROFIT, M),
        ),
        order=("-profit",),
        keep_null_keys=False,
    ),
    "dash_category_chain": ReportSpec(
        ("chain", "item_category"), (total("profit_k", PROFIT, K),), keep_null_keys=False
    ),
    "dash_top_products": ReportSpec(
        ("item_description", "item_category"),
        (total("units", "quantity"),),
        order=("-units",),
        limit=10,
        keep_null_keys=False,
    ),
    "dash_bottom_products": ReportSpec(
        ("item_description", "item_category"),
        (total("units", "quantity"),),
        order=("units",),
        limit=10,
        keep_null_keys=False,
    ),
    "dash_product_table": ReportSpec(
        ("item_description", "item_category", "chain"),
        (
            units_sold,
            total("total_profit", PROFIT, 1, 0, mode=HALF_EVEN),
            mean("avg_profit", PROFIT, 2, mode=HALF_EVEN),
            mean("menu_price", "menu_price", 2, mode=HALF_EVEN),
        ),
        order=("-total_profit",),
        keep_null_keys=False,
    ),
    "dash_top_states": ReportSpec(
        ("restaurant_state",),
        (
            total("profit", PROFIT),
            total("revenue", REVENUE),
            orders_distinct,
            total("profit_m", PROFIT, M),
            total("revenue_m", REVENUE, M),
        ),
        order=("-profit",),
        limit=10,
        keep_null_keys=False,
    ),
    "dash_states": ReportSpec(
        ("restaurant_state",),
        (
            total("revenue", REVENUE, exact=True),
            total("profit", PROFIT, exact=True),
            distinct("locations", "restaurant_id"),
        ),
        order=("-profit",),
        keep_null_keys=False,
    ),
    "states_by_chain": ReportSpec(
        ("chain", "restaurant_state"),
        (total("profit_k", PROFIT, K),),
        order=("-profit_k",),
        keep_null_keys=False,
    ),
    # --- narrative facts -----------------------------------------------------
    "fact_chain": ReportSpec(
        ("chain",),
        (
            revenue_m,
            profit_m,
            orders_distinct,
            distinct("restaurants", "restaurant_id"),
            avg_order,
        ),
    ),
    "fact_top5_items": ReportSpec(
        ("item_description",),
        (total("units", "quantity"), profit_k),
        carry=(("item_category", "item_category"),),
        order=("-units",),
        limit=5,
    ),
    "fact_bottom5_items": ReportSpec(
        ("item_description",),
        (total("units", "quantity"), profit_k),
        carry=(("item_category", "item_category"),),
        order=("units",),
        limit=5,
    ),
    "fact_top5_states": ReportSpec(
        ("restaurant_state",), (profit_m,), order=("-profit_m",), limit=5
    ),
    "fact_season": ReportSpec(
        ("season",), (revenue_m,), not_null=("season",), order=("-revenue_m",)
    ),
    "fact_gender": ReportSpec(("gender",), (avg_order, revenue_m)),
    "fact_category": ReportSpec(
        ("item_category",), (profit_m, avg_profit), order=("-profit_m",)
    ),
    "fact_method": ReportSpec(
        ("order_purchase_method",), (rows, profit_m), order=("-orders",)
    ),
    "fact_summary": ReportSpec(
        ("chain",),
        (
            Measure("total_rows", COUNT),
            mean("mean_order", REVENUE),
            least("min_order", REVENUE),
            greatest("max_order", REVENUE),
            mean("mean_profit", PROFIT),
            greatest("max_profit", PROFIT),
        ),
    ),
    # --- answers to routed questions ----------------------------------------
    "qa_state": ReportSpec(
        ("restaurant_state",),
        (
            total("profit_k", PROFIT, K, 1),
            total("revenue_k", REVENUE, K, 1),
            orders_distinct,
        ),
        order=("-profit_k",),
        limit=10,
    ),
    "qa_item": ReportSpec(
        ("item_description", "chain"),
        (units_sold, total("profit_k", PROFIT, K, 1)),
        carry=(("item_category", "item_category"),),
        order=("-units_sold",),
        limit=10,
    ),
    "qa_season": ReportSpec(
        ("season", "chain"), (revenue_m, profit_m), not_null=("season",), order=("-revenue_m",)
    ),
    "qa_category": ReportSpec(
        ("item_category",), (profit_m, avg_profit, units_sold), order=("-profit_m",)
    ),
    "qa_gender": ReportSpec(("gender", "chain"), (revenue_m, avg_order, rows)),
    "qa_default": ReportSpec(("chain",), (revenue_m, profit_m, orders_distinct, avg_order)),
}

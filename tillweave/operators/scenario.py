"""What-if projection of order lines: later dates, grown prices, new customers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.functions import cleaning as C
from tillweave.functions import numbers as N
from tillweave.operators.cleaning import add_calendar
from tillweave.operators.positions import number_rows


@dataclass(frozen=True)
class ScenarioParams:
    """Years to shift by, growth per chain, and one purchase method's extra uplift."""

    years: int = 6
    growth: Mapping[str, float] = field(default_factory=dict)
    default_growth: float = 0.08
    uplift_method: str | None = None
    uplift: float = 1.05
    id_prefix: Mapping[str, str] = field(default_factory=dict)
    id_digits: int = 6


def _by_chain(values: Mapping[str, object], otherwise: object) -> Column:
    choice = F.lit(otherwise)
    for chain, value in values.items():
        choice = F.when(F.col("chain") == chain, F.lit(value)).otherwise(choice)
    return choice


def shift_dates(lines: DataFrame, params: ScenarioParams) -> DataFrame:
    """Move the dates and recompute the calendar columns; the season stays."""
    date = C.shift_years(F.col("order_purchase_date"), params.years)
    shifted = lines.withColumn("order_purchase_date", date)
    calendar = {"order_month", "order_month_name", "order_year"} & set(lines.columns)
    if not calendar:
        return shifted
    return add_calendar(shifted).select(*lines.columns)


def grow_money(lines: DataFrame, params: ScenarioParams) -> DataFrame:
    """Scale the money columns and round half to even to whole units."""
    factors = {chain: 1 + rate for chain, rate in params.growth.items()}
    factor = _by_chain(factors, 1 + params.default_growth)
    present = [c for c in S.MONEY_COLUMNS if c in lines.columns]
    return lines.withColumns(
        {c: N.half_even_long(F.col(c).cast("double") * factor) for c in present}
    )


def uplift_method(lines: DataFrame, params: ScenarioParams) -> DataFrame:
    """Raise the already rounded order total of one purchase method and round again."""
    if params.uplift_method is None:
        return lines
    raised = N.half_even_long(F.col("order_total_cost").cast("double") * F.lit(params.uplift))
    chosen = F.col("order_purchase_method") == params.uplift_method
    return lines.withColumn(
        "order_total_cost", F.when(chosen, raised).otherwise(F.col("order_total_cost"))
    )


def project_values(lines: DataFrame, params: ScenarioParams) -> DataFrame:
    """The projection without new customer ids: one projection, no shuffle.

    Steps whose columns a caller has not selected are left out.
    """
    have = set(lines.columns)
    if "order_purchase_date" in have:
        lines = shift_dates(lines, params)
    if have & set(S.MONEY_COLUMNS):
        lines = grow_money(lines, params)
    if {"order_total_cost", "order_purchase_method"} <= have:
        lines = uplift_method(lines, params)
    return lines


def new_customer_ids(
    lines: DataFrame, params: ScenarioParams, order: list[str], unique: bool = False
) -> DataFrame:
    """Number the customers afresh, one per line, counting from zero in each chain.

    `unique` says that `order` tells all lines of a chain apart, see `number_rows`.
    Lines are then computed more than once.
    The old ids are left out before the lines are sorted, unless they order them.
    """
    moved = lines if "customer_id" in order else lines.drop("customer_id")
    numbered = number_rows(moved, order, "_position", group=["chain"], unique=unique, again=True)
    prefix = F.coalesce(_by_chain(params.id_prefix, None).cast("string"), F.col("chain"))
    # Formatting pads short numbers and never cuts long ones.
    label = F.concat(prefix, F.format_string(f"%0{params.id_digits}d", F.col("_position")))
    return numbered.withColumn("customer_id", label).drop("_position").select(*lines.columns)


def project(
    lines: DataFrame, params: ScenarioParams, order: list[str], unique: bool = False
) -> DataFrame:
    """The full what-if dataset, same shape as its input.

    Calendar columns follow from the date, so they are made behind the sort
    that numbers the customers and not moved through it.
    """
    calendar = [
        c for c in ("order_month", "order_month_name", "order_year")
        if c in lines.columns and "order_purchase_date" in lines.columns and c not in order
    ]
    renumbered = new_customer_ids(
        project_values(lines.drop(*calendar), params), params, order, unique
    )
    if calendar:
        renumbered = add_calendar(renumbered)
    return renumbered.select(*lines.columns)


def verify(orders: DataFrame) -> DataFrame:
    """Rows, date range and totals in millions of each chain."""

    def millions(column: str) -> Column:
        dtype = orders.schema[column].dataType
        total = N.exact_sum(F.col(column), dtype)
        scaled = N.scaled_total(total, N.money_scale(dtype), 1_000_000)
        return F.round(scaled, 2).cast("double")

    return orders.groupBy("chain").agg(
        F.count("*").alias("rows"),
        F.min("order_purchase_date").cast("string").alias("start_date"),
        F.max("order_purchase_date").cast("string").alias("end_date"),
        millions("order_total_cost").alias("revenue_m"),
        millions("profit").alias("profit_m"),
    )


def totals(orders: DataFrame) -> DataFrame:
    """Revenue and profit in millions per chain and, flagged, over all, in one pass."""
    money = {
        c: N.exact_sum(F.col(c), orders.schema[c].dataType).cast("double") / 1_000_000
        for c in ("order_total_cost", "profit")
    }
    summed = orders.groupingSets([[F.col("chain")], []], "chain").agg(
        F.grouping("chain").alias("_all"),
        money["order_total_cost"].alias("revenue_m"),
        money["profit"].alias("profit_m"),
    )
    return summed.select(
        "chain", F.col("_all").cast("int").alias("is_total"), "revenue_m", "profit_m"
    )

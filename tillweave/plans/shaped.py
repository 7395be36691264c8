"""Reports that shape an aggregate further: spines, shares, text and per-group ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillweave.functions import numbers as N
from tillweave.functions.cleaning import SEASONS
from tillweave.operators.filters import keep_known, keep_selected
from tillweave.operators.star import Star
from tillweave.plans.catalogue import CATALOGUE, K, M
from tillweave.plans.report import run_report

Selection = Mapping[str, Sequence]


def monthly_trend(star: Star) -> DataFrame:
    """Monthly revenue and profit per chain with a period label."""
    period = F.concat_ws(" ", "order_month_name", F.col("order_year").cast("string"))
    return run_report(CATALOGUE["report_monthly_trend"], star).withColumn("period", period)


def distinct_periods(star: Star) -> DataFrame:
    """Every (year, month) that occurs, in order, with its label."""
    dated = keep_known(star.orders, ["order_purchase_date"])
    periods = dated.select("order_year", "order_month", "order_month_name").distinct()
    label = F.concat_ws(" ", "order_month_name", F.col("order_year").cast("string"))
    return periods.select("order_year", "order_month", label.alias("period")).orderBy(
        "order_year", "order_month"
    )


def monthly_spine(star: Star) -> DataFrame:
    """The trend on a shared axis: every chain gets every period, missing ones null.

    Gaps are filled by stretching each chain's rows over the months up to its
    next one, so the order lines are read once and nothing is joined.
    """
    trend = monthly_trend(star).select(
        "chain",
        F.make_date("order_year", "order_month", F.lit(1)).alias("month_start"),
        "revenue_k",
        "profit_k",
    )
    every = Window.partitionBy(F.lit(1))
    within = Window.partitionBy("chain").orderBy("month_start")
    first = F.lag("month_start").over(within).isNull()
    stretched = trend.select(
        "*",
        F.when(first, F.min("month_start").over(every)).otherwise(F.col("month_start")).alias("_lo"),
        F.coalesce(
            F.add_months(F.lead("month_start").over(within), -1), F.max("month_start").over(every)
        ).alias("_hi"),
    )
    months = F.explode(F.sequence("_lo", "_hi", F.make_interval(months=F.lit(1))))
    filled = stretched.withColumn("_month", months).select(
        "chain",
        F.col("_month").alias("month_start"),
        *[
            F.when(F.col("_month") == F.col("month_start"), F.col(c)).alias(c)
            for c in ("revenue_k", "profit_k")
        ],
        (F.col("_month") == F.col("month_start")).alias("_seen"),
    )
    anywhere = F.max("_seen").over(Window.partitionBy("month_start"))
    return (
        filled.withColumn("_anywhere", anywhere)
        .where("_anywhere")
        .drop("_seen", "_anywhere")
        .withColumn("period", F.date_format("month_start", "MMMM yyyy"))
    )


def season_spine(star: Star) -> DataFrame:
    """Season report in fixed season order; a chain without a season shows null.

    The few seasons of a chain travel as one map, looked up for each season of
    the fixed list, so the order lines are read once.
    """
    report = run_report(CATALOGUE["report_season"], star)
    figures = F.struct("revenue_k", "avg_order")
    found = F.map_from_entries(F.collect_list(F.struct("season", figures)))
    per_chain = report.groupBy("chain").agg(found.alias("_found"))
    seasons = F.posexplode(F.array(*[F.lit(s) for s in SEASONS])).alias("_pos", "season")
    listed = per_chain.select("chain", "_found", seasons).withColumn(
        "_figures", F.try_element_at("_found", F.col("season"))
    )
    return listed.select(
        "chain",
        "season",
        "_figures.revenue_k",
        "_figures.avg_order",
        (F.col("_pos") + 1).cast("int").alias("season_rank"),
    ).orderBy("chain", "season_rank")


def bottom_products(star: Star, n: int = 10) -> DataFrame:
    """The last `n` of the best-seller list, kept in best-seller order."""
    spec = CATALOGUE["report_products"]
    listed = run_report(spec, star)
    tail = listed.orderBy(F.asc("units_sold"), F.desc("item_description")).limit(n)
    return tail.orderBy(F.desc("units_sold"), F.asc("item_description"))


def method_share(star: Star) -> DataFrame:
    """Order lines per purchase method and their percentage within the chain."""
    counts = run_report(CATALOGUE["report_method"], star)
    whole = F.sum("orders").over(Window.partitionBy("chain"))
    return counts.select(
        "chain",
        "order_purchase_method",
        "orders",
        (F.col("orders") * 100 / whole).alias("share_pct"),
    )


def kpi_cards(star: Star, selection: Selection) -> DataFrame:
    """The dashboard's headline figures as text."""
    report = run_report(CATALOGUE["dash_totals"], star, selection)
    return report.select(
        N.millions_text(F.col("revenue")).alias("total_revenue"),
        N.millions_text(F.col("profit")).alias("total_profit"),
        F.format_number("orders", 0).alias("unique_orders"),
        F.format_number("restaurants", 0).alias("restaurants"),
        F.concat(F.lit("$"), F.format_number(F.rint("avg_order"), 0)).alias("avg_order_value"),
    )


def with_headings(report: DataFrame) -> DataFrame:
    """Column names as table headings."""
    return report.toDF(*[N.heading(c) for c in report.columns])


def dash_monthly(star: Star, selection: Selection) -> DataFrame:
    """Revenue in thousands per calendar month and chain."""
    lines = keep_selected(star.orders, selection)
    lines = keep_known(lines, ["order_purchase_date", "chain"])
    dtype = lines.schema["order_total_cost"].dataType
    revenue = N.exact_sum(F.col("order_total_cost"), dtype).cast("double") / K
    # Grouping by the month's first day keeps text formatting off the row path.
    monthly = lines.groupBy(
        F.trunc("order_purchase_date", "MM").alias("_month"), "chain"
    ).agg(revenue.alias("revenue_k"))
    return monthly.select(
        F.date_format("_month", "yyyy-MM").alias("period"), "chain", "revenue_k"
    ).orderBy("period", "chain")


def dash_season(star: Star, selection: Selection) -> DataFrame:
    """Revenue per season in calendar order rather than alphabetical order."""
    order = F.array_position(F.array(*[F.lit(s) for s in SEASONS]), F.col("season"))
    report = run_report(CATALOGUE["dash_season"], star, selection)
    return report.withColumn("season_rank", order.cast("int")).orderBy("season_rank")


def dash_method(star: Star, selection: Selection) -> DataFrame:
    """Order lines per purchase method and their percentage of all."""
    lines = keep_known(keep_selected(star.orders, selection), ["order_purchase_method"])
    counts = lines.groupBy("order_purchase_method").agg(F.count("*").alias("orders"))
    whole = F.sum("orders").over(Window.partitionBy(F.lit(1)))
    return counts.select(
        "order_purchase_method", "orders", (F.col("orders") * 100 / whole).alias("share_pct")
    )


def dash_state_table(star: Star, selection: Selection) -> DataFrame:
    """All states with revenue and profit as text, most profitable first."""
    report = run_report(CATALOGUE["dash_states"], star, selection)
    return report.select(
        F.col("restaurant_state").alias("state"),
        N.millions_text(F.col("revenue")).alias("revenue"),
        N.millions_text(F.col("profit")).alias("profit"),
        "locations",
    )


def states_for_chain(star: Star, chain: str, selection: Selection, n: int = 10) -> DataFrame:
    """The most profitable states of one chain."""
    spec = replace(CATALOGUE["states_by_chain"], only=(("chain", chain),), limit=n)
    return run_report(spec, star, selection).drop("chain")


def states_per_chain(star: Star, selection: Selection, n: int = 10) -> DataFrame:
    """The most profitable states of every chain, in one pass."""
    report = run_report(CATALOGUE["states_by_chain"], star, selection)
    rank = F.row_number().over(
        Window.partitionBy("chain").orderBy(F.desc("profit_k"), "restaurant_state")
    )
    return report.withColumn("state_rank", rank).where(F.col("state_rank") <= n)


def state_share(star: Star) -> DataFrame:
    """States by profit with their share of the total and the running share."""
    by_state = run_report(CATALOGUE["dash_states"], star)
    # One row per state: the frames below run over the aggregated report only.
    everything = Window.partitionBy(F.lit(1))
    ranked = everything.orderBy(F.desc("profit"), "restaurant_state")
    running = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = F.sum("profit").over(everything).cast("double")
    return by_state.select(
        F.row_number().over(ranked).alias("state_rank"),
        "restaurant_state",
        (F.col("profit").cast("double") / M).alias("profit_m"),
        (F.col("profit").cast("double") / whole).alias("share"),
        (F.sum("profit").over(running).cast("double") / whole).alias("cum_share"),
    )

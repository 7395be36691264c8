"""Several reports from one pass over the order lines.

The narrative needs the leaders of six reports and the question page the top
row of six more.  Running them separately would scan the fact once each.
`grouped_once` aggregates the lines by several key sets in a single scan and
gives one small ledger that the reports are read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.functions import numbers as N
from tillweave.operators.star import Star
from tillweave.plans.catalogue import CATALOGUE

_MILLION, _THOUSAND = 1_000_000, 1_000


def grouped_once(lines: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Revenue, profit, units and rows for each key set, tagged with the set's number.

    Grouping sets replicate a row once per set before the partial aggregation,
    so the exchange carries aggregated rows only.  Columns absent from a set are
    null in its rows.
    """
    keys = list(dict.fromkeys(k for keys in key_sets for k in keys))
    money = {c: N.exact_sum(F.col(c), lines.schema[c].dataType) for c in ("order_total_cost", "profit")}
    grouped = lines.groupingSets([[F.col(k) for k in ks] for ks in key_sets], *keys).agg(
        F.grouping_id().alias("_gid"),
        money["order_total_cost"].alias("revenue"),
        money["profit"].alias("profit"),
        F.sum("quantity").alias("units"),
        F.count("*").alias("rows"),
        F.count("order_total_cost").alias("priced"),
    )
    tag = F.lit(None).cast("int")
    for i, ks in enumerate(key_sets):
        gid = sum(0 if k in ks else 1 << (len(keys) - 1 - j) for j, k in enumerate(keys))
        tag = F.when(F.col("_gid") == gid, F.lit(i)).otherwise(tag)
    return grouped.withColumn("key_set", tag).drop("_gid")


def _located(ledger: DataFrame, star: Star, key_set: int) -> DataFrame:
    """The ledger with the state of its restaurants; `key_set` is the one grouped by them.

    As in the reports by state, lines of an unknown restaurant drop out and a
    known restaurant without a state stays, under a null.
    """
    places = star.restaurants.select(
        "restaurant_id", F.col("restaurant_state").alias("_state"), F.lit(True).alias("_placed")
    )
    joined = ledger.join(places, "restaurant_id", "left")
    return joined.where((F.col("key_set") != key_set) | F.col("_placed")).drop("_placed")


def _millions(col: str, dtype_scale: int) -> Column:
    return F.round(N.scaled_total(F.col(col), dtype_scale, _MILLION), 2).cast("double")


def fact_sheet(star: Star) -> DataFrame:
    """The ranked picks a written report quotes, as (section, pick, label, measure, value).

    Seasons and categories give ranks 1, 2, 3 and the last; states ranks 1-5;
    purchase methods ranks 1-3; chains and genders are listed in full.
    """
    sets = [["season"], ["chain", "restaurant_id"], ["item_category"], ["order_purchase_method"], ["gender"]]
    fine = grouped_once(star.orders, sets)
    located = _located(fine, star, 1)

    def section(name: str, label: str) -> Column:
        return F.struct(F.lit(name).alias("section"), F.col(label).alias("label"))

    # A (chain, restaurant) row counts towards its state and towards its chain.
    home = {0: ["season"], 1: ["state", "chain"], 2: ["category"], 3: ["method"], 4: ["gender"]}
    label = {"season": "season", "state": "_state", "category": "item_category",
             "method": "order_purchase_method", "chain": "chain", "gender": "gender"}
    sections = F.array().cast("array<struct<section:string,label:string>>")
    for key_set, names in home.items():
        entry = F.array(*[section(n, label[n]) for n in names])
        sections = F.when(F.col("key_set") == key_set, entry).otherwise(sections)
    scale = N.money_scale(star.orders.schema["order_total_cost"].dataType)
    profit_scale = N.money_scale(star.orders.schema["profit"].dataType)
    ledger = (
        located.withColumn("_s", F.explode(sections))
        .groupBy("_s.section", "_s.label")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("profit").alias("profit"),
            F.sum("rows").alias("rows"),
            F.sum("priced").alias("priced"),
            F.count_distinct("restaurant_id").alias("sites"),
        )
        .where(F.col("label").isNotNull() | (F.col("section") != "season"))
    )
    values = ledger.select(
        "section",
        "label",
        _millions("revenue", scale).alias("revenue_m"),
        _millions("profit", profit_scale).alias("profit_m"),
        F.round(F.col("revenue").cast("double") / F.col("priced"), 2).alias("avg_order"),
        F.col("rows").cast("double").alias("orders"),
        F.col("sites").cast("double").alias("restaurants"),
    )
    lead = (
        F.when(F.col("section") == "season", F.col("revenue_m"))
        .when(F.col("section").isin("state", "category"), F.col("profit_m"))
        .when(F.col("section") == "method", F.col("orders"))
    )
    per_section = Window.partitionBy("section")
    ranked = values.select(
        "*",
        F.row_number().over(per_section.orderBy(lead.desc(), "label")).alias("_rank"),
        F.count("*").over(per_section).alias("_size"),
    )
    depth = (
        F.when(F.col("section").isin("season", "category", "method"), 3)
        .when(F.col("section") == "state", 5)
        .otherwise(F.col("_size"))
    )
    rank, last = F.col("_rank"), F.col("_rank") == F.col("_size")
    has_last = F.col("section").isin("season", "category")
    picks = F.array_compact(
        F.array(
            F.when(rank <= depth, rank.cast("string")),
            F.when(has_last & last, F.lit("last")),
        )
    )
    # Which figures each section quotes.
    quoted = {
        "season": ["revenue_m"],
        "state": ["profit_m"],
        "category": ["profit_m"],
        "method": ["orders", "profit_m"],
        "chain": ["revenue_m", "profit_m", "avg_order", "restaurants"],
        "gender": ["revenue_m", "avg_order"],
    }
    figures = F.array().cast("array<struct<measure:string,value:double>>")
    for name, columns in quoted.items():
        entry = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("value")) for c in columns])
        figures = F.when(F.col("section") == name, entry).otherwise(figures)
    return (
        ranked.select("section", "label", F.explode(picks).alias("pick"), figures.alias("_f"))
        .select("section", "pick", "label", F.explode("_f").alias("_m"))
        .select("section", "pick", "label", "_m.measure", "_m.value")
    )


def top_answers(star: Star) -> DataFrame:
    """First row of each question report, and how much it was picked from.

    (intent, top_label, detail_name, detail_value, shown_rows, total_rows): the
    rows that the intent's report shows, and the order lines of the dataset.
    """
    sets = [["restaurant_id"], ["item_description", "chain", "item_category"], ["season", "chain"],
            ["item_category"], ["gender", "chain"], ["chain"]]
    fine = grouped_once(star.orders, sets)
    located = _located(fine, star, 0)
    # The intents in the order of the key sets above.
    intents = ["state", "item", "season", "category", "gender", "default"]
    intent = F.element_at(F.array(*[F.lit(i) for i in intents]), F.col("key_set") + 1)
    is_ = {name: F.col("intent") == name for name in intents}
    label = (
        F.when(is_["state"], F.col("_state"))
        .when(is_["item"], F.col("item_description"))
        .when(is_["season"], F.col("season"))
        .when(is_["category"], F.col("item_category"))
        .when(is_["gender"], F.col("gender"))
        .otherwise(F.col("chain"))
    )
    chain = F.when(F.col("intent").isin("item", "season", "gender"), F.col("chain"))
    keyed = located.withColumn("intent", intent).select(
        "intent", label.alias("label"), chain.alias("chain"),
        F.when(is_["item"], F.col("item_category")).alias("category"),
        "revenue", "profit", "units", "rows",
    ).where((F.col("intent") != "season") | F.col("label").isNotNull())
    whole = keyed.groupBy("intent", "label", "chain").agg(
        F.min("category").alias("category"),
        F.sum("revenue").alias("revenue"),
        F.sum("profit").alias("profit"),
        F.sum("units").alias("units"),
        F.sum("rows").alias("rows"),
    )
    scale = N.money_scale(star.orders.schema["order_total_cost"].dataType)
    profit_scale = N.money_scale(star.orders.schema["profit"].dataType)

    def text(col: str, s: int, divisor: int, digits: int) -> Column:
        rounded = F.round(N.scaled_total(F.col(col), s, divisor), digits)
        return rounded.cast(f"decimal(28,{digits})")

    profit_k = text("profit", profit_scale, _THOUSAND, 1)
    revenue_m, profit_m = text("revenue", scale, _MILLION, 2), text("profit", profit_scale, _MILLION, 2)
    lead = (
        F.when(is_["state"], profit_k.cast("double"))
        .when(is_["item"], F.col("units").cast("double"))
        .when(is_["season"], revenue_m.cast("double"))
        .when(is_["category"], profit_m.cast("double"))
    )
    first = F.row_number().over(
        Window.partitionBy("intent").orderBy(lead.desc_nulls_last(), "label", "chain")
    )
    detail = (
        F.when(is_["state"], profit_k.cast("string"))
        .when(is_["item"], F.col("category"))
        .when(is_["category"], profit_m.cast("string"))
        .when(is_["default"], revenue_m.cast("string"))
        .otherwise(F.col("chain"))
    )
    # The heading of the second column of each answer.
    headings = F.create_map(
        *[F.lit(x) for x in (
            "state", "Profit K", "item", "Category", "season", "Chain",
            "category", "Profit M", "gender", "Chain", "default", "Revenue M",
        )]
    )
    of_intent = Window.partitionBy("intent")
    limits = F.create_map(
        *[F.lit(x) for i in intents if (n := CATALOGUE[f"qa_{i}"].limit) for x in (i, n)]
    )
    groups = F.count("*").over(of_intent)
    firsts = whole.select(
        "*",
        first.alias("_first"),
        F.least(groups, F.try_element_at(limits, F.col("intent"))).alias("shown_rows"),
        F.sum("rows").over(of_intent).alias("_lines"),
    ).where(F.col("_first") == 1)
    # One row per intent is left; those that drop no key have seen every line.
    return firsts.select(
        "intent",
        F.col("label").alias("top_label"),
        F.element_at(headings, F.col("intent")).alias("detail_name"),
        detail.alias("detail_value"),
        "shown_rows",
        F.max("_lines").over(Window.partitionBy(F.lit(0))).alias("total_rows"),
    )

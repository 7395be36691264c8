"""Distinct sets against plain distinct counts, and cubes against the lines they sum."""

from __future__ import annotations

import random
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillweave.operators.cube import write_cube
from tillweave.operators import distinct_sets as distinct_sets_module
from tillweave.operators.distinct_sets import FEW, count_members, distinct_sets
from tillweave.operators.star import Star
from tillweave.plans.catalogue import CATALOGUE
from tillweave.plans.report import _answering, run_report
from tillweave.session import scratch_path


@pytest.fixture(scope="module")
def members(spark):
    """A key with half of the rows, many small ones, null keys and null values."""
    path = scratch_path(spark, "members")
    spark.range(150_000).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(40)))).alias("a"),
        F.when(F.col("id") % 3 < 2, F.col("id") % 3).alias("b"),
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7 % 90_000).cast("string")).alias("v"),
    ).write.parquet(path)
    rows = spark.read.parquet(path)
    sets_path = scratch_path(spark, "sets")
    distinct_sets(rows, ["a", "b"], "v").write.parquet(sets_path)
    return rows, spark.read.parquet(sets_path)


def test_sets_are_lists_or_bitmaps(members):
    rows, sets = members
    both = sets.groupBy(F.col("bits").isNull().alias("listed")).agg(
        F.count("*").alias("n"), F.max(F.size("places")).alias("most")
    )
    found = {r.listed: r for r in both.collect()}
    assert found[True].most <= FEW and found[False].n > 0
    held = sets.select(F.coalesce(F.size("places"), F.lit(0)).alias("few"), F.bitmap_count("bits").alias("many"))
    total = held.agg(F.sum(F.when(F.col("few") > 0, F.col("few")).otherwise(F.col("many")))).first()[0]
    assert total == rows.where("v IS NOT NULL").distinct().count()


@pytest.mark.parametrize("keys", [[], ["a"], ["b"], ["a", "b"]])
@pytest.mark.parametrize("chosen", ["true", "b = 1", "a LIKE 'k%'", "b IS NULL AND a = 'hot'"])
def test_sets_merge_exactly(members, keys, chosen):
    rows, sets = members
    want = rows.where(chosen).groupBy(*keys).agg(F.count_distinct("v").alias("n"))
    got = count_members(sets.where(chosen), keys, "n")
    assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_no_members(members):
    rows, sets = members
    assert distinct_sets(rows.limit(0), ["a"], "v").collect() == []
    assert distinct_sets(rows.where("v IS NULL"), ["a"], "v").collect() == []
    assert count_members(sets.limit(0), ["a"], "n").collect() == []


FILTERS = ("chain", "season", "gender", "order_purchase_method")
MEASURES = ("order_total_cost", "profit", "quantity", "menu_price")


@pytest.fixture(scope="module")
def stars(spark, make_lines):
    rng = random.Random(3)

    def pick(*values):
        return rng.choice(values)

    rows = [
        {
            "chain": pick("north", "south"),
            "season": pick("Spring", "Fall", None),
            "gender": pick("F", "M", None),
            "order_purchase_method": pick("Dine In", "Online"),
            "restaurant_id": pick(1, 2, 3, 4),
            "restaurant_state": pick("Ohio", "Iowa", None),
            "order_number": pick(None, *range(20)),
            "customer_id": pick(None, "a", "b", "c", "d"),
            "item_description": pick("soup", "cake", None),
            "item_category": pick("Starters", "Sweets"),
            "quantity": pick(1, 2, None),
            "profit": pick(None, Decimal("1.2500"), Decimal("-3.0001")),
            "order_total_cost": Decimal(rng.randrange(10_000)) / 100,
        }
        for _ in range(300)
    ]
    path = scratch_path(spark, "lines")
    make_lines(*rows).write.parquet(path)
    star = Star.from_lines(spark.read.parquet(path))

    def cube(keys, members):
        return write_cube(star.orders, keys, MEASURES, members, scratch_path(spark, "cube"))

    cubes = (
        cube((*FILTERS, "restaurant_id"), ("order_number", "customer_id")),
        cube((*FILTERS, "item_description", "item_category"), ()),
    )
    return star, replace(star, cubes=cubes)


SELECTIONS = [
    {},
    {"season": ["Spring", "Fall"], "gender": []},
    {"chain": ["south"], "gender": ["F"], "order_purchase_method": ["Online"]},
    {"season": ["Winter"]},
]
ANSWERED = (
    "report_chain_comparison report_season report_gender report_top_states report_products report_category"
    " report_method report_summary_stats dash_kpis dash_totals dash_chain dash_gender dash_season dash_category"
    " dash_category_chain dash_top_products dash_bottom_products dash_product_table dash_top_states dash_states"
    " states_by_chain fact_chain qa_state qa_item qa_default verify_total_orders"
).split()


@pytest.mark.parametrize("name", ANSWERED)
def test_cubes_give_what_the_lines_give(stars, name):
    lines, cubed = stars
    spec = CATALOGUE[name]
    for selection in SELECTIONS:
        assert _answering(spec, cubed, selection)
        got = run_report(spec, cubed, selection)
        want = run_report(spec, lines, selection)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(got.collect(), key=repr) == sorted(want.collect(), key=repr)


def test_what_a_cube_does_not_hold_comes_from_the_lines(stars):
    _, cubed = stars
    spec = CATALOGUE["report_time_of_day"]
    assert _answering(spec, cubed, {}) is None
    assert _answering(CATALOGUE["dash_kpis"], cubed, {"time_of_day": ["AM"]}) is None
    assert _answering(CATALOGUE["dash_kpis"], cubed, {"time_of_day": []})
    assert run_report(spec, cubed).count() == 2


def test_values_are_ordered_by_a_number_and_not_by_their_whole_key(spark, monkeypatch):
    seen = []

    def spy(df, order, *rest, **named):
        seen.append((df.schema, list(order)))
        return distinct_sets_module.number_rows_before(df, order, *rest, **named)

    monkeypatch.setattr(distinct_sets_module, "number_rows_before", distinct_sets_module.number_rows, raising=False)
    monkeypatch.setattr(distinct_sets_module, "number_rows", spy)
    rows = spark.createDataFrame([("a", None, 1), (None, "a", 1), ("b", "x", 2)], "k string, m string, v long")
    sets = distinct_sets_module.distinct_sets(rows, ["k", "m"], "v")
    assert seen[0][1] == ["_least", "v"] and seen[0][0]["_least"].dataType.typeName() == "long"
    # Keys of like hash are keys of their own.
    assert sorted((r.k or "", r.m or "", len(r.places)) for r in sets.collect()) == [
        ("", "a", 1), ("a", "", 1), ("b", "x", 1),
    ]

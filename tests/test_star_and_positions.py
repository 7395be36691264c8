"""Dimensions, keys, numbering and the stored star."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tillweave import session
from tillweave.operators import star as D
from tillweave.operators.cleaning import FeedConfig, tag_feed
from tillweave.operators.positions import number_in_file_order, number_rows
from tillweave.registered import base as R
from tillweave.session import scratch_path
from tillweave.sources import feeds as Feeds
from tillweave.sources import warehouse as W


def test_shared_restaurant_takes_the_first_feed(make_lines):
    lines = make_lines(
        {"chain": "south", "feed_rank": 1, "restaurant_state": "Utah", "row_ordinal": 0},
        {"chain": "north", "feed_rank": 0, "restaurant_state": "Ohio", "row_ordinal": 9},
        {"chain": "north", "feed_rank": 0, "restaurant_state": "Iowa", "row_ordinal": 10},
    )
    row = D.restaurant_dimension(lines).collect()
    assert [(r.restaurant_state, r.chain) for r in row] == [("Ohio", "north")]
    by_chain = D.restaurant_dimension(lines, by_chain=True).collect()
    assert {(r.chain, r.restaurant_state) for r in by_chain} == {("north", "Ohio"), ("south", "Utah")}
    assert D.restaurant_conflicts(lines).first().versions == 3


def test_ties_are_settled_by_payload_nulls_first(make_lines):
    lines = make_lines(
        {"row_ordinal": 5, "gender": "M", "has_children": "Yes"},
        {"row_ordinal": 5, "gender": "M", "has_children": None},
    )
    assert D.customer_dimension(lines).first().has_children is None


def test_item_number_of_both_chains_gives_two_products(make_lines):
    lines = make_lines({}, {"chain": "south", "feed_rank": 1, "item_description": "stew"})
    assert D.product_dimension(lines).count() == 2


def test_first_row_matches_brute_force(spark):
    rng = random.Random(1)
    rows = [
        # One key holds a third of all rows.
        (0 if i % 3 == 0 else rng.randrange(20), rng.randrange(2), rng.randrange(1000), f"p{rng.randrange(5)}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "k int, feed_rank int, row_ordinal int, payload string")
    got = {r.k: r.payload for r in D.first_row_per_key(df, ["k"], ["payload"]).collect()}
    want = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        want.setdefault(row[0], row[3])
    assert got == want


def test_key_report(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    row = D.key_report(df, "t", ["k"]).first()
    assert (row.rows, row.distinct_keys, row.duplicated_keys) == (3, 2, 1)


def test_numbering_matches_sorted_order(spark):
    rng = random.Random(2)
    values = [(rng.choice("ab"), rng.randrange(10_000)) for _ in range(5000)]
    df = spark.createDataFrame(values, "g string, v int").repartition(7)
    got = number_rows(df, ["v"], "n", group=["g"]).collect()
    for g in "ab":
        ordered = [r.v for r in sorted((r for r in got if r.g == g), key=lambda r: r.n)]
        assert ordered == sorted(v for k, v in values if k == g)
        assert sorted(r.n for r in got if r.g == g) == list(range(len(ordered)))


def test_numbering_splits_identical_rows(spark):
    df = spark.range(40_000, numPartitions=8).select(F.lit(1).alias("v"))
    numbered = number_rows(df, ["v"], "n", start=1)
    stats = numbered.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(stats) == (1, 40_000, 40_000)


def test_numbering_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    got = {(r.g, r.v): r.n for r in number_rows(df, ["v"], "n", group=["g"]).collect()}
    assert got == {(None, 1): 0, (None, 2): 1, ("a", 3): 0}


def test_numbering_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v int")
    assert number_rows(df, ["v"], "n", group=["g"]).count() == 0


@pytest.fixture(scope="module")
def stored(spark, make_lines):
    lines = make_lines(
        {"restaurant_state": "Ohio"},
        {"chain": "south", "feed_rank": 1, "restaurant_state": "Utah", "customer_id": "c2"},
        {"restaurant_id": 2, "restaurant_state": "Iowa", "customer_id": "c3", "item_number": 2},
    )
    folder = scratch_path(spark, "test-star")
    return folder, W.write_star(spark, lines, folder)


def test_star_round_trip(spark, stored):
    folder, star = stored
    counts = {r.table_name: r.rows for r in W.star_counts(star).collect()}
    assert counts == {"orders": 3, "restaurants": 2, "products": 3, "customers": 3}
    assert "restaurant_state" not in star.orders.columns
    again = W.read_star(spark, folder)
    assert again.orders.schema["profit"].dataType.simpleString() == "decimal(18,4)"


def test_full_refresh_replaces(spark, make_lines, stored):
    folder = scratch_path(spark, "test-refresh")
    W.write_star(spark, make_lines({}, {}), folder)
    star = W.write_star(spark, make_lines({}), folder)
    assert star.orders.count() == 1


def test_unique_order_numbers_alike_without_a_copy(spark):
    df = spark.range(500).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("g"))
    plain = number_rows(df, ["v"], "n", group=["g"]).collect()
    assert sorted(plain) == sorted(number_rows(df, ["v"], "n", group=["g"], unique=True).collect())


def test_load_is_counted_while_written(spark, make_lines):
    folder = scratch_path(spark, "test-log")
    W.write_star(spark, make_lines({}, {"gender": None}, {"gender": None}), folder)
    log = {r.metric: r.value for r in W.load_log(spark, folder).collect()}
    assert (log["rows"], log["unknown_money"]) == (3, 0)
    assert (log["nulls_gender"], log["nulls_customer_id"]) == (2, 0)


def test_mixed_chains_are_dealt_out(spark, make_lines):
    rows = [{"chain": f"c{i % 5}", "customer_id": f"u{i}"} for i in range(40)]
    lines = make_lines(*rows).repartition(8)
    counts = {}
    for mixed in (False, True):
        folder = scratch_path(spark, f"test-mixed-{mixed}")
        star = W.write_star(spark, lines, folder, mixed_chains=mixed)
        assert star.lines.count() == 40
        counts[mixed] = len(star.lines.inputFiles())
    assert counts[True] == 5 < counts[False]


def test_old_versions_go_and_the_current_one_stays(spark, make_lines):
    folder = scratch_path(spark, "test-versions")
    for n in (1, 2, 3, 4):
        W.write_star(spark, make_lines(*[{}] * n), folder)
    assert len(W.drop_old_versions(spark, folder, keep=2)) == 2
    assert len(os.listdir(f"{folder}/versions")) == 2
    assert W.read_star(spark, folder).orders.count() == 4
    with pytest.raises(ValueError, match="current"):
        W.drop_old_versions(spark, folder, keep=0)


def test_a_broken_load_leaves_no_files(spark, make_lines):
    folder = scratch_path(spark, "test-broken-files")
    W.write_star(spark, make_lines({}), folder)
    with pytest.raises(ValueError, match="known money: 2"):
        W.write_star(spark, make_lines({"profit": None}, {"menu_price": None}, {}), folder)
    assert len(os.listdir(f"{folder}/versions")) == 1


def test_stored_star_notices_cleared_scratch_and_new_tables(spark, tmp_path, monkeypatch):
    loads = []
    monkeypatch.setattr(R, "load_star", lambda spark, sf_dir: loads.append(sf_dir) or object())
    monkeypatch.setattr(R, "_STARS", kept := {})
    (tmp_path / "t.parquet").mkdir()
    (tmp_path / "t.parquet/part-0.parquet").write_bytes(b"one")
    first = R.stored_star(spark, str(tmp_path))
    assert R.stored_star(spark, str(tmp_path)) is first and len(loads) == 1
    (tmp_path / "t.parquet/part-1.parquet").write_bytes(b"more")
    R.stored_star(spark, str(tmp_path))
    assert len(loads) == 2 and len(kept) == 2
    assert any(getattr(f, "__self__", None) is not None for f in session.ON_CLEAR)


def test_location_comes_from_the_dimension(stored):
    _, star = stored
    frame = star.joined()
    assert frame.columns.count("restaurant_state") == 1
    south = frame.where("chain = 'south'").first()
    assert south.restaurant_state == "Ohio"
    kept = star.joined(persist=True)
    assert kept.is_cached and kept.count() == frame.count()
    assert "InMemoryTableScan" in kept.groupBy("chain").count()._jdf.queryExecution().toString()
    kept.unpersist()


def test_sql_surface(spark, stored):
    _, star = stored
    rows = W.query(
        spark,
        "SELECT r.restaurant_state, COUNT(*) AS n FROM {orders} o"
        " JOIN {restaurants} r ON o.restaurant_id = r.restaurant_id GROUP BY 1",
        star,
    ).collect()
    assert {(r[0], r[1]) for r in rows} == {("Ohio", 2), ("Iowa", 1)}


def test_a_broken_load_leaves_the_star_as_it_was(spark, make_lines):
    folder = scratch_path(spark, "test-broken")
    W.write_star(spark, make_lines({}), folder)
    with pytest.raises(ValueError, match="known money: 1"):
        W.write_star(spark, make_lines({}, {"profit": None}), folder)
    assert W.read_star(spark, folder).orders.count() == 1


def test_load_check_counts_lost_lines(spark, make_lines):
    lines = make_lines({}, {"restaurant_id": 2}, {"restaurant_id": 2})
    star = D.Star.from_lines(lines)
    lost = D.Star(star.orders, star.restaurants.where("restaurant_id = 1"), star.products, star.customers)
    found = {(r.table_name, r.rule): r.violations for r in W.load_check(lost).collect()}
    assert found.pop(("orders", "finds its restaurants")) == 2
    assert set(found.values()) == {0}


def test_file_order_does_not_depend_on_splits(spark):
    path = scratch_path(spark, "test-files")
    for name, first, count in (("a", 0, 10), ("b", 10, 20_000), ("c", 20_010, 3)):
        rows = spark.range(first, first + count).coalesce(1)
        rows.write.option("parquet.block.size", 16_384).parquet(f"{path}/{name}")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    for size in ("4k", "128m"):
        spark.conf.set(key, size)
        feed = spark.read.option("recursiveFileLookup", "true").parquet(path)
        numbered = number_in_file_order(feed, "n", start=5)
        assert numbered.where("n <> id + 5").count() == 0 and numbered.count() == 20_013
        plan = numbered.where("id > 20011")._jdf.queryExecution().executedPlan().toString()
        assert "GreaterThan(id,20011)" in plan
        assert "Sort" not in plan and "hashpartitioning" not in plan
    spark.conf.set(key, before)


def test_unnumbered_feeds_are_refused(spark):
    with pytest.raises(ValueError, match="row_ordinal"):
        tag_feed(spark.range(1), FeedConfig("x", 0))
    path = scratch_path(spark, "test-csv-feed")
    Feeds.write_csv(spark.range(1), path)
    with pytest.raises(ValueError, match="csv"):
        Feeds.read_feed(spark, path, spark.range(1).schema, "csv")


def test_csv_keeps_texts(spark):
    rows = [("a\nb", 1), ('say "x", y', 2), ("", 3), (None, 4), ("  s ", 5), ("back\\n", 6), ("\r\n\"", 7), ("", 8)]
    df = spark.createDataFrame(rows, "t string, n int")
    path = scratch_path(spark, "test-texts")
    Feeds.write_csv(df, path)
    back = [tuple(r) for r in Feeds.read_csv(spark, path, df.schema, line_ends=True).collect()]
    assert sorted(back, key=lambda r: r[1]) == rows
    with pytest.raises(Exception, match="null mark"):
        Feeds.write_csv(spark.createDataFrame([("\\N",)], "t string"), scratch_path(spark, "x"))

"""Rows dealt out through columnar files: the same results, without the shuffle."""

from __future__ import annotations

import glob
import random

import pytest
from pyspark.sql import functions as F

from tillweave.operators import dealing
from tillweave.operators import distinct_sets as distinct_sets_module
from tillweave.operators import scenario as Sc
from tillweave.operators import star as D
from tillweave.operators.cube import write_cube
from tillweave.operators.distinct_sets import count_members
from tillweave.operators.positions import number_rows
from tillweave.session import scratch_path
from tillweave.sources import sample_tables as B
from tillweave.sources import warehouse as W


@pytest.fixture
def many(monkeypatch):
    """Few rows are dealt out like many."""
    monkeypatch.setattr(dealing, "FROM_ROWS", 1)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def saved(spark, df, label):
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_dealt_rows_are_all_there_and_grouped_without_a_shuffle(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, g int, v int")
    tables = [t.name for t in spark.catalog.listTables()]
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    got = dealing.dealt(df, ["k"], scratch_path(spark, "dealt"))
    assert sorted(got.collect(), key=repr) == sorted(df.collect(), key=repr)
    counts = got.groupBy("k", "g").agg(F.max("v").alias("m")).groupBy("k").agg(F.sum("m"))
    assert "Exchange" not in plan_of(counts)
    assert [t.name for t in spark.catalog.listTables()] == tables
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    assert dealing.dealt(df.limit(0), ["k"], scratch_path(spark, "dealt")).count() == 0


def test_spread_tells_hot_keys_and_what_tasks_combine(spark, many):
    ids = spark.range(8000, numPartitions=4)
    one_each = dealing.spread(ids, ["id"])
    assert one_each.rows == 8000 and one_each.deals()
    hot = dealing.spread(ids.select(F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("k")), ["k"])
    # Four partitions, and nine tenths of the rows in one of them are within the limit of four shares.
    assert hot.fullest >= 7200 and (hot.fullest * hot.parts <= dealing.UNEVEN * 8000) == hot.even()
    few = dealing.spread(ids.select((F.col("id") % 50).alias("k")), ["k"])
    assert few.even() and not few.deals() and few.combined < 400
    assert not dealing.spread(ids.limit(0), ["id"]).deals()


def test_a_mark_for_each_partition(spark):
    marks = dealing.marks(spark)
    slots = spark.createDataFrame([(m,) for m in marks], "m int").select(F.pmod(F.hash("m"), F.lit(len(marks))))
    assert [r[0] for r in slots.collect()] == list(range(dealing.partitions(spark)))


def test_numbering_by_ranges_is_numbering_in_order(spark, monkeypatch):
    rng = random.Random(6)
    values = rng.sample(range(-20_000, 20_000), 3000)
    rows = [(rng.choice([None, "a", "b"]), v // 3 if i % 40 else None, v, f"t{v}") for i, v in enumerate(values)]
    df = saved(spark, spark.createDataFrame(rows, "g string, o long, p int, t string"), "ranges")
    how = {"order": ["o", "p"], "name": "n", "group": ["g"], "start": 5, "unique": True}
    want = number_rows(df, **how).collect()
    assert sorted(want, key=repr) == sorted(number_rows(df, **how, again=True).collect(), key=repr)
    monkeypatch.setattr(dealing, "FROM_ROWS", 1)
    numbered = number_rows(df, **how, again=True)
    assert sorted(want, key=repr) == sorted(numbered.collect(), key=repr)
    # No row is moved once more, and no sorted copy stored.
    assert "rangepartitioning" not in plan_of(numbered) and "dealt_" in plan_of(numbered)


@pytest.mark.parametrize("column", ["CAST(7 AS BIGINT)", "CAST(NULL AS BIGINT)", "CAST(id AS STRING)", "id * id * id * id"])
def test_orders_that_ranges_do_not_split_are_sorted(spark, many, column):
    df = saved(spark, spark.range(2000).selectExpr(f"{column} AS o", "id"), "unsplit")
    got = number_rows(df, ["o", "id"], "n", unique=True, again=True)
    want = {r.id: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.o is not None, r.o, r.id)))}
    assert {r.id: r.n for r in got.collect()} == want


def test_projection_deals_lines_out_by_range(spark, make_lines, many):
    params = Sc.ScenarioParams(growth={"south": 0.07}, id_prefix={"north": "N"})
    lines = saved(spark, make_lines(*[{"chain": "south" if i % 3 else "north"} for i in range(60)]), "lines")
    projected = Sc.project(lines, params, ["row_ordinal"], unique=True)
    assert "rangepartitioning" not in plan_of(projected) and "dealt_" in plan_of(projected)
    assert projected.columns == lines.columns
    ids = {r.row_ordinal: r.customer_id for r in projected.collect()}
    assert [ids[i] for i in (0, 3, 57, 1, 59)] == ["N000000", "N000001", "N000019", "south000000", "south000039"]


def test_customers_of_one_line_each_are_not_shuffled(spark, make_lines, many, monkeypatch):
    rng = random.Random(8)
    rows = [
        {
            "customer_id": rng.choice([None, *(f"c{i}" for i in range(150))]),
            "gender": rng.choice(["F", "M", None]),
            "row_ordinal": rng.choice([None, *range(40)]),
            "feed_rank": rng.choice([0, 1]),
        }
        for _ in range(400)
    ]
    lines = make_lines(*rows)
    seen, first_rows = [], D.customer_dimension

    def spy(stored):
        seen.append(plan_of(first_rows(stored)))
        return first_rows(stored)

    want = sorted(D.customer_dimension(lines).collect(), key=repr)
    monkeypatch.setattr(D, "customer_dimension", spy)
    star = W.write_star(spark, lines, folder := scratch_path(spark, "customers"))
    assert "Exchange" not in seen[0]
    assert sorted(star.customers.collect(), key=repr) == want
    # What was dealt out is removed once the dimension is stored.
    assert not glob.glob(f"{folder}/versions/*/dealt")
    # Tasks combine the lines of a hot customer, who would be a partition's only one.
    W.write_star(spark, make_lines(*[{}] * 40), scratch_path(spark, "customers"))
    assert "Exchange" in seen[1]


@pytest.mark.parametrize("keys", [["k"], ["k", "m"]])
def test_dealt_pairs_give_the_sets_that_shuffled_ones_give(spark, monkeypatch, keys):
    rng = random.Random(9)
    rows = [(rng.choice([None, *"abcdefghij"]), rng.randrange(3), rng.choice([None, *range(6000)])) for _ in range(9000)]
    df = saved(spark, spark.createDataFrame(rows, "k string, m int, v int"), "pairs")
    monkeypatch.setattr(distinct_sets_module, "FEW", 270)

    def held():
        sets = saved(spark, distinct_sets_module.distinct_sets(df, keys, "v"), "sets")
        assert sets.where("places IS NOT NULL AND bits IS NOT NULL").isEmpty()
        places = F.sort_array("places")
        return sorted((tuple(r) for r in sets.withColumn("places", places).collect()), key=repr)

    want = held()
    monkeypatch.setattr(dealing, "FROM_ROWS", 1)
    dealt = []
    monkeypatch.setattr(dealing, "dealt", lambda *a, f=dealing.dealt: dealt.append(a) or f(*a))
    assert held() == want and len(dealt) == 2
    assert {r[-2] is None for r in want} == ({True, False} if keys == ["k", "m"] else {True})
    # Without a bitmap among them.
    monkeypatch.setattr(distinct_sets_module, "FEW", 1 << 15)
    assert all(r[-1] is None for r in held())


def test_cells_of_a_line_each_are_dealt_and_not_combined(spark, make_lines, many, monkeypatch):
    rng = random.Random(10)
    rows = [
        {
            "restaurant_id": rng.choice([None, *range(300)]),
            "season": rng.choice(["Fall", "Spring", None]),
            "quantity": rng.choice([None, 1, 2]),
            "order_number": rng.choice([None, *range(150)]),
        }
        for _ in range(500)
    ]
    lines = saved(spark, make_lines(*rows), "lines")
    keys, measures = ["season", "restaurant_id"], ["profit", "quantity"]
    dealt = []
    monkeypatch.setattr(dealing, "dealt", lambda *a, f=dealing.dealt: dealt.append(a[2]) or f(*a))

    def cells(folder):
        cube = write_cube(lines, keys, measures, ["order_number"], folder)
        counts = count_members(cube.sets["order_number"], keys, "n")
        return [sorted(df.collect(), key=repr) for df in (cube.cells, counts)]

    got = cells(folder := scratch_path(spark, "cube"))
    assert len(dealt) == 3 and dealt[0] == f"{folder}/dealt" and not glob.glob(dealt[0])
    monkeypatch.setattr(dealing, "FROM_ROWS", 1_000_000)
    assert got == cells(scratch_path(spark, "cube")) and len(dealt) == 3
    # Tasks combine the lines of a few cells.
    monkeypatch.setattr(dealing, "FROM_ROWS", 1)
    write_cube(lines, ["season"], measures, [], scratch_path(spark, "cube"))
    assert len(dealt) == 3


def test_the_order_key_goes_to_the_parts_once(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = plan_of(B.raw_feed(spark, sf_dir, B.FEED_A)).splitlines()
    finally:
        spark.conf.set(key, before)
    moved = [below for row, below in zip(rows, rows[1:]) if "Exchange hashpartitioning(l_partkey" in row]
    assert moved and all("l_orderkey" in row and "o_orderkey" not in row for row in moved)

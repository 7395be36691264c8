"""What the load and the CSV sink shuffle, sort and store."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tillweave.operators import type_lattice as TL
from tillweave.operators.cleaning import clean_feed
from tillweave.session import scratch_path
from tillweave.sources import feeds as Feeds
from tillweave.sources import sample_tables as B
from tillweave.sources import warehouse as W


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    rows = [row.strip(" :+-*") for row in plan.splitlines()]
    # What lies directly below an exchange.
    return [below for row, below in zip(rows, rows[1:]) if row.startswith("Exchange")]


def test_columns_are_made_behind_the_joins(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cfg = B.FEED_A
        below = _exchanges(clean_feed(B.raw_feed(spark, sf_dir, cfg), cfg))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert below
    # "AS" marks a column that was made before it is shuffled.
    assert not [row for row in below if " AS " in row]


def test_lines_are_not_sorted_for_the_write(spark, make_lines):
    rows = [{"chain": c, "customer_id": f"c{i}"} for i in range(40) for c in "abcdef"]
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    folder = scratch_path(spark, "unsorted")
    star = W.write_star(spark, make_lines(*rows).repartition(1), folder)
    # More chains in a task than it keeps open, and the setting is as it was.
    assert star.orders.groupBy("chain").count().count() == 6 > W.OPEN_CHAINS
    assert star.orders.count() == 240
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    file = glob.glob(f"{folder}/versions/*/orders/chain=a/*.parquet")[0]
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def test_nothing_is_counted_row_by_row_on_the_way_to_the_files(spark, make_lines, monkeypatch):
    def observe(*_):
        raise AssertionError("each row passes an accumulator of all counts")

    monkeypatch.setattr(type(spark.range(1)), "observe", observe)
    folder = scratch_path(spark, "counted")
    lines = make_lines(
        {"chain": "a", "gender": None}, {"chain": "b", "gender": None}, {"chain": None}, {"chain": "b"}
    )
    W.write_star(spark, lines, folder)
    log = {r.metric: r.value for r in W.load_log(spark, folder).collect()}
    assert log["rows"] == 4 and log["unknown_money"] == 0
    assert log["nulls_gender"] == lines.where("gender IS NULL").count() >= 2
    assert log["nulls_chain"] == 1
    for name in lines.columns:
        assert log[f"nulls_{name}"] == lines.where(F.col(name).isNull()).count(), name


def test_csv_files_have_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(Feeds, "FILE_LINES", 10)
    path = scratch_path(spark, "short-files")
    rows = spark.range(0, 95, 1, 1).select(F.col("id").cast("string").alias("a"))
    Feeds.write_csv(rows, path)
    assert len(glob.glob(f"{path}/*.csv")) == 10
    got = Feeds.read_csv(spark, path, rows.schema, line_ends=True)
    assert sorted(int(r.a) for r in got.collect()) == list(range(95))


# Values at the borders of the forms (fixed values).
_EDGES = [
    None, "", "0", "+7", "-7", "1" * 18, "1" * 19, "1" * 20, "1" * 21, "1.5", "+1.50", "1.", ".5", "1.2.3",
    "1e5", "-1E-12", "1e1234", "123e-5", "2020-01-01", "2020-02-30", "2020-13-01", "2020-01-01T00:00:00",
    "2020-01-01 23:59:59.123456", "2020-01-01 24:00:00", "2020-01-01x", "20200101", "12345-01",
    "true", "True", "tRue", "FALSE", "false ", " 1", "1 ", "-", "+", ".", "--1", "٣", "x", "1\n",
    "true\n", "2020-01-01\n",
]


def test_a_form_found_once_is_what_all_patterns_say(spark):
    values = spark.createDataFrame([(v,) for v in _EDGES], "v string")
    value = F.col("v")
    tried = [F.coalesce(TL.is_form(value, f), F.lit(False)).alias(f"t_{f}") for f in TL.PATTERNS]
    place = TL.form_of(value)
    said = [F.coalesce(place.isin(TL._holding(f)), F.lit(False)).alias(f"s_{f}") for f in TL.PATTERNS]
    for row in values.select("v", *tried, *said).collect():
        assert [row[f"t_{f}"] for f in TL.PATTERNS] == [row[f"s_{f}"] for f in TL.PATTERNS], row


def test_profile_tries_patterns_once(spark):
    plan = TL.text_profile(spark.createDataFrame([("1",)], "v string"))._jdf.queryExecution().optimizedPlan().toString()
    aggregate = next(row for row in plan.splitlines() if "Aggregate" in row)
    assert "RLIKE" not in aggregate.upper()

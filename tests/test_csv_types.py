"""CSV by header name, inferred types, the type lattice and split files."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tillweave.operators.cleaning import merge_feeds
from tillweave.operators.type_lattice import join_types, widened
from tillweave.session import scratch_path
from tillweave.sources import feeds as Feeds


@pytest.fixture
def folder(spark):
    # The scratch folder of a local session.
    path = scratch_path(spark, "csv-files")
    os.makedirs(path)
    return path


def _file(folder, text, name="a.csv"):
    with open(f"{folder}/{name}", "w", newline="") as file:
        file.write(text)
    return folder


AB = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])


def test_columns_are_found_by_name(spark, folder):
    path = _file(folder, "b,more,a\n1,zz,x\n2,,y\n")
    got = Feeds.read_csv(spark, path, AB)
    assert got.columns == ["a", "b"]
    assert sorted(map(tuple, got.collect())) == [("x", 1), ("y", 2)]


def test_missing_column_is_named(spark, folder):
    with pytest.raises(ValueError, match="no column b; the header has a, c"):
        Feeds.read_csv(spark, _file(folder, "a,c\nx,1\n"), AB)


def test_a_value_that_does_not_fit_is_an_error(spark, folder):
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        Feeds.read_csv(spark, _file(folder, "a,b\nx,one\n"), AB).collect()


def test_files_of_another_header_are_refused(spark, folder):
    _file(folder, "a,b\nx,1\n", "1.csv")
    _file(folder, "b,a\n2,y\n", "2.csv")
    with pytest.raises(Exception, match="[Hh]eader"):
        Feeds.read_csv(spark, folder, AB).collect()


def test_a_large_file_is_split(spark, folder):
    path = _file(folder, "a,b\n" + "some text,7\n" * 40_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        split = Feeds.read_csv(spark, path, AB)
        whole = Feeds.read_csv(spark, path, AB, line_ends=True)
        assert split.rdd.getNumPartitions() > 4 and whole.rdd.getNumPartitions() == 1
        assert split.count() == whole.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_types_are_inferred_and_conflicts_told(spark, folder):
    path = _file(
        folder,
        "whole,money,float,day,time,truth,text,mixed,none,neg\n"
        "1,1.50,1e3,2020-02-29,2020-01-01 10:00:00,true,x,1,,-5\n"
        "22,10,2.5,2020-01-01,2020-01-02,False,,2,,+7\n"
        ",300.125,3,,,,2020-02-30,n/a,,\n",
    )
    found = {r.column: r for r in Feeds.csv_profile(spark, path).collect()}
    kinds = {name: r.type for name, r in found.items()}
    assert kinds == {
        "whole": "bigint", "money": "decimal(6,3)", "float": "double", "day": "date",
        "time": "timestamp", "truth": "boolean", "text": "string", "mixed": "string",
        "none": "string", "neg": "bigint",
    }
    assert (found["mixed"].conflicts, found["whole"].conflicts, found["none"].nulls) == (1, 0, 3)
    rows = Feeds.read_csv_inferred(spark, path).collect()
    assert rows[0].money == Decimal("1.500") and rows[0].day == dt.date(2020, 2, 29)
    assert rows[1].truth is False and rows[1].text is None and rows[2].whole is None
    assert rows[0].float == 1000.0 and rows[1].neg == 7


def test_an_empty_file_has_text_columns(spark, folder):
    path = _file(folder, "a,b\n")
    assert [r.type for r in Feeds.csv_profile(spark, path).collect()] == ["string", "string"]
    assert Feeds.read_csv_inferred(spark, path).collect() == []


def test_lattice_joins():
    long, double, text, date, stamp = (
        T.LongType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampType()
    )
    money = T.DecimalType(18, 2)
    assert join_types(T.IntegerType(), long) == long
    assert join_types(long, money) == T.DecimalType(21, 2)
    assert join_types(T.DecimalType(10, 4), money) == T.DecimalType(20, 4)
    assert join_types(T.DecimalType(38, 0), money) == double
    assert join_types(money, double) == double
    assert join_types(date, stamp) == stamp and join_types(date, long) == text
    assert join_types(T.NullType(), date) == date
    kinds = [T.NullType(), T.IntegerType(), long, money, double, date, stamp, text, T.BooleanType()]
    for a in kinds:
        for b in kinds:
            assert join_types(a, b) == join_types(b, a)


def test_feeds_of_differing_types_are_widened(spark):
    a = spark.createDataFrame([(1, "x")], "zip long, only_a string")
    b = spark.createDataFrame([("A-2", 5)], "zip string, only_b int")
    rows = merge_feeds([a, b]).select("zip", "only_a", "only_b").collect()
    assert sorted(map(tuple, rows)) == [("1", "x", None), ("A-2", None, 5)]
    same = widened([a, a])
    assert same[0] is a and same[1] is a

"""Exact distinct counts that merge: sets of numbers, kept per key.

Every distinct value of a column gets a number without gaps, in the order of the
least hash of a key that holds it, so that values of one key lie next to each
other.  Which number a value has changes no count.  A set
holds the numbers of one key within a bucket of ``BUCKET``: as a list of places
while they are few, as a bitmap beyond that, whichever is smaller.  Sets of
several keys merge by union.  Stored sets therefore answer distinct counts over
coarser keys, after any filter on the keys or join on them, without the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.operators import dealing
from tillweave.operators.positions import number_rows
from tillweave.session import scratch_path

#: Numbers in a bucket, fixed by the bitmap functions.
BUCKET = 1 << 15
#: Places kept as a list, of two bytes each; a bitmap takes a bit for each number of its bucket.
FEW = BUCKET // 16


def distinct_sets(rows: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """The known values of ``column`` under each of ``keys``: (keys, bucket, places, bits).

    One of ``places`` and ``bits`` is null.  Rows are cut to distinct pairs of
    key and value first, which a task does before it sends anything, so a key
    with very many rows is no larger than its values.  Null keys are keys.  Where
    tasks would find hardly a pair twice, many rows are dealt out by value through
    columnar files and cut there, and their numbers by key and bucket.
    """
    spark = rows.sparkSession
    known = rows.where(F.col(column).isNotNull()).select(*keys, column)
    deals = dealing.spread(known, [column], keys).deals()
    if deals:
        pairs = dealing.dealt(known, [column], scratch_path(spark, "pairs")).distinct()
    else:
        path = scratch_path(spark, "pairs")
        distinct = known.distinct()
        distinct.write.option("compression", "zstd").parquet(path)
        pairs = spark.read.schema(distinct.schema).parquet(path)
    # No two values are alike, so their order is unique.
    firsts = pairs.groupBy(column).agg(F.min(F.xxhash64(*keys)).alias("_least"))
    numbered = number_rows(firsts, ["_least", column], "_number", start=1, unique=True)
    numbers = numbered.select(F.col(column).alias("_value"), "_number")
    placed = pairs.join(numbers, pairs[column] == numbers["_value"]).select(
        *keys,
        F.bitmap_bucket_number("_number").alias("bucket"),
        F.bitmap_bit_position("_number").cast("smallint").alias("_place"),
    )
    if deals:
        placed = dealing.dealt(placed, [*keys, "bucket"], scratch_path(spark, "placed"))
    # At most BUCKET places.
    lists = placed.groupBy(*keys, "bucket").agg(F.collect_list("_place").alias("places"))
    few = lists.where(F.size("places") <= FEW).withColumn("bits", F.lit(None).cast("binary"))
    if deals and placed.groupBy(*keys, "bucket").count().where(F.col("count") > FEW).isEmpty():
        return few
    many = (
        lists.where(F.size("places") > FEW)
        .select(*keys, "bucket", _each_place())
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg("_place").alias("bits"))
    )
    return few.unionByName(many, allowMissingColumns=True)


def _each_place():
    return F.explode(F.col("places").cast("array<bigint>")).alias("_place")


def count_members(sets: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """How many distinct values the sets of each of ``keys`` hold together: (keys, name).

    Meant for keys with many members each, as every key and bucket becomes a
    bitmap on the way.  Without keys it is one row, null if there is no set.
    """
    listed = (
        sets.where(F.col("places").isNotNull())
        .select(*keys, "bucket", _each_place())
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_construct_agg("_place").alias("bits"))
    )
    packed = (
        sets.where(F.col("bits").isNotNull())
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    united = (
        listed.unionByName(packed).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    )
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))

"""Rows dealt out by key through columnar files, in place of a shuffle.

A shuffle moves rows as they lie in memory, strings and eight bytes a number; an
order line of 26 columns takes some 130 bytes that way and 25 in a bucketed
Parquet file.  What is read from the files is already dealt out, so joins,
groups and windows over the keys need no shuffle.  Nothing is combined on the
way and no task shares a hot key with another, so a caller looks at the spread
of its keys first and shuffles where that is uneven.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fewer rows are shuffled, as files of their own would cost more than they save.
FROM_ROWS = 1_000_000
#: The largest share of the rows that a partition may get, in shares of an even deal.
UNEVEN = 4
#: Rows that a task has to combine into one for a shuffle to move less than a deal.
COMBINED = 3
#: Files that are written for a deal; tasks that write are joined until there are no more.
FILES = 1 << 15
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def marks(spark: SparkSession) -> list[int]:
    """A whole number for each partition, by which a row is dealt to it."""
    parts = partitions(spark)
    numbers = spark.range(64 * parts).select(F.col("id").cast("int").alias("id"))
    slots = numbers.groupBy(F.pmod(F.hash("id"), F.lit(parts)).alias("slot")).agg(F.min("id").alias("id"))
    # One row per partition.
    found = {r.slot: r.id for r in slots.collect()}
    return [found.get(p, p) for p in range(parts)]


@dataclass(frozen=True)
class Spread:
    """Rows, those that the fullest partition would get, and about how many would be shuffled.

    Tasks combine rows of like values before they shuffle them, but not before
    they deal them out.
    """

    parts: int
    rows: int
    fullest: int
    combined: int

    def even(self) -> bool:
        return self.rows >= FROM_ROWS and self.fullest * self.parts <= UNEVEN * self.rows

    def deals(self) -> bool:
        return self.even() and self.rows < COMBINED * self.combined


def spread(rows: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> Spread:
    """How rows would be dealt by ``keys``, and combined by these and ``values``; one pass over both."""
    parts = partitions(rows.sparkSession)
    slots = (
        rows.select(
            F.pmod(F.hash(*keys), F.lit(parts)).alias("slot"),
            F.xxhash64(*dict.fromkeys([*keys, *values]), F.spark_partition_id()).alias("apart"),
        )
        .groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("apart").alias("d"))
    )
    found = slots.agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("d").alias("d")).first()
    return Spread(parts, found.n or 0, found.most or 0, found.d or 0)


def dealt(rows: DataFrame, keys: Sequence[str], folder: str) -> DataFrame:
    """``rows`` written to ``folder`` and read back, all rows of like ``keys`` in one partition.

    The catalog knows the files for as long as it takes to read their layout.
    Whoever is done with the rows removes the folder, or leaves it to ``clear_scratch``.
    """
    spark = rows.sparkSession
    parts = partitions(spark)
    cores = spark.sparkContext.defaultParallelism
    tasks = max(FILES // (parts * cores), 1) * cores
    name = f"dealt_{uuid.uuid4().hex}"
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, parts)
    writer = rows.coalesce(tasks).write.format("parquet").bucketBy(parts, *keys)
    try:
        writer.option("path", folder).option("compression", "zstd").saveAsTable(name)
        found = spark.table(name)
    finally:
        spark.conf.set(_WRITERS, before)
        # The files stay, as the table names a folder of its own.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return found

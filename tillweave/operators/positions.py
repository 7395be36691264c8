"""Sequential numbering without pulling everything through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.operators import dealing
from tillweave.session import scratch_path

# monotonically_increasing_id() keeps the partition number above bit 33 and the
# row's place in the partition below it.
_PLACE_BITS = 33


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_in_file_order(files: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number rows `start, start+1, ...` by file path and place in the file.

    `files` must come straight from parquet files.  A row's number is its place
    in its file plus the rows of the files before it, so nothing is sorted or
    shuffled but one count per file, and neither split sizes nor file sizes
    change it.  Filters above are still pushed to the scan.
    """
    path = F.col("_metadata.file_path").alias("_file")
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file, stored so that its size is known to the join.
    offsets = _stored(
        files.select(path)
        .groupBy("_file")
        .agg(F.count("*").alias("_n"))
        .select("_file", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")),
        "file-offsets",
    )
    placed = files.select("*", path, F.col("_metadata.row_index").alias("_row"))
    number = (F.col("_before") + F.col("_row") + F.lit(start)).cast("bigint")
    return placed.join(offsets, "_file").select(*files.columns, number.alias(name))


def number_rows(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    group: Sequence[str] = (),
    start: int = 0,
    unique: bool = False,
    again: bool = False,
) -> DataFrame:
    """Number rows `start, start+1, ...` in `order`, separately per `group`.

    A ranking window would send each group, or the whole table, to one task.
    Instead the rows are stored once, range-partitioned and sorted.  The last
    sort key is the row's file and place in it, so even identical rows spread
    over partitions and a task that is run again gives the same order.  With
    `unique` no two rows of a group are alike in `order`: no such key is needed,
    and the rows are not stored before they are sorted.  The
    sorted rows are stored as well, because the numbering reads them twice and
    both passes must see the same partitions.  Each row's number is its place
    within its partition plus the rows of its group in earlier partitions.  The
    pass that counts those reads the group and the place only.

    `again` says that the rows are cheap to compute again, as those of a scan are.
    Many rows of a `unique` order are then dealt out by ranges of its first
    column, if that is a whole number and spreads them evenly, and no sorted copy
    is stored, see `_number_in_cells`.
    """
    keys = list(group)
    sort_keys = [*keys, *order]
    if unique and again:
        numbered = _number_in_cells(df, list(order), name, keys, start)
        if numbered is not None:
            return numbered
    placed = df
    if not unique:
        sort_keys += ["_file", "_row"]
        placed = _stored(df, "unsorted").select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.row_index").alias("_row"),
        )
    ordered = _stored(
        placed.repartitionByRange(*sort_keys)
        .sortWithinPartitions(*sort_keys)
        .drop("_file", "_row")
        .withColumn("_slot", F.monotonically_increasing_id()),
        "sorted",
    )
    part: Column = F.shiftright("_slot", _PLACE_BITS)
    counts = ordered.groupBy(*keys, part.alias("_part")).agg(
        F.min("_slot").alias("_first"), F.count("*").alias("_n")
    )
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most one row per partition and group, stored so that its size is known to the join.
    offsets = _stored(
        counts.select(
            *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)],
            F.col("_part").alias("_p"),
            "_first",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        ),
        "offsets",
    )
    match = F.shiftright(ordered["_slot"], _PLACE_BITS) == offsets["_p"]
    for i, k in enumerate(keys):
        match = match & ordered[k].eqNullSafe(offsets[f"_g{i}"])
    number = F.col("_slot") - F.col("_first") + F.col("_before") + F.lit(start)
    return ordered.join(offsets, match).select(number.cast("bigint").alias(name), *df.columns)


#: Ranges per partition.
_CELLS = 8


def _number_in_cells(
    df: DataFrame, order: list[str], name: str, keys: list[str], start: int
) -> DataFrame | None:
    """Number rows by ranges of the first column of `order`; none where they are few or uneven.

    Rows are counted per range and group first, which tells how many precede
    each range.  Then they are dealt out by range through columnar files, and a
    row's number is its place within range and group plus the rows before those.
    """
    first, spark = F.col(order[0]), df.sparkSession
    if df.schema[order[0]].dataType.typeName() not in ("integer", "long"):
        return None
    ends = df.agg(F.min(first).alias("low"), F.max(first).alias("high"), F.count("*").alias("n")).first()
    if ends.low is None or ends.n < dealing.FROM_ROWS:
        return None
    parts = dealing.partitions(spark)
    width = (float(ends.high) - float(ends.low)) / (parts * _CELLS) or 1.0
    place = F.floor((first.cast("double") - F.lit(float(ends.low))) / F.lit(width))
    # Nulls come first, as in any ascending order.
    cell = F.coalesce(place.cast("int"), F.lit(-1))
    earlier = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select(*keys, cell.alias("_cell")).groupBy(*keys, "_cell").agg(F.count("*").alias("_n"))
    # At most one row per range and group, stored so that its size is known to the join.
    offsets = _stored(
        counts.select(
            *[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)],
            F.col("_cell").alias("_c"),
            "_n",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        ),
        "offsets",
    )
    # At most one row per range.
    held = {r["_c"]: r["_n"] for r in offsets.groupBy("_c").agg(F.sum("_n").alias("_n")).collect()}
    if max(held.values()) * parts > dealing.UNEVEN * ends.n:
        return None
    # Neighbouring ranges share a partition, so rows that lie together in the order stay together.
    marks, before, share = dealing.marks(spark), 0, []
    for c in range(-1, max(held) + 1):
        share.append(marks[min(before * parts // ends.n, parts - 1)])
        before += held.get(c, 0)
    shares = F.split(F.lit(",".join(map(str, share))), ",").cast("array<int>")
    moved = dealing.dealt(
        df.withColumn("_part", F.element_at(shares, cell + 2)), ["_part"], scratch_path(spark, "dealt")
    )
    within = Window.partitionBy("_part", "_cell", *keys).orderBy(*order)
    placed = moved.withColumn("_cell", cell).withColumn("_place", F.row_number().over(within))
    match = placed["_cell"] == offsets["_c"]
    for i, k in enumerate(keys):
        match = match & placed[k].eqNullSafe(offsets[f"_g{i}"])
    number = F.col("_before") + F.col("_place") + F.lit(start - 1)
    return placed.join(offsets, match).select(number.cast("bigint").alias(name), *df.columns)

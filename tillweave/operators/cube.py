"""A stored cube: order lines summed by a few keys, exactly and with what distinct counts need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave import schema as S
from tillweave.functions import numbers as N
from tillweave.operators import dealing
from tillweave.operators.distinct_sets import distinct_sets
from tillweave.session import remove_folder


@dataclass(frozen=True)
class Cube:
    """``cells`` hold one row per combination of ``keys`` that occurs, null ones included.

    A cell knows its lines (``rows``) and per measure x the ``sum_x``, the lines
    ``n_x`` where it is known, ``min_x`` and ``max_x``.  ``types`` are the types
    that the measures have in the lines; ``sets`` the distinct sets by column.
    """

    keys: tuple[str, ...]
    types: Mapping[str, T.DataType]
    cells: DataFrame
    sets: Mapping[str, DataFrame]


def write_cube(
    lines: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    members: Sequence[str],
    folder: str,
) -> Cube:
    """Sum ``lines`` by ``keys`` and store the cells, and the sets of ``members``, below ``folder``.

    Sums are decimals or whole numbers and distinct values are kept as sets, so
    whatever is answered from the cube equals what the lines give, to the last
    digit and in any order.  A task combines its lines per cell before it sends
    them, so a hot key is no larger than any other.  Where nearly every line of a
    task is a cell of its own, what a cell knows is wider than the line, and lines
    are dealt out by cell through columnar files instead.
    """
    spark = lines.sparkSession
    types = {m: lines.schema[m].dataType for m in measures}
    totals = [F.count(F.lit(1)).alias("rows")]
    for m, dtype in types.items():
        exact = N.exact_sum(F.col(m), dtype) if m in S.MONEY_COLUMNS else F.sum(m)
        totals += [
            exact.alias(f"sum_{m}"),
            F.count(m).alias(f"n_{m}"),
            F.min(m).alias(f"min_{m}"),
            F.max(m).alias(f"max_{m}"),
        ]

    def stored(frame: DataFrame, name: str) -> DataFrame:
        frame.write.option("compression", "zstd").parquet(f"{folder}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{folder}/{name}")

    summed = lines
    if dealing.spread(lines, keys).deals():
        summed = dealing.dealt(lines.select(*dict.fromkeys([*keys, *measures])), keys, f"{folder}/dealt")
    cells = stored(summed.groupBy(*keys).agg(*totals), "cells")
    remove_folder(spark, f"{folder}/dealt")
    return Cube(
        tuple(keys),
        types,
        cells,
        {c: stored(distinct_sets(lines, keys, c), f"members_{c}") for c in members},
    )

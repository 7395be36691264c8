"""Dimensions by first-row-wins, key checks and the star itself."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.operators.cube import Cube


def first_row_per_key(
    lines: DataFrame, keys: Sequence[str], payload: Sequence[str]
) -> DataFrame:
    """One row per key: the payload of the earliest row in (feed rank, row ordinal).

    Rows are first collapsed to one per distinct (key, payload) with the least
    ordinal.  That is a plain hash aggregation with map-side combine, so a key
    that holds a third of all rows shrinks before anything is shuffled and no
    row-level sort is needed.  Only the collapsed rows are then compared.  Rows
    tied on rank and ordinal are settled by the payload, nulls first.
    """
    extra = [c for c in payload if c not in keys]
    collapsed = lines.groupBy(*keys, *extra, S.FEED_RANK).agg(
        F.min(S.ROW_ORDINAL).alias(S.ROW_ORDINAL)
    )
    earliest = F.min(F.struct(S.FEED_RANK, S.ROW_ORDINAL, *extra)).alias("_first")
    return collapsed.groupBy(*keys).agg(earliest).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in extra]
    )


def restaurant_dimension(lines: DataFrame, by_chain: bool = False) -> DataFrame:
    """One row per restaurant id, or per (id, chain) when chains number sites separately."""
    keys = ["restaurant_id", "chain"] if by_chain else ["restaurant_id"]
    dim = first_row_per_key(lines, keys, [*S.LOCATION_COLUMNS, "chain"])
    return dim.withColumnRenamed("restaurant_zip_code", "restaurant_zip").select(
        "restaurant_id", "restaurant_city", "restaurant_state", "restaurant_zip", "chain"
    )


def restaurant_conflicts(lines: DataFrame) -> DataFrame:
    """Restaurant ids that appear with more than one (chain, state)."""
    return (
        lines.select("restaurant_id", "chain", "restaurant_state")
        .distinct()
        .groupBy("restaurant_id")
        .agg(F.count("*").alias("versions"))
        .where(F.col("versions") > 1)
    )


def state_dimension(lines: DataFrame) -> DataFrame:
    """The two columns of the restaurant dimension that the regional reports read."""
    return first_row_per_key(lines, ["restaurant_id"], ["restaurant_state", "chain"]).select(
        "restaurant_id", "restaurant_state"
    )


def product_dimension(lines: DataFrame) -> DataFrame:
    payload = ["item_description", "item_code", "item_category", "menu_price"]
    return first_row_per_key(lines, ["item_number", "chain"], payload).select(
        "item_number", *payload, "chain"
    )


def customer_dimension(lines: DataFrame) -> DataFrame:
    return first_row_per_key(lines, ["customer_id"], ["gender", "has_children", "chain"])


def key_report(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and duplicated keys of a table, in one aggregation."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows"),
        F.count("*").alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        "rows",
        "distinct_keys",
        "duplicated_keys",
    )


@dataclass(frozen=True)
class Star:
    """Fact and dimensions of one dataset; every report takes one of these."""

    orders: DataFrame
    restaurants: DataFrame | None = None
    products: DataFrame | None = None
    customers: DataFrame | None = None
    #: Stored order lines with location and row order, where the star was loaded from storage.
    lines: DataFrame | None = None
    #: Stored cubes of the fact, which reports are answered from where they can be.
    cubes: tuple[Cube, ...] = ()

    @classmethod
    def from_lines(cls, lines: DataFrame) -> Star:
        """Derive the star from merged order lines that carry all columns."""
        fact = [c for c in S.FACT_COLUMNS if c in lines.columns]
        kept = [c for c in S.BOOKKEEPING if c in lines.columns]
        return cls(
            orders=lines.select(*fact, *kept),
            restaurants=restaurant_dimension(lines),
            products=product_dimension(lines),
            customers=customer_dimension(lines),
        )

    def joined(self, persist: bool = False) -> DataFrame:
        """Order lines with their location, optionally kept for an interactive session.

        The location always comes from the dimension.  No broadcast hint: the
        engine broadcasts the dimension only when its measured size is below
        the configured threshold and otherwise joins by shuffle.
        """
        facts = self.orders.drop(*S.LOCATION_COLUMNS)
        places = self.restaurants.select("restaurant_id", "restaurant_city", "restaurant_state")
        frame = facts.join(places, "restaurant_id")
        return frame.persist() if persist else frame

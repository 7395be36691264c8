"""Cleaning one raw feed and merging several cleaned feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave import schema as S
from tillweave.functions import cleaning as C
from tillweave.operators.type_lattice import widened


@dataclass(frozen=True)
class FeedConfig:
    """What differs from one feed to the next.

    `rank` is the feed's place in the merge: where two feeds disagree about a
    shared dimension key, the lower rank wins.
    """

    chain: str
    rank: int
    category_map: Mapping[str, str] = field(default_factory=dict)
    sentinel_year: int | None = None
    suspicious_before: int = 2015
    drop_columns: Sequence[str] = ()
    date_formats: Sequence[str] = ()
    time_format: str = "H:m:s"
    #: Dates outside are nulled and counted in the audit.
    first_date: str = C.FIRST_DATE
    last_date: str = C.LAST_DATE


# The readable labels of the coded flags.
COUPON_LABELS = {"Y": "Yes", "N": "No"}
BINARY_LABELS = {1: "Yes", 0: "No"}


def tag_feed(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Add the chain tag and the feed rank; the reader must have numbered the rows."""
    if S.ROW_ORDINAL not in df.columns:
        raise ValueError(f"feed {cfg.chain} has no {S.ROW_ORDINAL}; read it with read_feed")
    return df.withColumns({"chain": F.lit(cfg.chain), S.FEED_RANK: F.lit(cfg.rank)})


def drop_listed(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    return df.drop(*cfg.drop_columns)


def parse_dates(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    raw = F.col("order_purchase_date")
    if isinstance(df.schema["order_purchase_date"].dataType, T.NumericType):
        parsed = C.serial_date(raw)
    else:
        parsed = C.lenient_date(raw, cfg.date_formats, cfg.first_date, cfg.last_date)
    return df.withColumn("order_purchase_date", parsed)


def null_sentinel_dates(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    clean = C.null_sentinel_year(F.col("order_purchase_date"), cfg.sentinel_year)
    return df.withColumn("order_purchase_date", clean)


def parse_order_number(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    return df.withColumn("order_number", C.lenient_long(F.col("order_number")))


def map_category(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    mapped = C.relabel(F.col("item_category"), cfg.category_map, keep_unmapped=True)
    return df.withColumn("item_category", mapped)


def map_from_table(
    df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str
) -> DataFrame:
    """Relabel through a dictionary table with unique keys; unmapped values stay."""
    lookup = dictionary.select(F.col(key).alias("_from"), F.col(value).alias("_to"))
    joined = df.join(lookup, df[column] == lookup["_from"], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def add_times(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    clock = C.clock_text(F.col("order_purchase_time"), cfg.time_format)
    return df.withColumn("order_purchase_time", clock).withColumn(
        "time_of_day", C.day_half(F.col("order_purchase_time"))
    )


def add_calendar(df: DataFrame, cfg: FeedConfig | None = None) -> DataFrame:
    date = F.col("order_purchase_date")
    return df.withColumns(
        {
            "order_month": F.month(date),
            "order_month_name": C.month_name(date),
            "order_year": F.year(date),
        }
    )


def add_season(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    return df.withColumn("season", C.season_of(F.col("order_month")))


def add_labels(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Readable flags; a code outside the dictionary turns null."""
    return df.withColumns(
        {
            "coupon_used": C.relabel(F.col("coupon_y_n"), COUPON_LABELS, False),
            "alcohol_purchased": C.relabel(F.col("order_alcohol_purchased"), BINARY_LABELS, False),
            "has_children": C.relabel(F.col("customer_with_children"), BINARY_LABELS, False),
            "gender": F.col("gender_customer_payee"),
        }
    )


def lower_profit(df: DataFrame, cfg: FeedConfig) -> DataFrame:
    """One spelling for the profit column, whatever its case in the feed."""
    spelled = next((c for c in df.columns if c.lower() == "profit"), "profit")
    return df.withColumnRenamed(spelled, "profit")


STEPS = (
    tag_feed,
    drop_listed,
    lower_profit,
    parse_dates,
    null_sentinel_dates,
    parse_order_number,
    map_category,
    add_times,
    add_calendar,
    add_season,
    add_labels,
)


def align(df: DataFrame, columns: Sequence[str] = S.LINE_COLUMNS) -> DataFrame:
    """The shared columns that exist, in the shared order, plus the bookkeeping ones."""
    return df.select(*[c for c in (*columns, *S.BOOKKEEPING) if c in df.columns])


def clean_feed(raw: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Raw feed to canonical order lines; Catalyst folds the steps into one projection."""
    return align(reduce(lambda df, step: step(df, cfg), STEPS, raw))


def merge_feeds(feeds: Sequence[DataFrame]) -> DataFrame:
    """Bag union of cleaned feeds; a column one feed lacks is null there.

    A column of several types gets the least type that holds them all.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), widened(feeds))

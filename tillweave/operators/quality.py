"""Data-quality profiles, each in one pass over the table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.operators.cleaning import FeedConfig
from tillweave.functions import cleaning as C


def _long_form(one_row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    """Turn a one-row wide aggregate into (key, value) rows."""
    entries = F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).alias("v")) for n in names])
    others = [c for c in one_row.columns if c not in names]
    exploded = one_row.select(*others, F.explode(entries).alias("_e"))
    return exploded.select(*others, F.col("_e.k").alias(key), F.col("_e.v").alias(value))


def shape(df: DataFrame, stage: str, columns: int | None = None) -> DataFrame:
    """Rows and columns of one stage."""
    width = len(df.columns) if columns is None else columns
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(stage).alias("stage"), "rows", F.lit(width).cast("bigint").alias("columns")
    )


def merged_shapes(merged: DataFrame, columns: int) -> DataFrame:
    """Shape of each cleaned feed and of their union, in one pass over the union."""
    counted = merged.groupingSets([[F.col("chain")], []], "chain").agg(
        F.grouping("chain").alias("_all"), F.count("*").alias("rows")
    )
    stage = F.when(F.col("_all") == 1, F.lit("merged")).otherwise(
        F.concat(F.lit("clean "), F.col("chain"))
    )
    return counted.select(
        stage.alias("stage"), "rows", F.lit(columns).cast("bigint").alias("columns")
    )


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percentage of each column that has any."""
    counted = df.agg(
        F.count("*").alias("_all"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    rows = _long_form(counted, columns, "column_name", "nulls").where(F.col("nulls") > 0)
    percent = percent_of(F.col("nulls"), F.col("_all"))
    return rows.select("column_name", "nulls", percent.alias("null_pct"))


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage with two digits, half to even; null of an empty table."""
    return F.when(whole > 0, F.rint(part / whole * 100 * 100) / 100)


def all_null_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Known values per column, and whether the column holds none."""
    counted = df.agg(*[F.count(F.col(c)).alias(c) for c in columns])
    rows = _long_form(counted, columns, "column_name", "known")
    return rows.withColumn("all_null", (F.col("known") == 0).cast("int"))


def drop_all_null(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Drop the candidate columns that hold no value.  Runs one aggregation."""
    empty = all_null_columns(df, candidates).where(F.col("all_null") == 1)
    return df.drop(*[r.column_name for r in empty.collect()])


def value_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column as rows, so that no column is collected into one cell."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    exploded = df.select(F.explode(entries).alias("_e")).select("_e.*")
    return exploded.groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def date_ranges(df: DataFrame, column: str = "order_purchase_date") -> DataFrame:
    """First and last date and dated rows, per chain and over all, in one pass."""
    ranged = df.groupingSets([[F.col("chain")], []], "chain").agg(
        F.grouping("chain").alias("_all"),
        F.min(column).cast("string").alias("first_date"),
        F.max(column).cast("string").alias("last_date"),
        F.count(column).alias("dated_rows"),
    )
    merged = F.col("_all") == 1
    stage = F.when(merged, F.lit("merged")).otherwise(F.col("chain"))
    return ranged.select(
        stage.alias("stage"), merged.cast("int").alias("is_total"), "first_date", "last_date",
        "dated_rows",
    )


def bad_dates(parsed: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Sentinel-year dates of a feed whose dates are parsed but not yet nulled."""
    hit = F.year("order_purchase_date") == F.lit(cfg.sentinel_year)
    return parsed.agg(F.count_if(hit).alias("bad_dates"), F.count("*").alias("rows")).select(
        F.lit(cfg.chain).alias("chain"),
        "bad_dates",
        "rows",
        percent_of(F.col("bad_dates"), F.col("rows")).alias("bad_pct"),
    )


def suspicious_dates(parsed: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Dates before the year the feed can plausibly start in."""
    early = F.year("order_purchase_date") < F.lit(cfg.suspicious_before)
    return parsed.agg(F.count_if(early).alias("suspicious_dates")).select(
        F.lit(cfg.chain).alias("chain"), "suspicious_dates"
    )


def clean_audit(raw: DataFrame, cfg: FeedConfig) -> DataFrame:
    """What cleaning does to one feed, as (chain, step, metric, value), in one pass."""
    raw_date = F.col("order_purchase_date")
    date = C.lenient_date(raw_date, cfg.date_formats, cfg.first_date, cfg.last_date)
    outside = C.any_date(raw_date, cfg.date_formats).isNotNull() & date.isNull()
    category = F.col("item_category")
    mapped = C.relabel(category, cfg.category_map, keep_unmapped=True)
    clock = C.clock_text(F.col("order_purchase_time"), cfg.time_format)
    bad = F.year(date) == F.lit(cfg.sentinel_year) if cfg.sentinel_year else F.lit(False)

    def lost(raw_col: str, parsed: Column) -> Column:
        return F.col(raw_col).isNotNull() & parsed.isNull()

    metrics: dict[str, tuple[str, Column]] = {
        "rows": ("load", F.count("*")),
        "unparsed_dates": ("dates", F.count_if(lost("order_purchase_date", date) & ~outside)),
        "out_of_range_dates": ("dates", F.count_if(outside)),
        "sentinel_dates": ("dates", F.count_if(bad)),
        "suspicious_dates": ("dates", F.count_if(F.year(date) < F.lit(cfg.suspicious_before))),
        "unparsed_order_numbers": (
            "order_number",
            F.count_if(lost("order_number", C.lenient_long(F.col("order_number")))),
        ),
        "unparsed_times": ("time", F.count_if(lost("order_purchase_time", clock))),
        "relabelled_categories": ("category", F.count_if(mapped != category)),
    }
    for dropped in cfg.drop_columns:
        metrics[f"known_{dropped}"] = ("drop", F.count(F.col(dropped)))
    row = raw.agg(*[m.alias(name) for name, (_, m) in metrics.items()])
    steps = F.create_map(*[F.lit(x) for n, (s, _) in metrics.items() for x in (n, s)])
    long = _long_form(row, list(metrics), "metric", "value")
    return long.select(
        F.lit(cfg.chain).alias("chain"),
        F.element_at(steps, F.col("metric")).alias("step"),
        "metric",
        "value",
    )


# What is done about each kind of finding.
_ACTIONS = {
    "sentinel_dates": "set to null",
    "unparsed_dates": "set to null",
    "out_of_range_dates": "set to null",
    "unparsed_order_numbers": "set to null",
    "unparsed_times": "set to null",
    "relabelled_categories": "relabelled",
    "empty_column": "dropped",
    "untagged_rows": "tagged with chain",
}


def issue_table(feeds: Sequence[tuple[DataFrame, FeedConfig]]) -> DataFrame:
    """(issue, chain, rows, action) for every issue that touches at least one row."""
    actions = F.create_map(*[F.lit(x) for pair in _ACTIONS.items() for x in pair])
    parts = []
    for raw, cfg in feeds:
        audit = clean_audit(raw, cfg)
        total = F.max(F.when(F.col("metric") == "rows", F.col("value")))
        # A dropped column without a known value affects every row of the feed.
        wide = audit.groupBy("chain").agg(
            total.alias("untagged_rows"),
            *[
                F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m)
                for m in _ACTIONS
                if m not in ("empty_column", "untagged_rows")
            ],
            F.max(
                F.when(F.col("metric").startswith("known_") & (F.col("value") == 0), 1)
            ).alias("_empty"),
        )
        wide = wide.withColumn("empty_column", F.when(F.col("_empty") == 1, F.col("untagged_rows")))
        parts.append(_long_form(wide.drop("_empty"), list(_ACTIONS), "issue", "rows"))
    issues = reduce(DataFrame.unionByName, parts).where(F.col("rows") > 0)
    return issues.select("issue", "chain", "rows", F.element_at(actions, F.col("issue")).alias("action"))

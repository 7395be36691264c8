"""Monthly revenue series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillweave.functions import numbers as N

#: Name of the combined series; a chain of that name is refused.
COMBINED = "ALL"


def _named(name: str) -> Column:
    """The chain's name, or an error if the combined series could not be told from it."""
    clash = F.raise_error(F.lit(f"a chain is called {name}; name the combined series otherwise"))
    return F.when(F.col("series") == name, clash).otherwise(F.col("series"))


def monthly_by_chain(
    orders: DataFrame, value: str = "order_total_cost", drop_partial_last_month: bool = False
) -> DataFrame:
    """(series, ds, y) per chain and month start, from dated rows; y stays exact."""
    date = F.col("order_purchase_date")
    dtype = orders.schema[value].dataType
    monthly = (
        orders.where(date.isNotNull())
        .groupBy(F.col("chain").alias("series"), F.trunc(date, "MM").alias("ds"))
        .agg(
            N.exact_sum(F.col(value), dtype).alias("y"),
            F.max(date).alias("_seen"),
        )
    )
    if drop_partial_last_month:
        every = Window.partitionBy("series")
        last = F.col("ds") == F.max("ds").over(every)
        partial = F.col("_seen") < F.last_day("ds")
        monthly = monthly.withColumn("_cut", last & partial).where(~F.col("_cut"))
    return monthly.select("series", "ds", "y")


def combine(by_chain: DataFrame, name: str = COMBINED) -> DataFrame:
    """All chains added up into one series."""
    return by_chain.groupBy("ds").agg(F.sum("y").alias("y")).select(
        F.lit(name).alias("series"), "ds", "y"
    )


def with_combined(by_chain: DataFrame, name: str = COMBINED) -> DataFrame:
    """Every chain's series and the combined one, from one scan of the lines."""
    targets = F.explode(F.array(_named(name), F.lit(name)))
    return (
        by_chain.select(targets.alias("series"), "ds", "y")
        .groupBy("series", "ds")
        .agg(F.sum("y").alias("y"))
    )


def profile(series: DataFrame) -> DataFrame:
    """Months, first and last month, and total in millions of each series."""
    return series.groupBy("series").agg(
        F.count("*").alias("months"),
        F.date_format(F.min("ds"), "MMM yyyy").alias("first_month"),
        F.date_format(F.max("ds"), "MMM yyyy").alias("last_month"),
        (F.sum("y").cast("double") / 1_000_000).alias("total_m"),
    )

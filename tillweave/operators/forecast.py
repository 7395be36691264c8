"""Trend x yearly-season forecast of monthly series, all series in one job.

A decomposable model (trend times seasonal index, after the published
decomposable time-series literature) whose trend may change its slope:

1. the trend is a broken line.  Its possible breaks lie evenly over the earlier
   part of the history; least squares over a constant, time, one hinge per break
   and a few yearly waves gives the slopes, where hinges and waves are shrunk
   towards none.  The waves only keep the season out of the trend;
2. the seasonal index of a calendar month is its mean ratio to the trend,
   scaled so that the available indices average one;
3. the residual's standard deviation gives the interval of the history.  Beyond
   it the trend may break again, as often and as strongly as it did: a break of
   mean square ``v`` that comes ``rate`` times a unit of time adds
   ``rate * v * u**3 / 3`` to the variance after ``u`` units.

A series holds one row per month.  Its normal equations are summed up and solved
by elimination within one row per series, in array expressions; the other steps
are windows over the same shuffle by series.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MULTIPLICATIVE, ADDITIVE = "multiplicative", "additive"

#: Added to the diagonal of the normal equations: a column without values gets no weight.
RIDGE = 1e-12


@dataclass(frozen=True)
class ForecastParams:
    horizon: int = 12
    z: float = 1.959964  # two-sided 95 %
    mode: str = MULTIPLICATIVE
    floor_zero: bool = False
    #: Possible breaks of the trend, the part of the history they lie in, and how they are shrunk.
    changes: int = 8
    change_range: float = 0.8
    change_penalty: float = 0.05
    #: Yearly waves fitted beside the trend; six describe any pattern of twelve months.
    waves: int = 6
    wave_penalty: float = 0.01

    @property
    def breaks(self) -> list[float]:
        """Where the trend may break, as shares of the history."""
        return [self.change_range * (j + 1) / self.changes for j in range(self.changes)]

    @property
    def penalties(self) -> list[float]:
        """What is added to the diagonal of the normal equations, by column."""
        shrunk = [self.change_penalty] * self.changes + [self.wave_penalty] * (2 * self.waves * self.growing)
        return [RIDGE, RIDGE, *[RIDGE + x for x in shrunk]]

    @property
    def growing(self) -> int:
        """How many columns a wave has: a season that multiplies swells with the trend."""
        return 2 if self.mode == MULTIPLICATIVE else 1


def month_number(ds: Column, start: Column) -> Column:
    """Whole months from `start` to `ds`, both first days of a month."""
    return (F.year(ds) - F.year(start)) * 12 + F.month(ds) - F.month(start)


def _trend_columns(time: Column, params: ForecastParams) -> list[Column]:
    """Constant, time and one hinge per possible break; ``time`` is 0 to 1 over the history."""
    hinges = [F.greatest(time - F.lit(c), F.lit(0.0)) for c in params.breaks]
    return [F.lit(1.0), time, *hinges]


def _wave_columns(time: Column, month: Column, params: ForecastParams) -> list[Column]:
    angles = [F.lit(2 * math.pi * (k + 1) / 12) * month for k in range(params.waves)]
    waves = [f(a) for a in angles for f in (F.sin, F.cos)]
    return waves if params.growing == 1 else [*waves, *[w * time for w in waves]]


def _solved(rows: Column, penalties: list[float]) -> Column:
    """Least squares of the last entry of each of ``rows`` on the others, by Gauss-Jordan.

    The matrix is positive definite, so any order of pivots will do.
    """
    size = len(penalties)
    columns = F.sequence(F.lit(0), F.lit(size))
    start = F.transform(
        F.lit(penalties),
        lambda p, i: F.transform(columns, lambda j: F.when(i == j, p).otherwise(0.0)),
    )

    def added(held: Column, row: Column) -> Column:
        return F.transform(
            held, lambda own, i: F.transform(own, lambda v, j: v + F.get(row, i) * F.get(row, j))
        )

    def cleared(held: Column, k: Column) -> Column:
        pivot = F.get(held, k)

        def line(own: Column, i: Column) -> Column:
            share = F.when(i == k, 1 - 1 / F.get(pivot, k)).otherwise(F.get(own, k) / F.get(pivot, k))
            return F.transform(own, lambda v, j: v - share * F.get(pivot, j))

        return F.transform(held, line)

    normal = F.aggregate(rows, start, added)
    done = F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), normal, cleared)
    return F.transform(done, lambda own: F.get(own, F.lit(size)))


def trend_at(time: Column, weights: Column, params: ForecastParams) -> Column:
    """The broken line at ``time``, in units of the scale."""
    parts = [x * F.get(weights, F.lit(i)) for i, x in enumerate(_trend_columns(time, params))]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total


def broken_trend(series: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """The rows of ``series`` with start, last, span, scale, t and the weights of the trend.

    A series of one month, or of zeros, has a flat trend.  The rows of a series
    are its months, so they fit in one row while they are solved for.
    """
    whole = series.groupBy("series").agg(
        F.sort_array(F.collect_list(F.struct("ds", F.col("y").cast("double").alias("y")))).alias("rows"),
        F.min("ds").alias("start"),
        F.max("ds").alias("last"),
    )
    largest = F.array_max(F.transform("rows", lambda r: F.abs(r["y"])))
    placed = whole.withColumn(
        "span", F.greatest(month_number(F.col("last"), F.col("start")), F.lit(1)).cast("double")
    ).withColumn("scale", F.when(largest > 0, largest).otherwise(1.0))

    def design(row: Column) -> Column:
        time = month_number(row["ds"], F.col("start")) / F.col("span")
        waves = _wave_columns(time, F.month(row["ds"]), params)
        return F.array(*_trend_columns(time, params), *waves, row["y"] / F.col("scale"))

    # One month says nothing of slopes or seasons.
    flat = F.array(
        F.get("rows", F.lit(0))["y"] / F.col("scale"), *[F.lit(0.0)] * (len(params.penalties) - 1)
    )
    weights = F.when(F.size("rows") == 1, flat).otherwise(
        _solved(F.transform("rows", design), params.penalties)
    )
    return (
        placed.withColumn("weights", weights)
        .select("series", "start", "last", "span", "scale", "weights", F.inline("rows"))
        .withColumn("month", F.month("ds"))
        .withColumn("t", month_number(F.col("ds"), F.col("start")))
    )


def decompose(series: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """History with trend, seasonal and residual, and the trend's weights on every row."""
    whole = Window.partitionBy("series")
    same_month = Window.partitionBy("series", "month")
    y = F.col("y")
    trended = broken_trend(series, params).withColumn(
        "trend", F.col("scale") * trend_at(F.col("t") / F.col("span"), F.col("weights"), params)
    )
    if params.mode == ADDITIVE:
        effect, neutral = y - F.col("trend"), F.lit(0.0)
    else:
        effect, neutral = F.when(F.col("trend") > 0, y / F.col("trend")), F.lit(1.0)
    indexed = trended.withColumn("_effect", effect).withColumn(
        "_raw", F.avg("_effect").over(same_month)
    )
    # Each calendar month counts once in the scaling, however often it occurs.
    once = F.when(F.row_number().over(same_month.orderBy("ds")) == 1, F.col("_raw"))
    centred = indexed.withColumn("_once", once).withColumn("_norm", F.avg("_once").over(whole))
    if params.mode == ADDITIVE:
        seasonal = F.col("_raw") - F.col("_norm")
        fitted = F.col("trend") + F.col("seasonal")
    else:
        seasonal = F.col("_raw") / F.col("_norm")
        fitted = F.col("trend") * F.col("seasonal")
    return (
        centred.withColumn("seasonal", F.coalesce(seasonal, neutral))
        .withColumn("residual", y - fitted)
        .drop("_effect", "_raw", "_once", "_norm")
    )


def fit(components: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """One row per series: trend, spread, seasonal index and the history by month.

    ``intercept`` is the trend at the start, ``first_slope`` and ``slope`` are
    its slopes a month at the start and at the end, ``change`` is the root mean
    square of the changes between.  Both maps are bounded by the months of a
    series.
    """
    season = F.map_from_entries(F.collect_set(F.struct("month", "seasonal")))
    history = F.map_from_entries(F.collect_list(F.struct("ds", "y")))
    kept = ("start", "last", "span", "scale", "weights")
    model = components.groupBy("series").agg(
        *[F.first(c).alias(c) for c in kept],
        F.count("*").alias("months"),
        F.coalesce(F.stddev_samp("residual"), F.lit(0.0)).alias("sigma"),
        season.alias("season"),
        history.alias("history"),
    )
    per_month = F.col("scale") / F.col("span")
    first = F.get("weights", F.lit(1))
    steps = F.slice("weights", 3, params.changes) if params.changes else F.array().cast("array<double>")
    total = F.aggregate(steps, F.lit(0.0), lambda held, v: held + v)
    square = F.aggregate(steps, F.lit(0.0), lambda held, v: held + v * v) / max(params.changes, 1)
    return model.withColumns(
        {
            "intercept": F.col("scale") * F.get("weights", F.lit(0)),
            "first_slope": per_month * first,
            "slope": per_month * (first + total),
            "change": per_month * F.sqrt(square),
        }
    )


def future_frame(model: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """Every month from the first of the history to the end of the horizon."""
    end = F.add_months("last", params.horizon)
    months = F.sequence("start", end, F.make_interval(months=F.lit(1)))
    return model.withColumn("ds", F.explode(months)).withColumn(
        "is_future", F.col("ds") > F.col("last")
    )


def predict(model: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """Observed y, trend, seasonal, yhat and bounds per month; pure column arithmetic."""
    t = month_number(F.col("ds"), F.col("start")) / F.col("span")
    trend = F.col("scale") * trend_at(t, F.col("weights"), params)
    additive = params.mode == ADDITIVE
    neutral = F.lit(0.0 if additive else 1.0)
    seasonal = F.coalesce(F.try_element_at("season", F.month("ds")), neutral)
    yhat = F.col("trend") + F.col("seasonal") if additive else F.col("trend") * F.col("seasonal")
    if params.floor_zero:
        yhat = F.greatest(yhat, F.lit(0.0))
    # Months beyond the history, and the breaks a month that it had.
    beyond = F.greatest(month_number(F.col("ds"), F.col("last")), F.lit(0)).cast("double")
    rate = F.lit(params.changes / params.change_range) / F.col("span")
    drift = rate * F.col("change") * F.col("change") * beyond * beyond * beyond / 3
    if not additive:
        drift = drift * F.col("seasonal") * F.col("seasonal")
    margin = F.lit(params.z) * F.sqrt(F.col("sigma") * F.col("sigma") + drift)
    lower = F.col("yhat") - margin
    if params.floor_zero:
        lower = F.greatest(lower, F.lit(0.0))
    return (
        future_frame(model, params)
        .withColumn("trend", trend)
        .withColumn("seasonal", seasonal)
        .withColumn("yhat", yhat)
        .select(
            "series", "ds", "is_future",
            F.try_element_at("history", F.col("ds")).alias("y"),
            "trend", "seasonal", "yhat",
            lower.alias("lower"), (F.col("yhat") + margin).alias("upper"),
        )
    )


def forecast(series: DataFrame, params: ForecastParams = ForecastParams()) -> DataFrame:
    """Fit and predict every series."""
    return predict(fit(decompose(series, params), params), params)


def future_only(prediction: DataFrame) -> DataFrame:
    return prediction.where("is_future").drop("is_future", "y")


def summary(prediction: DataFrame, digits: int = 2) -> DataFrame:
    """Month label, forecast and bounds in millions, and the two interval arms."""

    def millions(col: str) -> Column:
        factor = float(10**digits)
        return F.rint(F.col(col) / 1_000_000 * factor) / factor

    table = future_only(prediction).select(
        "series",
        F.col("ds").alias("month_start"),
        F.date_format("ds", "MMMM yyyy").alias("month"),
        millions("yhat").alias("forecast_m"),
        millions("lower").alias("lower_m"),
        millions("upper").alias("upper_m"),
    )
    return table.withColumns(
        {
            "arm_below_m": F.col("forecast_m") - F.col("lower_m"),
            "arm_above_m": F.col("upper_m") - F.col("forecast_m"),
        }
    )


def horizon_total(table: DataFrame) -> DataFrame:
    """Sum of the rounded monthly forecasts of each series."""
    cents = F.sum(F.col("forecast_m").cast("decimal(18,2)"))
    return table.groupBy("series").agg(
        F.count("*").alias("months"), cents.cast("double").alias("total_forecast_m")
    )


def long_frame(prediction: DataFrame) -> DataFrame:
    """History and forecast as (series, label, ds, value, lower, upper)."""
    future = F.col("is_future")
    return prediction.where(future | F.col("y").isNotNull()).select(
        "series",
        F.when(future, F.lit("forecast")).otherwise(F.lit("history")).alias("label"),
        "ds",
        F.when(future, F.col("yhat")).otherwise(F.col("y")).alias("value"),
        F.when(future, F.col("lower")).alias("lower"),
        F.when(future, F.col("upper")).alias("upper"),
    )

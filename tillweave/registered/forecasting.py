"""Monthly series and their forecast, over the projected dataset."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.functions.numbers import plus_zero
from tillweave.operators import forecast as Fc
from tillweave.operators import series as Sr
from tillweave.registered import base as R
from tillweave.registered.base import registered
from tillweave.session import scratch_path
from tillweave.sources import feeds as Feeds

_MODEL = Fc.ForecastParams()

_SERIES_SQL = """,
by_chain AS (
  SELECT chain AS series, CAST(date_trunc('month', order_purchase_date) AS DATE) AS ds,
         SUM(order_total_cost) AS y
  FROM scen WHERE order_purchase_date IS NOT NULL
  GROUP BY chain, CAST(date_trunc('month', order_purchase_date) AS DATE)
),
combined AS (SELECT 'ALL' AS series, ds, SUM(y) AS y FROM by_chain GROUP BY ds),
every_series AS (SELECT * FROM by_chain UNION ALL SELECT * FROM combined)
"""

_CHANGES = _MODEL.changes
_SIZE = len(_MODEL.penalties)
_PENALTIES = f"[{', '.join(f'{p!r}::DOUBLE' for p in _MODEL.penalties)}]"
_HINGES = [f"greatest({{time}} - {c!r}, 0.0)" for c in _MODEL.breaks]
_WAVES = [
    f"{f}({2 * math.pi * (k + 1) / 12!r} * timed.m)" for k in range(_MODEL.waves) for f in ("sin", "cos")
]
# The season multiplies, so its waves may grow with time.
_WAVES += [f"{w} * (timed.t / span)" for w in _WAVES]
_DESIGN_SQL = "[" + ", ".join(
    ["1.0::DOUBLE", "timed.t / span", *[h.format(time="timed.t / span") for h in _HINGES], *_WAVES, "y / scale"]
) + "]"


def _trend_sql(time: str) -> str:
    hinges = [f"{h.format(time=time)} * l.w[{i + 3}]" for i, h in enumerate(_HINGES)]
    return f"l.scale * (l.w[1] + {time} * l.w[2] + {' + '.join(hinges)})"


# One column is cleared after the other.
_ELIMINATION_SQL = "cleared_0 AS (SELECT * FROM normal),\n" + "\n".join(
    f"""cleared_{k} AS (
  SELECT series, list_transform(m, lambda own, i: CASE WHEN i = {k}
    THEN list_transform(own, lambda v: v / m[{k}][{k}])
    ELSE list_transform(own, lambda v, j: v - own[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m
  FROM cleared_{k - 1}),"""
    for k in range(1, _SIZE + 1)
)

_MODEL_SQL = _SERIES_SQL.rstrip() + f""",
timed AS (
  SELECT e.series, e.ds, CAST(e.y AS DOUBLE) AS y, b.start, b.last, month(e.ds) AS m,
         date_diff('month', b.start, e.ds) AS t
  FROM every_series e
  JOIN (SELECT series, MIN(ds) AS start, MAX(ds) AS last FROM every_series GROUP BY series) b
    ON b.series = e.series
),
line AS (
  SELECT series, start, last, COUNT(*) AS months, SUM(y) AS total,
         CAST(greatest(date_diff('month', start, last), 1) AS DOUBLE) AS span,
         CASE WHEN MAX(abs(y)) > 0 THEN MAX(abs(y)) ELSE 1.0 END AS scale
  FROM timed GROUP BY series, start, last
),
design AS (
  SELECT timed.series, {_DESIGN_SQL} AS x FROM timed JOIN line ON line.series = timed.series
),
normal AS (
  SELECT series, list(line ORDER BY i) AS m FROM (
    SELECT series, i, list(v ORDER BY j) AS line FROM (
      SELECT series, i, j,
             SUM(x[i] * x[j]) + CASE WHEN i = j THEN any_value({_PENALTIES}[i]) ELSE 0 END AS v
      FROM design, range(1, {_SIZE + 1}) a(i), range(1, {_SIZE + 2}) b(j) GROUP BY series, i, j)
    GROUP BY series, i)
  GROUP BY series
),
{_ELIMINATION_SQL}
weighed AS (
  SELECT line.*, CASE WHEN months = 1 THEN list_prepend(total / scale, list_resize([]::DOUBLE[], {_SIZE - 1}, 0.0))
         ELSE list_transform(m, lambda own: own[{_SIZE + 1}]) END AS w
  FROM line JOIN cleared_{_SIZE} c ON c.series = line.series
),
trended AS (
  SELECT t.*, {_trend_sql("t.t / l.span")} AS trend FROM timed t JOIN weighed l ON l.series = t.series
),
raw_index AS (
  SELECT series, m, AVG(CASE WHEN trend > 0 THEN y / trend END) AS raw
  FROM trended GROUP BY series, m
),
season AS (
  SELECT series, m, COALESCE(raw / AVG(raw) OVER (PARTITION BY series), 1.0) AS s FROM raw_index
),
parts AS (
  SELECT t.*, s.s AS seasonal, t.y - t.trend * s.s AS residual
  FROM trended t JOIN season s ON s.series = t.series AND s.m = t.m
),
spread AS (SELECT series, stddev_samp(residual) AS sigma FROM parts GROUP BY series),
model AS (
  SELECT l.*, spread.sigma, l.scale * l.w[1] AS intercept, l.scale / l.span * l.w[2] AS first_slope,
         l.scale / l.span * list_sum(l.w[2:{_CHANGES + 2}]) AS slope,
         l.scale / l.span
           * sqrt(list_sum(list_transform(l.w[3:{_CHANGES + 2}], lambda v: v * v)) / {_CHANGES}) AS change
  FROM weighed l JOIN spread ON spread.series = l.series
),
horizon AS (
  SELECT series, CAST(ds AS DATE) AS ds, CAST(ds AS DATE) > last AS is_future
  FROM (SELECT series, last,
               UNNEST(generate_series(start, CAST(last + INTERVAL 12 MONTH AS DATE),
                                      INTERVAL 1 MONTH)) AS ds
        FROM model)
),
projected AS (
  SELECT h.series, h.ds, h.is_future, l.sigma, l.change, l.span, COALESCE(s.s, 1.0) AS seasonal,
         greatest(date_diff('month', l.last, h.ds), 0) AS beyond,
         {_trend_sql("date_diff('month', l.start, h.ds) / l.span")} AS trend
  FROM horizon h JOIN model l ON l.series = h.series
  LEFT JOIN season s ON s.series = h.series AND s.m = month(h.ds)
),
predicted AS (
  SELECT series, ds, is_future, trend, seasonal, trend * seasonal AS yhat,
         1.959964 * sqrt(sigma * sigma + {_CHANGES} / {_MODEL.change_range} / span
           * change * change * beyond ** 3 / 3 * seasonal * seasonal) AS margin
  FROM projected
)
"""

_ISO = "strftime(ds, '%Y-%m-%d') AS ds"


def _sql_m(expr: str, digits: int = 4) -> str:
    return f"ROUND(({expr}) / 1000000, {digits}) + 0.0"


def _m(col: str, digits: int = 4) -> Column:
    """Millions with four digits; the last bits of a fit depend on summation order."""
    return plus_zero(F.round(F.col(col) / 1_000_000, digits))


def _by_chain(spark, sf_dir):
    columns = ["chain", "order_purchase_date", "order_total_cost"]
    return Sr.monthly_by_chain(R.dataset(spark, sf_dir, columns, projected=True).orders)


def _every(spark, sf_dir):
    return Sr.with_combined(_by_chain(spark, sf_dir))


def _components(spark, sf_dir):
    return Fc.decompose(_every(spark, sf_dir), _MODEL)


@registered(
    "series_by_chain", _SERIES_SQL + f"SELECT series, {_ISO}, CAST(y AS DOUBLE) AS y FROM by_chain"
)
def series_by_chain(spark, sf_dir):
    return R.iso_dates(_by_chain(spark, sf_dir).orderBy("ds", "series"))


@registered(
    "series_combined", _SERIES_SQL + f"SELECT series, {_ISO}, CAST(y AS DOUBLE) AS y FROM combined"
)
def series_combined(spark, sf_dir):
    return R.iso_dates(Sr.combine(_by_chain(spark, sf_dir)).orderBy("ds"))


@registered(
    "series_profile",
    _SERIES_SQL + """SELECT series, COUNT(*) AS months, strftime(MIN(ds), '%b %Y') AS first_month,
       strftime(MAX(ds), '%b %Y') AS last_month, CAST(SUM(y) AS DOUBLE) / 1000000 AS total_m
       FROM every_series GROUP BY series""",
)
def series_profile(spark, sf_dir):
    return Sr.profile(_every(spark, sf_dir))


@registered(
    "forecast_fit",
    _MODEL_SQL + f"""SELECT series, months, strftime(start, '%Y-%m-%d') AS start,
       strftime(last, '%Y-%m-%d') AS last, {_sql_m("slope")} AS slope_m,
       {_sql_m("intercept")} AS intercept_m, {_sql_m("sigma")} AS sigma_m,
       {_sql_m("first_slope")} AS first_slope_m, {_sql_m("change")} AS change_m FROM model""",
)
def forecast_fit(spark, sf_dir):
    model = Fc.fit(_components(spark, sf_dir), _MODEL)
    return R.iso_dates(
        model.select(
            "series", "months", "start", "last", _m("slope").alias("slope_m"),
            _m("intercept").alias("intercept_m"), _m("sigma").alias("sigma_m"),
            _m("first_slope").alias("first_slope_m"), _m("change").alias("change_m"),
        )
    )


@registered(
    "forecast_horizon",
    _MODEL_SQL + f"SELECT series, {_ISO}, CAST(is_future AS INTEGER) AS is_future FROM horizon",
)
def forecast_horizon(spark, sf_dir):
    frame = Fc.future_frame(Fc.fit(_components(spark, sf_dir), _MODEL), _MODEL)
    return R.iso_dates(frame.select("series", "ds", F.col("is_future").cast("int")))


_BOUNDS_SQL = (
    f"{_sql_m('yhat')} AS yhat_m, {_sql_m('yhat - margin')} AS lower_m,"
    f" {_sql_m('yhat + margin')} AS upper_m"
)


def _bounds():
    return [_m("yhat").alias("yhat_m"), _m("lower").alias("lower_m"), _m("upper").alias("upper_m")]


def _prediction(spark, sf_dir):
    return Fc.predict(Fc.fit(_components(spark, sf_dir), _MODEL), _MODEL)


@registered("forecast_predict", _MODEL_SQL + f"SELECT series, {_ISO}, {_BOUNDS_SQL} FROM predicted")
def forecast_predict(spark, sf_dir):
    return R.iso_dates(_prediction(spark, sf_dir).select("series", "ds", *_bounds()))


@registered(
    "forecast_future",
    _MODEL_SQL + f"SELECT series, {_ISO}, {_BOUNDS_SQL} FROM predicted WHERE is_future",
)
def forecast_future(spark, sf_dir):
    future = Fc.future_only(_prediction(spark, sf_dir))
    return R.iso_dates(future.select("series", "ds", *_bounds()))


@registered(
    "forecast_components",
    _MODEL_SQL + f"""SELECT p.series, strftime(p.ds, '%Y-%m-%d') AS ds,
       CAST(p.is_future AS INTEGER) AS is_future, {_sql_m("p.trend")} AS trend_m,
       ROUND(p.seasonal, 6) + 0.0 AS seasonal, {_sql_m("t.y - p.yhat")} AS residual_m
       FROM predicted p LEFT JOIN timed t ON t.series = p.series AND t.ds = p.ds""",
)
def forecast_components(spark, sf_dir):
    """Trend and season over history and horizon, and what the history leaves over."""
    parts = _prediction(spark, sf_dir).withColumn("residual", F.col("y") - F.col("yhat"))
    return R.iso_dates(
        parts.select(
            "series", "ds", F.col("is_future").cast("int").alias("is_future"),
            _m("trend").alias("trend_m"), plus_zero(F.round("seasonal", 6)).alias("seasonal"),
            _m("residual").alias("residual_m"),
        )
    )


@registered(
    "forecast_by_chain",
    _MODEL_SQL + f"""SELECT series, {_ISO}, {_BOUNDS_SQL} FROM predicted
       WHERE is_future AND series <> 'ALL'""",
)
def forecast_by_chain(spark, sf_dir):
    """Independent forecasts, one per chain, in one job."""
    future = Fc.future_only(Fc.forecast(_by_chain(spark, sf_dir), _MODEL))
    return R.iso_dates(future.select("series", "ds", *_bounds()))


def _even_m(expr: str) -> str:
    return f"round_even(({expr}) / 1000000 * 100, 0) / 100"


_SUMMARY_SQL = f"""SELECT series, strftime(ds, '%Y-%m-%d') AS month_start,
       strftime(ds, '%B %Y') AS month, {_even_m("yhat")} AS forecast_m,
       {_even_m("yhat - margin")} AS lower_m, {_even_m("yhat + margin")} AS upper_m
       FROM predicted WHERE is_future"""


@registered(
    "forecast_summary",
    _MODEL_SQL + f"""SELECT *, forecast_m - lower_m AS arm_below_m,
       upper_m - forecast_m AS arm_above_m FROM ({_SUMMARY_SQL})""",
)
def forecast_summary(spark, sf_dir):
    return R.iso_dates(Fc.summary(_prediction(spark, sf_dir)))


@registered(
    "forecast_total",
    _MODEL_SQL + f"""SELECT series, COUNT(*) AS months,
       CAST(SUM(CAST(forecast_m AS DECIMAL(18,2))) AS DOUBLE) AS total_forecast_m
       FROM ({_SUMMARY_SQL}) GROUP BY series""",
)
def forecast_total(spark, sf_dir):
    """The horizon's total, read back from the stored summary file."""
    table = Fc.summary(_prediction(spark, sf_dir))
    path = scratch_path(spark, "forecast-csv")
    Feeds.write_csv(table.select(*S.FORECAST_SUMMARY.names), path)
    return Fc.horizon_total(Feeds.read_optional_csv(spark, path, S.FORECAST_SUMMARY))


@registered(
    "forecast_long",
    _MODEL_SQL + f"""SELECT series, 'history' AS label, {_ISO}, {_sql_m("y")} AS value_m
       FROM timed
       UNION ALL
       SELECT series, 'forecast', {_ISO}, {_sql_m("yhat")} FROM predicted WHERE is_future""",
)
def forecast_long(spark, sf_dir):
    frame = Fc.long_frame(_prediction(spark, sf_dir))
    return R.iso_dates(frame.select("series", "label", "ds", _m("value").alias("value_m")))

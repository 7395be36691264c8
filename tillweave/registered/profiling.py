"""Data-quality profiles of the feeds and of the merged lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave import schema as S
from tillweave.functions import numbers as N
from tillweave.operators import cleaning as Clean
from tillweave.operators import quality as Q
from tillweave.registered import base as R
from tillweave.registered.base import registered
from tillweave.sources import sample_tables as B


def _union(parts):
    return reduce(DataFrame.unionByName, parts)


@registered(
    "profile_shape",
    """SELECT 'raw F' AS stage, COUNT(*) AS rows, CAST(22 AS BIGINT) AS columns
       FROM lineitem WHERE l_linestatus = 'F'
       UNION ALL SELECT 'raw O', COUNT(*), 23 FROM lineitem WHERE l_linestatus = 'O'
       UNION ALL SELECT 'clean F', COUNT(*), 28 FROM lines WHERE chain = 'F'
       UNION ALL SELECT 'clean O', COUNT(*), 28 FROM lines WHERE chain = 'O'
       UNION ALL SELECT 'merged', COUNT(*), 28 FROM lines""",
)
def profile_shape(spark, sf_dir):
    """Shapes of the raw, cleaned and merged stages."""
    parts = []
    for cfg in B.FEEDS:
        width = len(B.raw_feed(spark, sf_dir, cfg).drop(S.ROW_ORDINAL).columns)
        # Counting needs one column; asking for one spares the feed's joins.
        narrow = B.raw_feed(spark, sf_dir, cfg, [S.ROW_ORDINAL])
        parts.append(Q.shape(narrow, f"raw {cfg.chain}", width))
    merged = R.lines(spark, sf_dir, ["chain"])
    return _union([*parts, Q.merged_shapes(merged, len(S.LINE_COLUMNS))])


def _null_sql(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, COUNT(*) - COUNT({column}) AS nulls,
         round_even(CAST(COUNT(*) - COUNT({column}) AS DOUBLE) / COUNT(*) * 100 * 100, 0) / 100
           AS null_pct FROM lines"""


@registered(
    "profile_nulls",
    "SELECT * FROM (" + " UNION ALL ".join(_null_sql(c) for c in S.LINE_COLUMNS)
    + ") WHERE nulls > 0",
)
def profile_nulls(spark, sf_dir):
    return Q.null_profile(R.lines(spark, sf_dir, S.LINE_COLUMNS), S.LINE_COLUMNS)


_PROFILED = ["chain", "item_category", "season", "order_purchase_method", "gender", "has_children",
             "coupon_used", "alcohol_purchased", "time_of_day"]


@registered(
    "profile_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {c} AS value, COUNT(*) AS rows FROM lines GROUP BY {c}"
        for c in _PROFILED
    ),
)
def profile_values(spark, sf_dir):
    return Q.value_profile(R.lines(spark, sf_dir, _PROFILED), _PROFILED)


def _range_sql(stage: str, total: int, where: str) -> str:
    return f"""SELECT '{stage}' AS stage, {total} AS is_total, strftime(MIN(order_purchase_date), '%Y-%m-%d')
         AS first_date, strftime(MAX(order_purchase_date), '%Y-%m-%d') AS last_date,
         COUNT(order_purchase_date) AS dated_rows FROM lines {where}"""


@registered(
    "profile_dates",
    " UNION ALL ".join(
        [_range_sql("merged", 1, ""), _range_sql("F", 0, "WHERE chain = 'F'"),
         _range_sql("O", 0, "WHERE chain = 'O'")]
    ),
)
def profile_dates(spark, sf_dir):
    lines = R.lines(spark, sf_dir, ["chain", "order_purchase_date"])
    return Q.date_ranges(lines)


_RAW_DATES = """(SELECT l.l_linestatus AS chain,
    CASE WHEN o.o_orderkey % 97 <> 0 THEN CAST(o.o_orderdate AS DATE) END AS day
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey)"""


def _parsed(spark, sf_dir, cfg):
    return Clean.parse_dates(B.raw_feed(spark, sf_dir, cfg, ["order_purchase_date"]), cfg)


@registered(
    "profile_bad_dates",
    f"""SELECT chain, bad_dates, rows,
          round_even(CAST(bad_dates AS DOUBLE) / rows * 100 * 100, 0) / 100 AS bad_pct
        FROM (SELECT chain, COUNT(CASE WHEN year(day) = 1995 THEN 1 END) AS bad_dates,
                     COUNT(*) AS rows FROM {_RAW_DATES} GROUP BY chain)""",
)
def profile_bad_dates(spark, sf_dir):
    return _union([Q.bad_dates(_parsed(spark, sf_dir, cfg), cfg) for cfg in B.FEEDS])


@registered(
    "profile_suspicious_dates",
    f"""SELECT chain, COUNT(CASE WHEN year(day) < 1997 THEN 1 END) AS suspicious_dates
        FROM {_RAW_DATES} GROUP BY chain""",
)
def profile_suspicious_dates(spark, sf_dir):
    return _union([Q.suspicious_dates(_parsed(spark, sf_dir, cfg), cfg) for cfg in B.FEEDS])


_AUDITED = ["order_purchase_date", "order_number", "order_purchase_time", "item_category"]

# Counts that cleaning reports, per chain; the dictionaries differ by chain.
_COUNTS_SQL = """(SELECT l.l_linestatus AS chain, COUNT(*) AS n,
    COUNT(CASE WHEN o.o_orderkey % 97 = 0 THEN 1 END) AS no_date,
    COUNT(CASE WHEN o.o_orderkey % 97 <> 0 AND year(o_orderdate) = 1995 THEN 1 END) AS sentinel,
    COUNT(CASE WHEN o.o_orderkey % 97 <> 0 AND year(o_orderdate) < 1997 THEN 1 END) AS early,
    COUNT(CASE WHEN l.l_linestatus = 'F' AND l.l_orderkey % 50 = 0 THEN 1 END) AS no_number,
    COUNT(CASE WHEN l.l_orderkey % 50 = 1 THEN 1 END) AS no_time,
    COUNT(CASE WHEN p.p_type IN ('ECONOMY', 'SMALL')
            OR (p.p_type = 'LARGE' AND l.l_linestatus = 'F')
            OR (p.p_type = 'PROMO' AND l.l_linestatus = 'O') THEN 1 END) AS relabelled
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey GROUP BY l.l_linestatus)"""


@registered(
    "clean_audit",
    " UNION ALL ".join(
        f"SELECT chain, '{step}' AS step, '{metric}' AS metric, {column} AS value FROM {_COUNTS_SQL}"
        for step, metric, column in (
            ("load", "rows", "n"),
            ("dates", "unparsed_dates", "no_date"),
            ("dates", "out_of_range_dates", "CAST(0 AS BIGINT)"),
            ("dates", "sentinel_dates", "sentinel"),
            ("dates", "suspicious_dates", "early"),
            ("order_number", "unparsed_order_numbers", "no_number"),
            ("time", "unparsed_times", "no_time"),
            ("category", "relabelled_categories", "relabelled"),
        )
    )
    + " UNION ALL SELECT 'O', 'drop', 'known_item_product_cost', CAST(0 AS BIGINT)",
)
def clean_audit(spark, sf_dir):
    """What cleaning finds in each feed, appended to a table by whoever keeps the log."""
    audits = [
        Q.clean_audit(B.raw_feed(spark, sf_dir, cfg, [*_AUDITED, *cfg.drop_columns]), cfg)
        for cfg in B.FEEDS
    ]
    return _union(audits)


@registered(
    "profile_issues",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{issue}' AS issue, chain, {column} AS rows, '{action}' AS action FROM {_COUNTS_SQL}"
        for issue, column, action in (
            ("sentinel_dates", "sentinel", "set to null"),
            ("unparsed_dates", "no_date", "set to null"),
            ("unparsed_order_numbers", "no_number", "set to null"),
            ("unparsed_times", "no_time", "set to null"),
            ("relabelled_categories", "relabelled", "relabelled"),
            ("untagged_rows", "n", "tagged with chain"),
        )
    )
    + f" UNION ALL SELECT 'empty_column', chain, n, 'dropped' FROM {_COUNTS_SQL} WHERE chain = 'O'"
    + ") WHERE rows > 0",
)
def profile_issues(spark, sf_dir):
    feeds = [
        (B.raw_feed(spark, sf_dir, cfg, [*_AUDITED, *cfg.drop_columns]), cfg) for cfg in B.FEEDS
    ]
    return Q.issue_table(feeds)


@registered(
    "table_headings",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS place, '{c}' AS column_name,"
        f" '{' '.join(w[0].upper() + w[1:] for w in c.split('_'))}' AS heading,"
        f" COUNT({c}) AS known FROM lines"
        for i, c in enumerate(S.LINE_COLUMNS)
    )
    + ")",
)
def table_headings(spark, sf_dir):
    """Every column of the lines under the heading a table shows, with its known values."""
    lines = R.lines(spark, sf_dir, S.LINE_COLUMNS)
    known = Q.all_null_columns(lines, S.LINE_COLUMNS).select("column_name", "known")
    names = F.create_map(*[F.lit(x) for c in S.LINE_COLUMNS for x in (c, N.heading(c))])
    places = F.create_map(*[F.lit(x) for i, c in enumerate(S.LINE_COLUMNS) for x in (c, i)])
    name = F.col("column_name")
    return known.select(
        F.element_at(places, name).alias("place"),
        "column_name",
        F.element_at(names, name).alias("heading"),
        "known",
    )

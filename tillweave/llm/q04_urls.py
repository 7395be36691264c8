"""op4: every page's url judged by rules and by the weighted vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.tables import read
from tillweave.llm.url_vocabulary import RULES, VOCABULARY, judged

_FITS = " UNION ALL ".join(
    f"SELECT '{r.verdict}' AS rule_verdict, '{r.host}' AS rule_host, '{r.path}' AS rule_path"
    for r in RULES
)
_TERMS = " UNION ALL ".join(
    f"SELECT '{term}' AS term, {weight}::DOUBLE AS weight" for term, weight in VOCABULARY.items()
)
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL = f"""
WITH rules AS ({_FITS}),
vocabulary AS ({_TERMS}),
parts AS (
  SELECT page_id, coalesce({_LOWER.format("url")}, '') AS lowered,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
urls AS (
  SELECT row_number() OVER () AS row_id, page_id, lowered,
    {_LOWER.format("regexp_extract(rest, '^[^/?#]*', 0)")} AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
fitting AS (
  SELECT row_id, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY row_id
      ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM urls JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
weighed AS (
  SELECT row_id, sum(weight) AS weight
  FROM urls JOIN vocabulary
    ON regexp_matches(lowered, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)')
  GROUP BY row_id)
SELECT u.page_id, u.host, u.path, f.rule,
  coalesce(f.rule_verdict, CASE WHEN w.weight >= 1 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(w.weight, 0)::DOUBLE AS weight
FROM urls u
LEFT JOIN fitting f ON u.row_id = f.row_id AND f.place = 1
LEFT JOIN weighed w ON u.row_id = w.row_id
"""


@registered("op4_url_filter", _SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", ["page_id", "url"])
    return judged(pages).select("page_id", "host", "path", "rule", "verdict", F.col("weight"))

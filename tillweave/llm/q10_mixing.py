"""op10: all documents mixed to target weights by hash thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.mixing import copies_taken
from tillweave.llm.tables import read

_SQL = """
WITH RECURSIVE sized AS (
  SELECT doc_id, source,
    CASE WHEN text IS NULL THEN 0
      ELSE len(list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) END
      AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N') || '|'
      || coalesce(source, '\\N')), 1, 15) AS BIGINT) AS hash
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size,
    CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
      WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight
  FROM sources),
-- Deal what is left by weight to the sources that are below their bound, again and again.
rounds AS (
  SELECT 0 AS n, source, source_size, weight, 0.0::DOUBLE AS got,
    (SELECT 1.5 * sum(source_size) FROM weighed)::DOUBLE AS rest
  FROM weighed
  UNION ALL
  SELECT n + 1, source, source_size, weight, dealt,
    (sum(rest) OVER () / count(*) OVER ()) - sum(dealt - got) OVER ()
  FROM (
    SELECT *, least(2.0 * source_size, got + CASE WHEN got < 2.0 * source_size
      THEN rest * weight / sum(CASE WHEN got < 2.0 * source_size THEN weight END) OVER ()
      ELSE 0 END) AS dealt
    FROM rounds WHERE n < 60)),
targets AS (
  SELECT source, source_size, got AS target,
    CASE WHEN source_size > 0 THEN floor(got / source_size) ELSE 0 END AS whole
  FROM rounds WHERE n = 60),
hashes AS (
  SELECT source, hash, sum(size) AS words FROM sized GROUP BY source, hash),
running AS (
  SELECT h.source, h.hash, t.target - t.whole * t.source_size AS budget, words,
    sum(words) OVER (PARTITION BY h.source ORDER BY hash) AS through
  FROM hashes h JOIN targets t ON h.source IS NOT DISTINCT FROM t.source),
more AS (
  SELECT source, hash,
    CASE WHEN budget <= 0 THEN FALSE
      WHEN through <= budget THEN TRUE
      WHEN through - words > budget THEN FALSE
      ELSE through - budget < budget - (through - words)
        AND words > 0 END AS extra
  FROM running)
SELECT s.doc_id, s.size, t.source_size, round(t.target, 6) AS target,
  CAST(s.size * (t.whole + CAST(m.extra AS INT)) AS BIGINT) AS taken
FROM sized s
JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
JOIN more m ON s.source IS NOT DISTINCT FROM m.source AND s.hash = m.hash
"""


@registered("op10_mixing", _SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return copies_taken(docs).select(
        "doc_id",
        "size",
        "source_size",
        F.round("target", 6).alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"),
    )

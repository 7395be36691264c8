"""op2: every document searched for every window of the benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.decontamination import hit_words, searched
from tillweave.llm.tables import read

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS words
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    CASE WHEN text IS NULL THEN [] ELSE {_WORDS} END AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(words[i : i + size - 1], ' ') AS phrase
  FROM (SELECT item, words, least(10, len(words)) AS size,
          unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)),
places AS (
  SELECT d.row_id, d.i, s.size, array_to_string(d.words[d.i : d.i + s.size - 1], ' ') AS phrase
  FROM (SELECT row_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs) d
  JOIN (SELECT DISTINCT size FROM windows) s ON d.i + s.size - 1 <= len(d.words)),
hits AS (
  SELECT p.row_id, p.i, p.size, w.item FROM places p JOIN windows w USING (size, phrase)),
hit_words AS (
  SELECT row_id, count(DISTINCT word) AS n_hit
  FROM (SELECT row_id, unnest(range(i, i + size)) AS word FROM hits) GROUP BY row_id),
hit_items AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row_id, item FROM hits WHERE item IS NOT NULL) GROUP BY row_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
  coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
  coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h USING (row_id) LEFT JOIN hit_items n USING (row_id)
"""


@registered("op2_decontamination", _SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    benchmark = read(spark, sf_dir, "benchmark", ["item_id", "text"])
    found = searched(docs, benchmark, size=10).withColumn("n_hit", hit_words(F.col("spans")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )

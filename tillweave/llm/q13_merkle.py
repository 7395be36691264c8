"""op13: every document's place in the manifest, and whether a tampered copy is found out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.merkle import checked, leaf_digest, manifest, proof_digest
from tillweave.llm.tables import read

_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _h(parts: str, order: str) -> str:
    return f"sha256(string_agg({parts}, '' ORDER BY {order}))"


def _field(column: str, value: str | None = None) -> str:
    text = f"CAST({value or column} AS VARCHAR)"
    return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in _FIELDS[:-1]) + f" || {_field(text)})"


_SQL = f"""
WITH RECURSIVE bytes AS (
  SELECT doc_id, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)) AS codes
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
crc AS (
  -- One bit a step, with the polynomial's reflected form.
  SELECT doc_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), codes), lambda held, c:
    list_reduce(list_prepend(xor(held, c), range(8)), lambda x, i:
      CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS crc
  FROM bytes),
leaves AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
    CASE WHEN crc % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS got
  FROM documents LEFT JOIN crc USING (doc_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, got) - 1 AS place
  FROM leaves),
-- All nodes of one level after the other; a group is done when it has one node.
nodes AS (
  SELECT 0 AS level, source, place, leaf AS digest, count(*) OVER (PARTITION BY source) AS n FROM ranked
  UNION ALL
  SELECT level + 1, source, place // 3, {_h("digest", "place")}, (any_value(n) + 2) // 3
  FROM nodes WHERE n > 1 GROUP BY level, source, place // 3),
subroots AS (
  SELECT source, digest,
    row_number() OVER (ORDER BY source IS NOT NULL, source) - 1 AS place FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, place, digest, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, place // 3, {_h("digest", "place")}, (any_value(n) + 2) // 3
  FROM tops WHERE n > 1 GROUP BY level, place // 3),
sides AS (
  SELECT a.level, a.source, a.place,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
  FROM nodes a JOIN nodes b
    ON a.level = b.level AND a.source IS NOT DISTINCT FROM b.source AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY a.level, a.source, a.place),
top_sides AS (
  SELECT a.level, a.place,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
    coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
  FROM tops a JOIN tops b ON a.level = b.level AND a.place // 3 = b.place // 3
  WHERE a.n > 1 GROUP BY a.level, a.place),
up AS (
  SELECT doc_id, source, leaf, got, place AS rank, place, 0 AS level, got AS held, '' AS proof, TRUE AS more
  FROM ranked
  UNION ALL
  SELECT u.doc_id, u.source, u.leaf, u.got, u.rank, u.place // 3, u.level + 1,
    CASE WHEN s.place IS NULL THEN u.held ELSE sha256(s.before || u.held || s.after) END,
    CASE WHEN s.place IS NULL THEN u.proof ELSE u.proof || s.before || s.after END, s.place IS NOT NULL
  FROM up u LEFT JOIN sides s
    ON s.level = u.level AND s.source IS NOT DISTINCT FROM u.source AND s.place = u.place
  WHERE u.more),
lower_part AS (SELECT * FROM up WHERE NOT more),
upper AS (
  SELECT p.doc_id, p.source, p.leaf, p.rank, r.digest AS subroot, r.place, 0 AS level, p.held, p.proof,
    TRUE AS more
  FROM lower_part p JOIN subroots r ON p.source IS NOT DISTINCT FROM r.source
  UNION ALL
  SELECT u.doc_id, u.source, u.leaf, u.rank, u.subroot, u.place // 3, u.level + 1,
    CASE WHEN s.place IS NULL THEN u.held ELSE sha256(s.before || u.held || s.after) END,
    CASE WHEN s.place IS NULL THEN u.proof ELSE u.proof || s.before || s.after END, s.place IS NOT NULL
  FROM upper u LEFT JOIN top_sides s ON s.level = u.level AND s.place = u.place
  WHERE u.more)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, held AS folded_root,
  held = root AS verified
FROM upper, (SELECT digest AS root FROM tops WHERE n = 1)
WHERE NOT more
"""


@registered("op13_merkle_manifest", _SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", _FIELDS)
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(crc % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    received = leaf_digest([*[F.col(c) for c in _FIELDS[:-1]], tampered])
    return checked(manifest(docs, _FIELDS, carry={"received": received}), "received").select(
        F.col("id").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        "verified",
    )

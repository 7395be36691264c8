"""op6: every document scanned for licence notices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillweave.llm.base import registered
from tillweave.llm.licence_automaton import scanned
from tillweave.llm.tables import read


@registered("op6_licence_scan")
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    return scanned(docs).drop("spans")

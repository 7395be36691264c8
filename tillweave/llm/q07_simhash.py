"""op7: every document's SimHash and the group it is linked into."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.anchors import grouped
from tillweave.llm.base import registered
from tillweave.llm.tables import read


@registered("op7_simhash_anchors")
def op7_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    return grouped(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )

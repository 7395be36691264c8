"""op8: every document's toxicity score."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.tables import read
from tillweave.llm.toxicity import THRESHOLD, held_out, scored, trained


@registered("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    labels = read(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return scored(docs, trained(docs, labels)).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

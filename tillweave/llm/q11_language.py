"""op11: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.language import UNDETERMINED, held_out, predicted, trained
from tillweave.llm.tables import read


@registered("op11_language_id")
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = trained(read(spark, sf_dir, "documents", ["doc_id", "text", "lang"]))
    return predicted(read(spark, sf_dir, "documents", ["doc_id", "text"]), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce("nearest", F.lit(UNDETERMINED)).alias("lang_pred"),
        "score",
        "rejected",
    )

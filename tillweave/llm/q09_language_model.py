"""op9: every document's probability under the subword lattice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.base import registered
from tillweave.llm.language_model import scored
from tillweave.llm.tables import id_remainder, read


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@registered("op9_lattice_lm")
def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    held_out = id_remainder(F.col("doc_id"), 7) == 2
    return scored(docs.withColumn("held_out", held_out), default_pieces())

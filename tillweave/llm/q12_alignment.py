"""op12: how the tokens of two public tokenizers align in every document."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from tillweave.llm.alignment import aligned
from tillweave.llm.base import registered
from tillweave.llm.tables import read


def default_pair() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@registered("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    return aligned(docs, *default_pair(), of_groups=sha256).withColumnRenamed("groups", "groups_sha256")

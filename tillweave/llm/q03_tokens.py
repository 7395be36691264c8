"""op3: every document's token ids, written to block files and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillweave.llm.base import registered
from tillweave.llm.tables import read
from tillweave.llm.token_files import encoded


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@registered("op3_token_files")
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", ["doc_id", "text"])
    return encoded(docs, default_tokenizer(), end_id=2)

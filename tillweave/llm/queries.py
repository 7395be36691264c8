"""Every corpus query by name, each next to its SQL where SQL can express it."""

from tillweave.llm import (  # noqa: F401
    q01_quotations,
    q02_decontamination,
    q03_tokens,
    q04_urls,
    q05_embeddings,
    q06_licences,
    q07_simhash,
    q08_toxicity,
    q09_language_model,
    q10_mixing,
    q11_language,
    q12_alignment,
    q13_merkle,
)
from tillweave.llm.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

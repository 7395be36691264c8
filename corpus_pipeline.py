"""A corpus, cleaned, mixed and encoded: five stages, each one operator of ``tillweave.llm``.

``run`` writes what a stage returns as Parquet in the shared folder and hands the
rows, read again, to the next one.  All stages but the last return the columns
they are given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillweave.llm.anchors import one_per_group
from tillweave.llm.decontamination import uncontaminated
from tillweave.llm.mixing import mixed
from tillweave.llm.q03_tokens import default_tokenizer
from tillweave.llm.tables import read, stored
from tillweave.llm.token_files import encoded
from tillweave.llm.toxicity import tolerable, trained


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = read(spark, sf_dir, "labels", ["doc_id", "toxic"])
    return tolerable(docs, trained(docs.select("doc_id", "text"), labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return uncontaminated(docs, read(spark, sf_dir, "benchmark", ["item_id", "text"]))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what they hold of each."""
    return encoded(docs, default_tokenizer(), end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", encode_tokens),
]

#: Learned scores and linked groups have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        label = "".join(c if c.isalnum() else "-" for c in name)
        docs = stored(stage(spark, docs, sf_dir), f"stage-{label}")
    return docs

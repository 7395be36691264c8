"""The tables the corpus operators read, and small plan helpers they share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of one table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: computed once, and safe from lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus

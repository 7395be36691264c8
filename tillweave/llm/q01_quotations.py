"""op1: every conversation without quotes, in the order of replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillweave.llm.base import registered
from tillweave.llm.quotations import reply_ordered
from tillweave.llm.tables import read


@registered("op1_quotation_linking")
def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(read(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))

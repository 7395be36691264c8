"""Routing questions to reports by keyword."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillweave.functions.cleaning import contains_any

# The keywords of each intent, in the order the rules are tried.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("state", ("state", "region", "where")),
    ("item", ("item", "product", "food", "menu", "popular", "sell")),
    ("season", ("season", "spring", "summer", "fall", "winter")),
    ("category", ("category", "type", "kind")),
    ("gender", ("gender", "male", "female", "women", "men")),
)
DEFAULT_INTENT = "default"


def intent_of(
    question: Column, rules: Sequence = RULES, default: str = DEFAULT_INTENT
) -> Column:
    """Intent of the first rule with a keyword anywhere in the question.

    The rules are a short fixed list, so they compile into one conditional
    expression: no join, no row multiplication, whole texts.
    """
    choice = F.lit(default)
    for intent, words in reversed(rules):
        choice = F.when(contains_any(question, words), F.lit(intent)).otherwise(choice)
    return choice


def route(questions: DataFrame, text: str = "question", rules: Sequence = RULES) -> DataFrame:
    return questions.withColumn("intent", intent_of(F.col(text), rules))


def answer(routed: DataFrame, answers: DataFrame) -> DataFrame:
    """Attach each question's one-line insight.

    `answers` holds one row per intent.  No broadcast is hinted: the engine
    sees its size.
    """
    line = F.format_string(
        "Top %s: %s (%s %s)", "intent", "top_label", "detail_name", "detail_value"
    )
    return routed.join(answers, "intent", "left").withColumn(
        "insight", F.when(F.col("top_label").isNotNull(), line)
    )

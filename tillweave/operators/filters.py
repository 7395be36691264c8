"""Row filters shared by the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_selected(df: DataFrame, selection: Mapping[str, Sequence]) -> DataFrame:
    """Multi-select filter: an empty choice does not filter, a non-empty one drops nulls."""
    for column, chosen in selection.items():
        if chosen:
            df = df.where(F.col(column).isin(list(chosen)))
    return df


def keep_known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every listed column is known."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df

"""Every query by name, each next to the SQL that must give the same rows."""

from tillweave.registered import (  # noqa: F401
    cleaning,
    dashboard,
    exploratory,
    forecasting,
    loading,
    narrative,
    profiling,
    questions,
    scenario,
)
from tillweave.registered import cubes  # noqa: F401, E402, I001
from tillweave.registered.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]

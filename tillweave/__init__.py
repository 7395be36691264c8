"""Spark-native merging, reporting and forecasting over order-line feeds."""

__version__ = "0.1.0"

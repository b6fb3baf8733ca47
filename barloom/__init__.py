"""Spark-first analytics engine for market-style time series."""

"""Checks as queries: duplicates, gates, completeness, row-hash chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys and n of keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def gate(df: DataFrame, name: str, failing: Column) -> DataFrame:
    """One row: gate, n_failed, status. An empty table passes."""
    n = F.count(F.when(F.coalesce(failing, F.lit(False)), 1))
    return df.agg(n.alias("n_failed")).select(F.lit(name).alias("gate"), "n_failed", F.when(F.col("n_failed") == 0, "PASS").otherwise("FAIL").alias("status"))


def all_gates(df: DataFrame, failing: dict[str, Column]) -> DataFrame:
    """gate, n_failed, status of several gates over one table, in one pass. An empty table passes."""
    counts = df.agg(*(F.count(F.when(F.coalesce(x, F.lit(False)), 1)).alias(k) for k, x in failing.items()))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("gate"), F.col(k).alias("n_failed")) for k in failing)))
    return counts.select(rows.alias("g")).select("g.gate", "g.n_failed", F.when(F.col("g.n_failed") == 0, "PASS").otherwise("FAIL").alias("status"))


def gates(rows: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)


def reasons(**conditions: Column) -> Column:
    """Names of the conditions that hold, in order, as one text."""
    held = F.array(*(F.when(c, F.lit(k)) for k, c in conditions.items()))
    return F.concat_ws(",", F.filter(held, lambda x: x.isNotNull()))


def broken_links(rows: DataFrame, parents: DataFrame, child_hash: str, parent_hash: str) -> DataFrame:
    """Rows whose hash of their input isn't any parent's hash."""
    return rows.join(parents.select(F.col(parent_hash).alias("_h")).distinct(), F.col(child_hash) == F.col("_h"), "left_anti")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """name, n, has_value: whether each required column has a value anywhere."""
    counts = df.agg(*(F.count(c).alias(c) for c in columns))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("n")) for c in columns)))
    return counts.select(pairs.alias("p")).select("p.name", "p.n", (F.col("p.n") > 0).alias("has_value"))

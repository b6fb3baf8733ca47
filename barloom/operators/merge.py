"""Changes of tables as queries: upsert, delete, replace within a scope, actions; and the writers around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _on(a: str, b: str, keys: list[str]) -> list[Column]:
    return [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys]


def anti(existing: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of existing without a row of others of the same keys (nulls are equal)."""
    return existing.alias("x").join(others.select(*keys).distinct().alias("y"), _on("x", "y", keys), "left_anti")


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    return anti(existing, updates, keys).unionByName(updates, allowMissingColumns=True)


def delete(existing: DataFrame, stale: DataFrame, keys: list[str]) -> DataFrame:
    return anti(existing, stale, keys)


def append_new(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are there already are skipped."""
    return existing.unionByName(anti(rows, existing, keys))


def scoped_replace(existing: DataFrame, rows: DataFrame, scope: Column) -> DataFrame:
    """Everything within scope gives way to rows (those of rows within scope)."""
    return existing.where(~F.coalesce(scope, F.lit(False))).unionByName(rows.where(scope))


def apply_actions(existing: DataFrame, changes: DataFrame, keys: list[str], action: str = "action") -> DataFrame:
    """changes say upsert or delete for each key."""
    kept = anti(existing, changes, keys)
    return kept.unionByName(changes.where(F.col(action) == "upsert").select(*existing.columns))


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key that comes last by order."""
    w = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def fingerprint(*cols: str) -> Column:
    """A digest of a row's columns; nulls count."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols)), 256)


def merge_replace(old: DataFrame, new: DataFrame, keys: list[str], scope: Column | None = None) -> DataFrame:
    """upsert, without old rows in scope (all, if None) whose keys new doesn't have."""
    stale = anti(old if scope is None else old.where(scope), new, keys)
    return upsert(delete(old, stale, keys), new, keys)

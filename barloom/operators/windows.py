"""Windows that Spark has no single function for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def rows(w: WindowSpec, n: int) -> WindowSpec:
    """The last n rows."""
    return w.rowsBetween(-(n - 1), 0)


def full(value: Column, x: Column, w: WindowSpec, n: int) -> Column:
    """value, but only where the last n rows all have x."""
    return F.when(F.count(x).over(rows(w, n)) == n, value)


def rolling(fn: Callable[[Column], Column], x: Column, w: WindowSpec, n: int) -> Column:
    """An aggregate of the last n rows; null until there are n."""
    return full(fn(x).over(rows(w, n)), x, w, n)


def correlation(x: Column, y: Column, w: WindowSpec, n: int) -> Column:
    """Correlation over the last n rows; null where either doesn't vary."""
    f = rows(w, n)
    sx, sy = F.stddev_pop(x).over(f), F.stddev_pop(y).over(f)
    return full(F.when((sx > 1e-12) & (sy > 1e-12), F.covar_pop(x, y).over(f) / (sx * sy)), x, w, n)


def gap_clusters(df: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """df with cluster: a new one begins where the gap to the row before is longer than so many seconds."""
    w = Window.partitionBy(*keys).orderBy(ts)
    new = F.coalesce((F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(w)) > seconds).cast("int"), F.lit(1))
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def islands(flag: Column, w: WindowSpec) -> Column:
    """Running number of the island: it grows where flag holds."""
    return F.sum(F.when(flag, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def carried(x: Column, w: WindowSpec) -> Column:
    """The last value that isn't null."""
    return F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def masked(df: DataFrame, keys: list[str], order: str, eligible: Column, compute: Callable[[DataFrame], DataFrame], out: str, mode: str, scope: list[str] | None = None, id_cols: list[str] | None = None) -> DataFrame:
    """compute adds column out on eligible rows only; others are filled by mode.

    hold: the last computed value, even a null one; hold_scope: the same within scope; null; zero.
    """
    ids = id_cols or [*keys, order]
    marked = df.withColumn("_ok", F.coalesce(eligible, F.lit(False)))
    done = compute(marked.where("_ok")).select(*ids, F.struct(F.col(out).alias("v")).alias("_v"))
    back = marked.join(done, ids, "left")
    w = Window.partitionBy(*keys, *((scope or []) if mode == "hold_scope" else [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    value = {"hold": F.last("_v", ignorenulls=True).over(w)["v"], "hold_scope": F.last("_v", ignorenulls=True).over(w)["v"], "null": F.col("_v.v"), "zero": F.when(F.col("_ok"), F.col("_v.v")).otherwise(0)}[mode]
    return back.withColumn(out, value).drop("_v", "_ok")

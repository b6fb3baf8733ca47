"""Features derived from indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from barloom.operators.windows import carried, full, rows


def position(low: Column, high: Column, x: Column | None = None) -> Column:
    """Where x lies between low (0) and high (1); null where they are equal."""
    return F.when(high - low != 0, ((F.col("close") if x is None else x) - low) / (high - low))


def cross_code(difference: Column, w: WindowSpec) -> Column:
    """1 where it rises above 0, -1 where it falls below; equality counts as the side it comes from."""
    prev = F.lag(difference).over(w)
    return F.when(difference.isNull() | prev.isNull(), None).when((prev <= 0) & (difference > 0), 1).when((prev >= 0) & (difference < 0), -1).otherwise(0)


def session_opening(df: DataFrame, session: list[str], n: int) -> DataFrame:
    """opening_range_high and _low of a session's first n bars; null before its nth, and in shorter sessions."""
    w = Window.partitionBy(*session)
    out = df.withColumn("_rn", F.row_number().over(w.orderBy("ts"))).withColumn("_n", F.count(F.lit(1)).over(w))
    shown = (F.col("_n") >= n) & (F.col("_rn") >= n)
    first = F.col("_rn") <= n
    return out.withColumns(
        {
            "opening_range_high": F.when(shown, F.max(F.when(first, F.col("high"))).over(w)),
            "opening_range_low": F.when(shown, F.min(F.when(first, F.col("low"))).over(w)),
        }
    ).drop("_rn", "_n")


def swing(df: DataFrame, w: WindowSpec, left: int, right: int) -> DataFrame:
    """swing_high and swing_low: pivots over left and right bars, known `right` bars later and carried on."""
    n = left + right + 1
    high, low = F.lag("high", right).over(w), F.lag("low", right).over(w)
    out = df.withColumn("_ph", full(F.when(high == F.max("high").over(rows(w, n)), high), F.col("high"), w, n)).withColumn(
        "_pl", full(F.when(low == F.min("low").over(rows(w, n)), low), F.col("low"), w, n)
    )
    return out.withColumns({"swing_high": carried(F.col("_ph"), w), "swing_low": carried(F.col("_pl"), w)}).drop("_ph", "_pl")

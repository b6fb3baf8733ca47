"""Market tables derived from the driver's tables, for Spark and as SQL for the oracle.

A tick is an event: instrument = event type, contract = instrument and user_id modulo 3, price =
value + 1. Executions are line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("instrument_id"),
        F.concat_ws("-", "event_type", (F.col("user_id") % 3).cast("string")).alias("contract_id"),
        "ts",
        (F.col("value") + 1).alias("price"),
        (F.col("user_id") % 7 + 1).alias("volume"),
        (F.col("user_id") % 1000 + 100).alias("open_interest"),
    )


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per instrument and hour."""
    return bars.ohlc(ticks(spark, sf_dir), ["instrument_id"], 60)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per contract and day."""
    return bars.ohlc(ticks(spark, sf_dir), ["instrument_id", "contract_id"], 1440)


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills: signed quantity by return flag."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("fill_no"),
        F.col("l_suppkey").alias("instrument_id"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        (F.when(F.col("l_returnflag") == "R", -1).otherwise(1) * F.col("l_quantity")).alias("qty"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("fee"),
        (F.col("l_extendedprice") * (F.col("l_discount") - 0.05)).alias("net_pnl"),
    )


def _ohlc_sql(keys: str, minutes: int) -> str:
    return f"""SELECT {keys}, to_timestamp(floor(epoch(ts) / {minutes * 60}) * {minutes * 60})::TIMESTAMP AS ts,
        arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close,
        sum(volume)::BIGINT AS volume, arg_max(open_interest, (ts, event_id))::BIGINT AS open_interest, count(*) AS n
        FROM ticks GROUP BY {keys}, floor(epoch(ts) / {minutes * 60})"""


CTE = f"""WITH RECURSIVE ticks AS (
    SELECT event_id, event_type AS instrument_id, event_type || '-' || (user_id % 3) AS contract_id, ts, value + 1 AS price,
           user_id % 7 + 1 AS volume, user_id % 1000 + 100 AS open_interest FROM events
), hourly AS ({_ohlc_sql('instrument_id', 60)}),
daily AS ({_ohlc_sql('instrument_id, contract_id', 1440)}),
executions AS (
    SELECT l_orderkey AS order_id, l_linenumber AS fill_no, l_suppkey AS instrument_id, l_shipdate AS ts, l_extendedprice / l_quantity AS price,
           CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_quantity AS qty, l_extendedprice * l_tax AS fee,
           l_extendedprice * (l_discount - 0.05) AS net_pnl FROM lineitem
)"""

"""Trades and events: money of trades, run statistics, drawdown, folding of events, positions."""

from __future__ import annotations

from collections.abc import Iterator
from math import nan

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.session import ship_package


def drawdown(trades: DataFrame, keys: list[str], order: list[str], pnl: str = "net_pnl") -> DataFrame:
    """keys and max_drawdown of the running pnl, whose peak starts at 0."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    run = trades.withColumn("_eq", F.sum(pnl).over(w)).withColumn("_peak", F.greatest(F.lit(0.0), F.max("_eq").over(w)))
    return run.groupBy(*keys).agg(F.max(F.col("_peak") - F.col("_eq")).alias("max_drawdown"))


def trade_stats(trades: DataFrame, keys: list[str], order: list[str], capital: float) -> DataFrame:
    """Per key: trades, net_pnl, fees, profit_factor (null without losses), win_rate, avg_trade, total_return, max_drawdown."""
    pnl = F.col("net_pnl")
    gain, loss = F.sum(F.when(pnl > 0, pnl).otherwise(0)), -F.sum(F.when(pnl < 0, pnl).otherwise(0))
    sums = trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trades"),
        F.sum(pnl).alias("net_pnl"),
        F.sum("fee").alias("fees"),
        F.when(loss != 0, gain / loss).alias("profit_factor"),
        F.avg((pnl > 0).cast("double")).alias("win_rate"),
        F.avg(pnl).alias("avg_trade"),
        (F.sum(pnl) / capital).alias("total_return"),
    )
    return sums.join(drawdown(trades, keys, order).withColumn("max_drawdown", F.col("max_drawdown") / capital), keys)


def folded_signals(events: DataFrame, key: str, opens: Column, activates: Column, closes: Column) -> DataFrame:
    """Per key: first opening and activation, last closing, seconds between the first two, and the furthest status."""
    f = events.groupBy(key).agg(F.min(F.when(opens, F.col("ts"))).alias("opened"), F.min(F.when(activates, F.col("ts"))).alias("activated"), F.max(F.when(closes, F.col("ts"))).alias("closed"))
    status = F.when(F.col("closed").isNotNull(), "closed").when(F.col("activated").isNotNull(), "active").when(F.col("opened").isNotNull(), "open").otherwise("none")
    return f.withColumn("latency", F.unix_timestamp("activated") - F.unix_timestamp("opened")).withColumn("status", status)


def trade_money(df: DataFrame, tick_size: Column, tick_value: Column, commission: Column, slippage_ticks: Column) -> DataFrame:
    """gross, cost (two-sided), net of trades with entry_price, exit_price and signed qty."""
    q = F.abs("qty")
    gross = (F.col("exit_price") - F.col("entry_price")) / tick_size * tick_value * F.col("qty")
    cost = 2 * q * (commission + slippage_ticks * tick_value)
    return df.withColumns({"gross": gross, "cost": cost}).withColumn("net", F.col("gross") - F.col("cost"))


def position_size(cash: Column, risk: Column, price: Column, stop: Column, tick: Column, tick_value: Column, most: Column, margin: Column) -> Column:
    """Whole contracts that risk a share of cash, capped by a number and by margin; null if under one."""
    n = F.least(F.floor(cash * risk / (price * stop / tick * tick_value)), most, F.floor(cash / margin))
    return F.when(n >= 1, n)


def folded_positions(fills: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """position and average_price after each fill: same direction averages, a partial close keeps it, a flip takes the fill's price.

    An account's fills are folded in order in one task, missing values of the order last; a task folds account after account as they
    come, a batch at a time. Without a position the average is 0. After a fill without quantity the position is unknown.
    """
    ship_package(fills.sparkSession)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fills.schema) + ", position double, average_price double"
    w = Window.partitionBy(*keys).orderBy(*(F.col(k).asc_nulls_last() for k in order))
    columns = fills.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, avg = 0.0, 0.0
        for batch in batches:
            starts, qty, price = (batch.column(k).cast(t).to_pylist() for k, t in (("_starts", pa.bool_()), ("qty", pa.float64()), ("price", pa.float64())))
            qs, avgs = [], []
            for start, d, p in zip(starts, qty, price, strict=True):
                d, p = nan if d is None else d, nan if p is None else p
                if start:
                    q, avg = 0.0, p if d else 0.0
                elif q * d >= 0:
                    avg = (abs(q) * avg + abs(d) * p) / (abs(q) + abs(d)) if q + d else 0.0
                elif abs(d) > abs(q):
                    avg = p
                elif abs(d) == abs(q):
                    avg = 0.0
                q += d
                qs.append(q)
                avgs.append(avg)
            made = [pa.array(x, pa.float64(), from_pandas=True) for x in (qs, avgs)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in columns), *made], names=[*columns, "position", "average_price"])

    # the window deals accounts to tasks and puts their fills in order
    return fills.withColumn("_starts", F.row_number().over(w) == 1).mapInArrow(fold, types)


def simulate_long(bars: DataFrame, keys: list[str], stop_distance: str = "atr", stop_multiple: float = 2.0) -> DataFrame:
    """Trades of a long-only book per series: keys, entry_ts, exit_ts, entry_price, exit_price, reason.

    bars have ts, open, low, entry, exit and the stop distance. It enters at the open of a bar with
    entry and leaves at the open of a later one with exit, or at the stop (or a worse open) once a
    later bar's low reaches it. What is open at the end is no trade. A series is one task.
    """
    ship_package(bars.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in bars.schema}
    types = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"entry_ts {kinds['ts']}", f"exit_ts {kinds['ts']}", "entry_price double", "exit_price double", "reason string"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", kind="stable")
        head = [pdf[k].iloc[0] for k in keys]
        out, at = [], None
        for ts, o, low, enter, leave, dist in zip(pdf["ts"], pdf["open"], pdf["low"], pdf["entry"], pdf["exit"], pdf[stop_distance], strict=True):
            if at is None:
                if enter:
                    at = (ts, o, o - stop_multiple * dist if dist == dist and dist is not None else -float("inf"))
            elif leave:
                out.append((*head, at[0], ts, at[1], o, "exit"))
                at = None
            elif low <= at[2]:
                out.append((*head, at[0], ts, at[1], min(o, at[2]), "stop"))
                at = None
        return pd.DataFrame(out, columns=[*keys, "entry_ts", "exit_ts", "entry_price", "exit_price", "reason"])

    return bars.groupBy(*keys).applyInPandas(walk, types)


def simulate(bars: DataFrame, keys: list[str], stop_distance: str = "atr", stop_multiple: float = 2.0) -> DataFrame:
    """Trades of a book per series that is long, short or flat: keys, side, entry_ts, exit_ts, entry_price, exit_price, reason.

    bars have ts, open, high, low, entry, exit, short_entry, short_exit and the stop distance. A flat book enters at the open of a bar
    with an entry (long before short). At a later bar's open it leaves on its exit, or turns on the other side's entry; else it
    is stopped once that bar reaches the stop, at the stop or a worse open. What is open at the end is no trade. Books
    don't share cash. A series is one task.
    """
    ship_package(bars.sparkSession)
    kinds = {f.name: f.dataType.simpleString() for f in bars.schema}
    types = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), f"side string, entry_ts {kinds['ts']}", f"exit_ts {kinds['ts']}", "entry_price double", "exit_price double", "reason string"])
    columns = [*keys, "side", "entry_ts", "exit_ts", "entry_price", "exit_price", "reason"]

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts", kind="stable")
        head, out = [pdf[k].iloc[0] for k in keys], []
        side, since, price, stop = 0, None, 0.0, 0.0
        fields = ("ts", "open", "high", "low", "entry", "exit", "short_entry", "short_exit", stop_distance)
        for ts, o, high, low, enter, leave, sell, cover, dist in zip(*(pdf[f] for f in fields), strict=True):
            wanted, reason, at = 0, None, o
            if side:
                turn, done = (sell, leave) if side > 0 else (enter, cover)
                if turn:
                    wanted, reason = -side, "reverse"
                elif done:
                    reason = "exit"
                elif (low <= stop) if side > 0 else (high >= stop):
                    reason, at = "stop", min(o, stop) if side > 0 else max(o, stop)
                if reason:
                    out.append((*head, "long" if side > 0 else "short", since, ts, price, at, reason))
                    side = 0
            else:
                wanted = 1 if enter else -1 if sell else 0
            if wanted:
                side, since, price = wanted, ts, o
                stop = o - side * stop_multiple * dist if dist is not None and dist == dist else -side * float("inf")
        return pd.DataFrame(out, columns=columns)

    return bars.groupBy(*keys).applyInPandas(walk, types)

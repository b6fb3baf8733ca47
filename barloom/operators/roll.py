"""Continuous series of expiring contracts: which contract is in front, roll events, adjusted bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators.windows import rows


def calendar_front(bars: DataFrame, instrument: str, contract: str, maturity: str, back: Column, last_maturity: int) -> DataFrame:
    """instrument, ts, active: the contract of lowest maturity that has begun and hasn't reached its roll.

    A contract rolls at its back-th bar before the last; those of last_maturity don't.
    """
    w = Window.partitionBy(contract)
    placed = bars.withColumns({"_rn": F.row_number().over(w.orderBy("ts")), "_n": F.count(F.lit(1)).over(w), "_back": back})
    life = placed.groupBy(F.col(instrument).alias("_i"), F.col(contract).alias("_c"), F.col(maturity).alias("_m")).agg(
        F.min("ts").alias("first_ts"), F.min(F.when(F.col("_rn") >= F.greatest(F.lit(1), F.col("_n") - F.col("_back")), F.col("ts"))).alias("roll_ts")
    )
    life = life.withColumn("roll_ts", F.when(F.col("_m") < last_maturity, F.col("roll_ts")))
    clock = bars.select(instrument, "ts").distinct()
    live = (F.col(instrument) == F.col("_i")) & (F.col("ts") >= F.col("first_ts")) & (F.col("roll_ts").isNull() | (F.col("ts") < F.col("roll_ts")))
    return clock.join(life, live).groupBy(instrument, "ts").agg(F.min_by("_c", "_m").alias("active"))


def liquidity_front(bars: DataFrame, instrument: str, contract: str, maturity: str, metric: str, share: float, confirmations: int) -> DataFrame:
    """instrument, ts, maturity: led by the metric for so many bars with enough share, decided on the closed bar, never rolled back."""
    top = bars.groupBy(instrument, "ts").agg(
        F.max_by(F.struct(contract, maturity), F.struct(metric, contract)).alias("r"), (F.max(metric) / F.sum(metric)).alias("share")
    )
    w = Window.partitionBy(instrument).orderBy("ts")
    frame = rows(w, confirmations)
    lead = F.col(f"r.{contract}")
    held = (F.count(F.lit(1)).over(frame) == confirmations) & (F.min(lead).over(frame) == F.max(lead).over(frame)) & (F.col("share") >= share)
    decided = top.withColumn("cand", F.when(held, F.col(f"r.{maturity}"))).withColumn("decided", F.lag("cand").over(w))
    return decided.select(instrument, "ts", F.max("decided").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("maturity"))


def roll_events(front: DataFrame, bars: DataFrame, instrument: str = "instrument_id") -> DataFrame:
    """Where the maturity changes: ts, decision_ts (the bar before), old and new maturity, gap of their closes then, seq."""
    w = Window.partitionBy(instrument).orderBy("ts")
    ev = front.withColumns({"old_maturity": F.lag("maturity").over(w), "decision_ts": F.lag("ts").over(w)}).where("old_maturity IS NOT NULL AND old_maturity <> maturity")

    def closes(which: str, name: str) -> DataFrame:
        return bars.select(F.col("contract_id").alias(f"_{name}_c"), F.col("ts").alias(f"_{name}_t"), F.col("close").alias(name))

    for which, name in (("old_maturity", "old_close"), ("maturity", "new_close")):
        key = F.concat_ws("-", F.col(instrument), F.col(which).cast("string"))
        ev = ev.join(closes(which, name), (key == F.col(f"_{name}_c")) & (F.col("decision_ts") == F.col(f"_{name}_t")), "left")
    ev = ev.withColumn("gap", F.col("new_close") - F.col("old_close")).withColumn("seq", F.row_number().over(w))
    return ev.select(instrument, "ts", "decision_ts", "old_maturity", F.col("maturity").alias("new_maturity"), "gap", "seq")


def front_bars(front: DataFrame, bars: DataFrame, events: DataFrame, instrument: str = "instrument_id") -> DataFrame:
    """Bars of the front contract: native close, roll_epoch, bars_since_roll, close0 (gaps so far taken out)."""
    w = Window.partitionBy(instrument).orderBy("ts")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = front.join(events.select(instrument, "ts", "gap", "seq"), [instrument, "ts"], "left")
    marked = marked.withColumns({"roll_epoch": F.count("seq").over(so_far), "offset0": F.coalesce(F.sum("gap").over(so_far), F.lit(0.0))})
    key = F.concat_ws("-", F.col(instrument), F.col("maturity").cast("string"))
    own = bars.select("contract_id", F.col("ts").alias("_t"), "close")
    out = marked.join(own, (key == F.col("contract_id")) & (F.col("ts") == F.col("_t")))
    since = F.row_number().over(Window.partitionBy(instrument, "roll_epoch").orderBy("ts")) - 1
    return out.withColumns({"bars_since_roll": since, "close0": F.col("close") - F.col("offset0")})


def input_frame(front: DataFrame, events: DataFrame, bars: DataFrame, instrument: str = "instrument_id", missing: str = "error") -> DataFrame:
    """Bars of the contract that is in front on their day, prices less the gaps of the rolls so far, with roll_epoch and offset0.

    front and events are by day, bars of any length. missing: what a roll without a gap is (a contract had no bar when the
    roll was decided): "error" raises when such bars are read, "keep" takes no gap.
    """
    so_far = Window.partitionBy(instrument).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    marked = front.join(events.select(instrument, "ts", "gap", "seq"), [instrument, "ts"], "left")
    gap = F.col("gap")
    if missing == "error":
        gap = F.when(F.col("seq").isNotNull() & gap.isNull(), F.raise_error(F.concat_ws(" ", F.lit("no gap for the roll of"), instrument, F.col("ts").cast("string"))).cast("double")).otherwise(gap)
    marked = marked.select(instrument, F.col("ts").alias("_day"), F.concat_ws("-", instrument, F.col("maturity").cast("string")).alias("_c"), F.count("seq").over(so_far).alias("roll_epoch"), F.coalesce(F.sum(gap).over(so_far), F.lit(0.0)).alias("offset0"))
    own = bars.drop(instrument).join(marked, (F.col("contract_id") == F.col("_c")) & (F.date_trunc("day", "ts") == F.col("_day")))
    return own.withColumns({k: F.col(k) - F.col("offset0") for k in ("open", "high", "low", "close")}).drop("_day", "_c")

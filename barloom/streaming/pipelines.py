"""Structured Streaming forms of the incremental operators: watermarks, windows, state, idempotent appends."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.session import ship_package
from barloom.sources.io import scratch


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table's files as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    pattern = f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet"  # a pattern takes a single file as well as a folder
    stream = spark.readStream.schema(schema).parquet(pattern)
    zoneless = [f.name for f in schema if f.dataType.typeName() == "timestamp_ntz"]  # watermarks need an instant
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in zoneless})


def run_to_end(stream: DataFrame, mode: str, schema: str | None = None) -> DataFrame:
    """Process all that is there and return what the sink holds: each batch is a folder of its own, so a repeated one is replaced."""
    spark = stream.sparkSession
    path, checkpoint = scratch(spark, "stream"), scratch(spark, "progress")

    def write(batch: DataFrame, number: int) -> None:
        target = path if mode == "complete" else f"{path}/batch={number}"
        batch.write.mode("overwrite").parquet(target)

    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema or stream.schema).parquet(path)


def tumbling(events: DataFrame, minutes: int, late: str = "1 day") -> DataFrame:
    return (
        events.withWatermark("ts", late)
        .groupBy(F.window("ts", f"{minutes} minutes").alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select("event_type", F.col("w.start").alias("bucket"), "n", "total")
    )


def sliding(events: DataFrame, minutes: int, slide: int, late: str = "1 day") -> DataFrame:
    w = F.window("ts", f"{minutes} minutes", f"{slide} minutes").alias("w")
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("bucket"), "n")


def sessions(events: DataFrame, gap: str, late: str = "1 day") -> DataFrame:
    w = F.session_window("ts", gap).alias("w")
    return events.withWatermark("ts", late).groupBy(w, "event_type").agg(F.count(F.lit(1)).alias("n")).select("event_type", F.col("w.start").alias("opens"), "n")


def unique_events(events: DataFrame, key: list[str], late: str = "40 days") -> DataFrame:
    """The first event of each key; keys are remembered as long as the watermark says."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(key)


def cooldown_rule(seconds: float) -> Callable[[float | None, float], bool]:
    return lambda last, now: last is None or now - last >= seconds


def admitted(events: DataFrame, key: str, seconds: int) -> DataFrame:
    """Events of a key that come at least so many seconds after its last admitted one: state per key, kept by the stream.

    A batch's events of a key are taken in time order.
    """
    ship_package(events.sparkSession)
    rule = cooldown_rule(seconds)

    def step(keys: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"], kind="stable")
        keep = []
        for event_id, now in zip(rows["event_id"], rows["ts"].astype("int64") / 1e9 if str(rows["ts"].dtype).startswith("datetime64[ns") else rows["ts"].map(lambda t: t.timestamp()), strict=True):
            if rule(last, now):
                last = now
                keep.append(event_id)
        if last is not None:
            state.update((last,))
        yield pd.DataFrame({key: [keys[0]] * len(keep), "event_id": keep})

    return (
        events.select(key, "event_id", "ts").groupBy(key).applyInPandasWithState(step, f"{key} long, event_id long", "last double", "append", GroupStateTimeout.NoTimeout)
    )


def admitted_batch(events: DataFrame, key: str, seconds: int) -> DataFrame:
    """The same over a whole table."""
    ship_package(events.sparkSession)
    rule = cooldown_rule(seconds)

    def step(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "event_id"], kind="stable")
        last, keep = None, []
        for now in pdf["ts"].map(lambda t: t.timestamp()):
            keep.append(rule(last, now))
            last = now if keep[-1] else last
        return pdf.loc[keep, [key, "event_id"]]

    return events.select(key, "event_id", "ts").groupBy(key).applyInPandas(step, f"{key} long, event_id long")

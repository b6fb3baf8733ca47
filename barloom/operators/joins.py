"""Joins over time: as-of in three directions, validity intervals, containment, nearest, key differences.

As-of joins are one union and one window instead of a range join, so a key costs its rows, not their
square; with a bucket a key's rows are split by time among tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.session import ship_package


def asof(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    values: list[str],
    exact: bool = True,
    forward: bool = False,
    tie: str | None = None,
    bucket: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """left with the values of right's last row at or before left_ts (forward: first at or after).

    exact=False leaves equal times out. Of right rows at one time the last by tie counts. Left rows
    without a match keep null values; null keys match each other. bucket: a monotone function of time by
    which long series are split; what a bucket starts with comes from one row per key and earlier bucket.
    """
    payload = F.struct(F.col(right_ts).alias("_at"), *(F.col(v).alias(f"_{v}") for v in values))
    first_side = 1 if exact else 0  # right rows come before left rows of one time if equal times match
    own = left.select(*left.columns, F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_p"), F.col(left_ts).alias("_t"), F.lit(first_side).alias("_side"), F.lit(None).cast("string").alias("_tie"))
    other = right.select(
        *(F.col(c) if c in keys else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns),
        payload.alias("_p"),
        F.col(right_ts).alias("_t"),
        F.lit(1 - first_side).alias("_side"),
        (F.col(tie).cast("string") if tie else F.lit(None).cast("string")).alias("_tie"),
    )
    order = [F.col("_t").desc() if forward else F.col("_t"), F.col("_side"), F.col("_tie").asc_nulls_first()]
    both = own.withColumn("_left", F.lit(True)).unionByName(other.withColumn("_left", F.lit(False)))
    so_far = lambda *by: Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if bucket is None:
        found = both.withColumn("_hit", F.last("_p", ignorenulls=True).over(so_far(*keys)))
    else:
        both = both.withColumn("_b", bucket(F.col("_t")))
        # Of a bucket's right rows the last in the window's order: that of the latest (forward: earliest) time, the last by tie.
        time = F.struct(F.col("_t")) if not forward else F.struct((-F.unix_micros(F.col("_t").cast("timestamp"))).alias("_t"))
        last = F.max_by("_p", F.when(~F.col("_left"), F.struct(time.alias("t"), F.coalesce("_tie", F.lit("")).alias("tie"))))
        ends = both.groupBy(*keys, "_b").agg(last.alias("_last"))
        earlier = Window.partitionBy(*keys).orderBy(F.col("_b").desc() if forward else F.col("_b")).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_b").alias("_kb"), F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
        same = (F.col("_b") == F.col("_kb")) if not keys else F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}")) & F.col("_b").eqNullSafe(F.col("_kb"))
        found = both.withColumn("_in", F.last("_p", ignorenulls=True).over(so_far(*keys, "_b"))).join(carry, same, "left").withColumn("_hit", F.coalesce("_in", "_carry"))
    return found.where("_left").select(*left.columns, F.col("_hit._at").alias(f"matched_{right_ts}"), *(F.col(f"_hit._{v}").alias(v) for v in values))


def segments(intervals: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """intervals cut so that those of a key don't overlap: at any time the one with the latest start that holds is left.

    Of equal starts the one that ends last counts; a null end is open, rows with a null start hold never. A key's intervals
    are swept in order in one task, in memory for them.
    """

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf[pdf[start].notna()].sort_values(start, kind="stable").reset_index(drop=True)
        starts, ends = pdf[start].tolist(), [None if pd.isna(e) else e for e in pdf[end]]
        times = sorted({*starts, *(e for e in ends if e is not None)})
        open_, out, at = [], [], 0
        for k, t in enumerate(times):
            while at < len(starts) and starts[at] == t:
                heapq.heappush(open_, (-at, at))
                at += 1
            while open_ and ends[open_[0][1]] is not None and ends[open_[0][1]] <= t:
                heapq.heappop(open_)
            if open_:
                out.append((open_[0][1], t, times[k + 1] if k + 1 < len(times) else None))
        got = pdf.iloc[[i for i, _, _ in out]].copy()
        got[start], got[end] = pd.Series([t for _, t, _ in out], index=got.index, dtype=pdf[start].dtype), pd.Series([e for _, _, e in out], index=got.index, dtype=pdf[end].dtype)
        return got

    # Later rows win: of one start the shortest comes first.
    ordered, columns = intervals.withColumn("_open", F.col(end).isNull()), intervals.columns

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return sweep(pdf.sort_values([start, "_open", end], kind="stable"))[columns]

    ship_package(intervals.sparkSession)

    return ordered.groupBy(*keys).applyInPandas(run, intervals.schema)


def valid_at(left: DataFrame, right: DataFrame, keys: list[str], ts: str, start: str, end: str, values: list[str]) -> DataFrame:
    """left with the values of right's interval [start, end) that holds ts (null end: open). Of several that hold the latest start counts."""
    cut = segments(right.select(*keys, start, end, *values), keys, start, end)
    got = asof(left, cut, keys, ts, start, [*values, end])
    ok = F.col(end).isNull() | (F.col(ts) < F.col(end))
    return got.select(*left.columns, *(F.when(ok, F.col(v)).alias(v) for v in values))


def contained(inner: DataFrame, outer: DataFrame, on: list[str], within: Column) -> DataFrame:
    """Pairs that agree in on and where inner lies within outer; on should bound the candidates (a date, say)."""
    return inner.join(outer, on).where(within)


def nearest(left: DataFrame, right: DataFrame, keys: list[str], rank: str, other_rank: str, left_id: list[str]) -> DataFrame:
    """For each left row the right row of its keys with the nearest rank; ties go to the lower. Left rows without one are left out.

    The row before and the row after by rank are two as-of joins, so no pairs are formed. Of equal ranks any one counts.
    """
    values = [c for c in right.columns if c not in keys and c != other_rank]
    found = None
    for forward, side in ((False, "below"), (True, "above")):
        got = asof(left, right, keys, rank, other_rank, values, forward=forward)
        hit = F.struct(F.col(f"matched_{other_rank}").alias(other_rank), *values)
        kept = F.when(F.col(f"matched_{other_rank}").isNotNull(), F.struct(F.abs(F.col(rank) - F.col(f"matched_{other_rank}")).alias("d"), F.col(f"matched_{other_rank}").alias("r"), hit.alias("v")))
        got = got.select(*left.columns, kept.alias("_near"))
        found = got if found is None else found.unionByName(got)
    best = F.min_by("_near.v", F.struct("_near.d", "_near.r"))
    out = found.where("_near IS NOT NULL").groupBy(*left_id).agg(best.alias("_v"), *(F.first(c).alias(c) for c in left.columns if c not in left_id))
    return out.select(*left.columns, F.col(f"_v.{other_rank}").alias(other_rank), *(F.col(f"_v.{v}").alias(v) for v in values))


def any_key(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Rows that agree in any of the pairs of columns: one equi-join for each, without what an earlier one has found."""
    out, found = None, F.lit(False)
    for a, b in pairs:
        part = left.join(right, (F.col(a) == F.col(b)) & ~found)
        out = part if out is None else out.unionByName(part)
        found = found | F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return out


def key_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys and status: matched, missing (only in a), unexpected (only in b). Null keys match each other."""
    x = a.select(*keys).distinct().withColumn("_a", F.lit(True)).alias("x")
    y = b.select(*keys).distinct().withColumn("_b", F.lit(True)).alias("y")
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in keys]
    status = F.when(F.col("_a").isNull(), "unexpected").when(F.col("_b").isNull(), "missing").otherwise("matched")
    return x.join(y, on, "full").select(*(F.coalesce(f"x.{k}", f"y.{k}").alias(k) for k in keys), status.alias("status"))


def covered_spans(spans: DataFrame, days: DataFrame, keys: list[str], start: str, end: str, day: str) -> DataFrame:
    """spans with n_days, n_covered, and whether every date from start to end has a row in days."""
    per_day = spans.withColumn("_day", F.explode(F.sequence(start, end)))
    seen = days.select(*keys, F.col(day).alias("_day")).distinct().withColumn("_seen", F.lit(1))
    out = per_day.join(seen, [*keys, "_day"], "left").groupBy(*spans.columns).agg(F.count(F.lit(1)).alias("n_days"), F.count("_seen").alias("n_covered"))
    return out.withColumn("is_covered", F.col("n_days") == F.col("n_covered"))


def admitted(candles: DataFrame, intervals: DataFrame, keys: list[str], minutes: int, slack: int = 60) -> DataFrame:
    """candles (ts, of so many minutes) with verdict against session intervals (opens, closes) of their keys and day.

    admitted: within an interval (it may begin slack seconds early); boundary_ignored: it ends when one opens, or begins when one closes;
    else rejected. keys include the day, so candidates are a day's intervals.
    """
    t, end = F.unix_timestamp("ts"), F.unix_timestamp("ts") + minutes * 60
    opens, closes = F.unix_timestamp("_opens"), F.unix_timestamp("_closes")
    own = intervals.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("opens").alias("_opens"), F.col("closes").alias("_closes"))
    same = [F.col(k) == F.col(f"_{k}") for k in keys]
    met = candles.join(own, same, "left")
    inside, touches = (t >= opens - slack) & (end <= closes) & (end > opens), (end == opens) | (t == closes)
    best = F.max(F.when(inside, 2).when(touches, 1).otherwise(0))
    return met.groupBy(*candles.columns).agg(best.alias("_best")).withColumn("verdict", F.when(F.col("_best") == 2, "admitted").when(F.col("_best") == 1, "boundary_ignored").otherwise("rejected")).drop("_best")


def covered_by_finer(coarse: DataFrame, fine: DataFrame, intervals: DataFrame, keys: list[str], minutes: int, fine_minutes: int) -> DataFrame:
    """Keys and ts of coarse candles of which every slot of fine_minutes within an interval, and there is one, has an admitted fine candle."""
    steps = F.sequence(F.lit(0), F.lit(minutes - fine_minutes), F.lit(fine_minutes))
    slots = coarse.select(*keys, "ts", F.explode(F.transform(steps, lambda m: F.timestamp_seconds(F.unix_timestamp("ts") + m * 60))).alias("slot"))
    during = slots.select(*keys, F.col("ts").alias("coarse_ts"), F.col("slot").alias("ts"))
    during = admitted(during, intervals, keys, fine_minutes).where("verdict = 'admitted'")
    have = fine.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("ts").alias("_ts"), F.lit(1).alias("_has")).distinct()
    seen = during.join(have, [*(F.col(k) == F.col(f"_{k}") for k in keys), F.col("ts") == F.col("_ts")], "left")
    return seen.groupBy(*keys, F.col("coarse_ts").alias("ts")).agg((F.count("_has") == F.count(F.lit(1))).alias("_all")).where("_all").drop("_all")

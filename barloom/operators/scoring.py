"""Scores of runs, rankings, splits, forward observations, reconciliation of two feeds."""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators.joins import asof


def tanh_score(x: Column, scale: float) -> Column:
    """0 to 1, a half at 0."""
    return 0.5 + 0.5 * F.tanh(x / scale)


def linear_score(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - low) / (high - low)))


def rank_weighted(scores: list[Column]) -> Column:
    """Weights n, n - 1, ... 1 by order."""
    n = len(scores)
    return sum((s * (n - i) for i, s in enumerate(scores[1:], 1)), scores[0] * n) / (n * (n + 1) / 2)


def slippage_score(net: Column, gross: Column, traded: Column, bps: float) -> Column:
    """1 if still profitable after extra cost, 0 without gross profit, else the share of gross in gross and cost."""
    cost = traded * bps / 10000
    return F.when(net - cost > 0, 1.0).when(gross <= 0, 0.0).otherwise(gross / (gross + cost))


def fold_consistency(pnl: Column) -> Column:
    return F.avg((pnl > 0).cast("double")) / (1 + F.stddev_pop(pnl) / F.greatest(F.abs(F.avg(pnl)), F.lit(0.02)))


def run_stats(periods: DataFrame, keys: list[str], pnl: str, per_year: int, capital: float) -> DataFrame:
    """total, annualised return, sharpe and sortino of period results; null where they aren't defined."""
    p = F.col(pnl)
    a = periods.groupBy(*keys).agg(F.sum(p).alias("total"), F.count(F.lit(1)).alias("n"), F.avg(p).alias("m"), F.stddev_pop(p).alias("s"), F.sqrt(F.avg(F.when(p < 0, p * p).otherwise(0.0))).alias("d"))
    ret = F.col("total") / capital
    return a.withColumns(
        {
            "annualised": F.when(ret > -1, F.pow(1 + ret, F.lit(float(per_year)) / F.col("n")) - 1),
            "sharpe": F.when(F.col("s") != 0, F.col("m") / F.col("s") * per_year**0.5),
            "sortino": F.when(F.col("d") != 0, F.col("m") / F.col("d") * per_year**0.5),
        }
    )


def walk_forward(train: int, test: int, step: int, purge: int, folds: int) -> list[tuple[str, int, int]]:
    """(role, first bar, last bar) of each fold's train and test windows; purge bars lie between them."""
    out = []
    for k in range(folds):
        lo = k * step
        out += [(f"train_{k + 1}", lo, lo + train - 1), (f"test_{k + 1}", lo + train + purge, lo + train + purge + test - 1)]
    return out


def parameter_stability(runs: DataFrame, run: str, group: str, params: list[str], ret: str) -> DataFrame:
    """run and stability: how near its result is to the mean of runs that differ in one parameter (0.5 without any).

    Runs that agree in all parameters but one are one partition, so neighbours are sums, not pairs.
    """
    total, count = F.lit(0.0), F.lit(0)
    for p in params:
        others = Window.partitionBy(group, *(q for q in params if q != p))
        own = Window.partitionBy(group, *params)
        total = total + F.coalesce(F.sum(ret).over(others), F.lit(0.0)) - F.coalesce(F.sum(ret).over(own), F.lit(0.0))
        count = count + F.count(ret).over(others) - F.count(ret).over(own)
    out = runs.withColumns({"_total": total, "_count": count}).select(run, F.col(ret).alias("own"), F.when(F.col("_count") > 0, F.col("_total") / F.col("_count")).alias("mean"))
    return out.withColumn("stability", F.coalesce(1 - F.abs(F.col("own") - F.col("mean")) / F.greatest(F.abs(F.col("mean")), F.lit(0.05)), F.lit(0.5)))


def family_first(df: DataFrame, family: str, score: str, tie: str) -> DataFrame:
    """family_rank within the family, then overall_rank: all firsts of families, all seconds, and so on.

    Rows are sorted by family and by family rank; only counts per family rank meet in one task.
    """
    ranked = df.withColumn("family_rank", F.row_number().over(Window.partitionBy(family).orderBy(F.desc(score), tie)))
    before = F.sum("_n").over(Window.orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1))
    counts = ranked.groupBy(F.col("family_rank").alias("_rank")).agg(F.count(F.lit(1)).alias("_n")).select("_rank", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("family_rank").orderBy(F.desc(score), tie))
    return ranked.withColumn("_place", place).join(counts, F.col("family_rank") == F.col("_rank")).withColumn("overall_rank", F.col("_before") + F.col("_place")).drop("_rank", "_before", "_place")


def forward_observations(decisions: DataFrame, bars: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """Entry at the first bar at or after a decision; best, worst and last move over horizon bars from it."""
    f = Window.partitionBy(*keys).orderBy("ts").rowsBetween(0, horizon - 1)
    ahead = bars.select(
        *keys, F.col("ts").alias("bar_ts"), F.col("open").alias("entry"), F.count(F.lit(1)).over(f).alias("n_ahead"), F.max("high").over(f).alias("hi"), F.min("low").over(f).alias("lo"), F.last("close").over(f).alias("last_close")
    )
    got = asof(decisions, ahead, keys, "ts", "bar_ts", ["entry", "n_ahead", "hi", "lo", "last_close"], exact=True, forward=True)
    whole = F.col("n_ahead") == horizon
    status = F.when(F.col("matched_bar_ts").isNull(), "no_market_data").when(~whole, "no_forward_window").otherwise("ok")
    return got.withColumns(
        {"status": status, "mfe": F.when(whole, F.col("hi") - F.col("entry")), "mae": F.when(whole, F.col("entry") - F.col("lo")), "pnl": F.when(whole, F.col("last_close") - F.col("entry"))}
    )


def reconciled(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Both feeds by order: status, drift in basis points, and a gate whose threshold depends on the status group."""
    j = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "full")
    missing_a, missing_b = F.col("o_orderkey").isNull(), F.col("l_orderkey").isNull()
    drift = F.when(F.col("o_totalprice") != 0, F.abs(F.col("total") - F.col("o_totalprice")) / F.col("o_totalprice") * 10000)
    limit = F.when(F.col("o_orderstatus") == "F", 5000).otherwise(9000)
    status = F.when(missing_a, "unexpected").when(missing_b, "missing").otherwise("matched")
    gate = F.when(missing_a | missing_b, "FAIL").when(F.coalesce(drift, F.lit(0.0)) > limit, "FAIL").otherwise("PASS")
    return j.select(F.coalesce("o_orderkey", "l_orderkey").alias("o_orderkey"), status.alias("status"), drift.alias("drift_bps"), gate.alias("gate"))


# --- policy: thresholds, total score, constraints of trials ---------------------------------------

#: Weights of a run's total score.
WEIGHTS = {"objective": 0.30, "consistency": 0.20, "stability": 0.20, "slippage": 0.15, "preferred": 0.15}


@dataclass(frozen=True)
class Policy:
    """Thresholds that runs must meet."""

    folds: int = 2
    trades: int = 12
    trades_per_fold: int = 2
    positive_folds: float = 0.5
    drawdown: float = 0.35
    stability: float = 0.35
    slippage: float = 0.45

    def shortfalls(self) -> dict[str, Column]:
        """How much each of the seven is missed by, over columns folds, trades, least_trades, positive_folds, drawdown, stability, slippage; up to 0 it is met."""
        c = F.col
        per_fold = F.greatest(F.lit(1), F.least(F.lit(self.trades_per_fold), c("trades")))
        return {
            "min_fold_count": self.folds - c("folds"),
            "min_trade_count": self.trades - c("trades"),
            "min_trade_count_per_fold": per_fold - c("least_trades"),
            "min_positive_fold_ratio": self.positive_folds - c("positive_folds"),
            "max_drawdown": c("drawdown") - self.drawdown,
            "min_parameter_stability": self.stability - c("stability"),
            "min_slippage_score": self.slippage - c("slippage"),
        }


def total_score(**parts: Column) -> Column:
    """The weighted sum of objective, consistency, stability, slippage and preferred."""
    return sum((w * parts[k] for k, w in WEIGHTS.items()), F.lit(0.0))


def fold_summary(trades: DataFrame, run: str, fold: Column, unit: float) -> DataFrame:
    """run, folds, trades, least_trades, positive_folds, mean_return, consistency from trades' net_pnl."""
    f = trades.groupBy(F.col(run).alias("run_id"), fold.alias("_fold")).agg((F.sum("net_pnl") / unit).alias("_r"), F.count(F.lit(1)).alias("_k"))
    return f.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("folds"), F.sum("_k").alias("trades"), F.min("_k").alias("least_trades"), F.avg((F.col("_r") > 0).cast("double")).alias("positive_folds"),
        F.avg("_r").alias("mean_return"), F.least(F.lit(1.0), fold_consistency(F.col("_r"))).alias("consistency"),
    )


def nested_walk_forward(start: dt.date, end: dt.date, outer: tuple[int, int, int], inner: tuple[int, int, int], purge: int, embargo: int, warmup: int) -> list[dict]:
    """Windows of a nested plan: outer and inner are (train, test, step) in months; purge, embargo and warm-up in days. end is excluded.

    Every outer fold's training months hold inner folds; its test months confirm. A window's scores start a purge after its
    analysis ends, an embargo follows them, and indicators warm up before it starts.
    """

    def months(day: dt.date, n: int) -> dt.date:
        year, month = divmod(day.year * 12 + day.month - 1 + n, 12)
        return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))

    days = lambda n: dt.timedelta(days=n)
    out: list[dict] = []

    def window(name: str, role: str, lo: dt.date, cut: dt.date, hi: dt.date) -> dict:
        if cut + days(purge) >= hi:
            raise ValueError(f"the purge leaves nothing to score in {name}")
        return {"window_id": name, "role": role, "warmup_start": lo - days(warmup), "analysis_start": lo, "analysis_end": cut, "score_start": cut + days(purge), "score_end": hi, "embargo_end": hi + days(embargo)}

    k = 0
    while months(start, k * outer[2] + outer[0] + outer[1]) <= end:
        lo, cut, hi = (months(start, k * outer[2] + n) for n in (0, outer[0], outer[0] + outer[1]))
        j = 0
        while months(lo, j * inner[2] + inner[0] + inner[1]) <= cut:
            out.append(window(f"outer-{k + 1:02d}__inner-{j + 1:02d}", "optimization_validation", *(months(lo, j * inner[2] + n) for n in (0, inner[0], inner[0] + inner[1]))))
            j += 1
        if not j:
            raise ValueError("an outer fold is too short for an inner one")
        out.append(window(f"outer-{k + 1:02d}__confirmation", "confirmation", lo, cut, hi))
        k += 1
    if not out:
        raise ValueError("the time span is too short for an outer fold")
    return out


def execution_drifts(intents: DataFrame, orders: DataFrame, fills: DataFrame) -> DataFrame:
    """intent_id, broker_order_id, reason: where intended orders, a broker's orders and its fills disagree, one row for each reason.

    intents: intent_id, qty. orders: broker_order_id, intent_id, external_order_id, state, ts; the latest order of an intent
    counts. fills: broker_order_id, qty.
    """
    c = F.col
    got = fills.groupBy(c("broker_order_id").alias("_filled_id")).agg(F.sum("qty").alias("_filled"))
    latest = orders.groupBy(c("intent_id").alias("_intent")).agg(F.max_by(F.struct("broker_order_id", "external_order_id", "state"), F.struct("ts", "broker_order_id")).alias("_o")).select("_intent", "_o.*")
    j = intents.select("intent_id", "qty").join(latest, c("intent_id") == c("_intent"), "left").join(got, c("broker_order_id") == c("_filled_id"), "left")
    filled, there = F.coalesce("_filled", F.lit(0)), c("_intent").isNotNull()
    reasons = {
        "missing_broker_order_ack": ~there,
        "missing_external_order_id": there & (F.coalesce("external_order_id", F.lit("")) == ""),
        "stale_order_state_vs_fill": there & (filled > 0) & c("state").isin("new", "submitted", "replaced"),
        "filled_state_without_enough_fills": there & (c("state") == "filled") & (filled < c("qty")),
        "fill_qty_exceeds_expected": there & (filled > c("qty")),
    }
    named = F.filter(F.array(*(F.when(x, F.lit(k)) for k, x in reasons.items())), lambda v: v.isNotNull())
    drifts = j.select("intent_id", "broker_order_id", F.explode(named).alias("reason"))
    unexpected = orders.join(intents.select(c("intent_id").alias("_i")), c("intent_id") == c("_i"), "left_anti").select("intent_id", "broker_order_id", F.lit("unexpected_broker_order").alias("reason"))
    known = orders.select(c("broker_order_id").alias("_b")).distinct()
    orphans = fills.join(known, c("broker_order_id") == c("_b"), "left_anti").select(F.lit(None).cast(intents.schema["intent_id"].dataType).alias("intent_id"), "broker_order_id", F.lit("orphan_fill_without_order").alias("reason"))
    return drifts.unionByName(unexpected).unionByName(orphans)


def position_drifts(expected: DataFrame, observed: DataFrame, keys: list[str], tolerance: float = 1e-9) -> DataFrame:
    """keys and reason: missing, unexpected, quantity or average price (beyond the tolerance) of positions (qty, price)."""
    a = expected.select(*(F.col(k).alias(f"_a{i}") for i, k in enumerate(keys)), F.col("qty").alias("_aq"), F.col("price").alias("_ap"))
    b = observed.select(*keys, F.col("qty").alias("_bq"), F.col("price").alias("_bp"))
    on = reduce(lambda x, y: x & y, (F.col(f"_a{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys)))
    reason = F.when(F.col("_aq").isNull(), "unexpected_position").when(F.col("_bq").isNull(), "missing_position").when(F.col("_aq") != F.col("_bq"), "position_qty_mismatch").when(F.abs(F.col("_ap") - F.col("_bp")) > tolerance, "position_price_mismatch")
    return a.join(b, on, "full").select(*(F.coalesce(k, f"_a{i}").alias(k) for i, k in enumerate(keys)), reason.alias("reason")).where("reason IS NOT NULL")

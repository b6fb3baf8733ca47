"""The continuous input frame and the derived features, over adjusted hourly bars of the front contracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import features, recursive
from barloom.functions import indicators as I
from barloom.operators import bars as B
from barloom.operators import joins, roll
from barloom.plans import market
from barloom.plans.indicators import BASE, DM, MFM, UPDOWN, a_, agg, div, if_full, lag, o, recursion, sm, wma_sql
from barloom.plans.registry import query
from barloom.plans.research import EVENTS, LIQ, front

KEYS = "instrument_id ts:t"
P0 = f"""front AS (
    SELECT a.instrument_id, a.ts, a.maturity, count(g.seq) AS roll_epoch, coalesce(sum(g.gap), 0) AS offset0
    FROM act a LEFT JOIN gaps g ON g.instrument_id = a.instrument_id AND g.ts <= a.ts GROUP BY ALL
), contract_hours AS ({market._ohlc_sql('instrument_id, contract_id', 60)}),
p0 AS (
    SELECT h.instrument_id, h.ts, h.contract_id, open - offset0 AS open, high - offset0 AS high, low - offset0 AS low, close - offset0 AS close, volume, open_interest, h.n, roll_epoch, offset0
    FROM front f JOIN contract_hours h ON h.contract_id = f.instrument_id || '-' || f.maturity AND date_trunc('day', h.ts) = f.ts
)"""
P0_CTE = f"{market.CTE}, {LIQ}, {EVENTS}, {P0}{BASE.replace('FROM hourly', 'FROM p0')}"


def p0(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = market.daily(spark, sf_dir)
    ahead = front(spark, sf_dir)
    hours = B.ohlc(market.ticks(spark, sf_dir), ["instrument_id", "contract_id"], 60)
    return roll.input_frame(ahead, roll.roll_events(ahead, daily), hours, missing="keep")


def continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.base_metrics(p0(spark, sf_dir), ["instrument_id"])


@query(
    "roll_input_frame",
    f"{KEYS} contract_id open0:d high0:d low0:d close0:d hl2:d hlc3:d true_range0:d roll_epoch:i offset0:d row_hash",
    """SELECT *, open AS open0, high AS high0, low AS low0, close AS close0, (high + low) / 2 AS hl2, tp AS hlc3, true_range AS true_range0,
        sha256(instrument_id || '|' || contract_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || CAST(round(close * 1000) AS BIGINT) || '|' || volume || '|' || open_interest || '|' || roll_epoch) AS row_hash FROM base""",
    P0_CTE,
)
def _(spark, sf_dir):
    text = F.concat_ws("|", "instrument_id", "contract_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.round(F.col("close") * 1000).cast("long"), "volume", "open_interest", "roll_epoch")
    made = {f"{k}0": F.col(k) for k in ("open", "high", "low", "close", "true_range")}
    return continuous(spark, sf_dir).withColumns(made | {"hl2": (F.col("high") + F.col("low")) / 2, "hlc3": I.typical(), "row_hash": F.sha2(text, 256)})


# --- the wide frame as SQL ------------------------------------------------------------------------

FILTERS = [
    {k: v for n in (20, 50, 100, 200) for k, v in sm("close", f"ema_{n}", a_(n)).items()}
    | sm("true_range", "atr_14", 1 / 14) | sm("true_range", "rng", a_(20)) | sm("up", "g", 1 / 14) | sm("down", "l", 1 / 14)
    | sm("CASE WHEN hd IS NULL THEN NULL WHEN hd > ld AND hd > 0 THEN hd ELSE 0 END", "sp", 1 / 14) | sm("CASE WHEN hd IS NULL THEN NULL WHEN ld > hd AND ld > 0 THEN ld ELSE 0 END", "sn", 1 / 14)
    | sm("close", "c12", a_(12)) | sm("close", "c26", a_(26)) | sm("volume", "v12", a_(12)) | sm("volume", "v26", a_(26)) | sm("close - prev_close", "a1", a_(25)) | sm("abs(close - prev_close)", "b1", a_(25))
    | sm("close", "e1", a_(30)) | sm("(close - prev_close) * volume", "force_index_13", a_(13)) | sm("ad", "ad3", a_(3)) | sm("ad", "ad10", a_(10)),
    {"kc_upper_20_1_5": "ema_20 + 1.5 * rng", "kc_lower_20_1_5": "ema_20 - 1.5 * rng", "rsi_14": "100 * g / nullif(g + l, 0)", "dmp": "100 * sp / nullif(atr_14, 0)", "dmn": "100 * sn / nullif(atr_14, 0)",
     "macd_12_26_9": "c12 - c26", "ppo_12_26_9": "100 * (c12 - c26) / nullif(c26, 0)", "pvo_12_26_9": "100 * (v12 - v26) / nullif(v26, 0)", "adosc_3_10": "ad3 - ad10"}
    | sm("a1", "a2", a_(13)) | sm("b1", "b2", a_(13)) | sm("e1", "e2", a_(30)),
    {"dx": "100 * abs(dmp - dmn) / nullif(dmp + dmn, 0)", "tsi_25_13": "100 * a2 / nullif(b2, 0)"}
    | sm("macd_12_26_9", "macd_signal_12_26_9", a_(9)) | sm("ppo_12_26_9", "ppo_signal_12_26_9", a_(9)) | sm("pvo_12_26_9", "pvo_signal", a_(9)) | sm("e2", "e3", a_(30)),
    sm("dx", "adx_14", 1 / 14) | {"macd_hist_12_26_9": "macd_12_26_9 - macd_signal_12_26_9", "ppo_hist_12_26_9": "ppo_12_26_9 - ppo_signal_12_26_9", "pvo_hist_12_26_9": "pvo_12_26_9 - pvo_signal", "trix_30_9": "100 * (e3 / p_e3 - 1)"},
    sm("trix_30_9", "trix_signal_30_9", a_(9)),
]
OI, TODAY, WEEK = "open_interest", "OVER (PARTITION BY instrument_id, date_trunc('day', ts) ORDER BY ts ROWS UNBOUNDED PRECEDING)", "OVER (PARTITION BY instrument_id, date_trunc('week', ts) ORDER BY ts ROWS UNBOUNDED PRECEDING)"
STEPS = [
    {f"sma_{n}": agg("avg", "close", n) for n in (20, 50, 100, 200)}
    | {f"vwma_{n}": if_full(div(f"sum(close * volume) {o(n)}", f"sum(volume) {o(n)}"), "close", n) for n in (20, 100, 200)}
    | {f"raw_{n}": f"2 * ({wma_sql('close', n // 2)}) - ({wma_sql('close', n)})" for n in (20, 100, 200)}
    | {f"donchian_high_{n}": agg("max", "high", n) for n in (20, 55)} | {f"donchian_low_{n}": agg("min", "low", n) for n in (20, 55)}
    | {f"roc_of_{n}": div(f"100 * (close - {lag('close', n)})", lag("close", n)) for n in (10, 15, 20, 30)}
    | {
        "rolling_high_20": agg("max", "high", 20), "rolling_low_20": agg("min", "low", 20), "dev": agg("stddev_pop", "close", 20), "ptp": lag("tp"), "mean_tp": f"avg(tp) {o(20)}", "held_tp": f"list(tp) {o(20)}",
        "stoch": if_full(div(f"100 * (close - min(low) {o(14)})", f"max(high) {o(14)} - min(low) {o(14)}"), "low", 14), "mom_10": f"close - {lag('close', 10)}", "close_slope_20": f"degrees(atan((close - {lag('close', 20)}) / 20))",
        "willr_14": if_full(div(f"-100 * (max(high) {o(14)} - close)", f"max(high) {o(14)} - min(low) {o(14)}"), "high", 14), "cmf_20": if_full(div(f"sum({MFM} * volume) {o(20)}", f"sum(volume) {o(20)}"), "volume", 20),
        "chop_14": if_full(div(f"100 * log10({div(f'sum(true_range) {o(14)}', f'max(high) {o(14)} - min(low) {o(14)}')})", "log10(14.0)"), "true_range", 14),
        "obv": f"sum(volume * coalesce(sign(close - prev_close), 0)) {o()}", "ad": f"sum({MFM} * volume) {o()}", "pvt": f"sum(coalesce(ret_1, 0) * volume) {o()}", "oi_change_1": f"{OI} - {lag(OI)}",
        "oi_roc_10": div(f"100.0 * ({OI} - {lag(OI, 10)})", lag(OI, 10)), "oi_z_20": div(f"{OI} - {agg('avg', OI, 20)}", agg("stddev_pop", OI, 20)), "oi_relative_activity_20": div(OI, agg("avg", OI, 20)),
        "rvol_20": div("volume", agg("avg", "volume", 20)), "volume_zscore_20": div(f"volume - {agg('avg', 'volume', 20)}", agg("stddev_pop", "volume", 20)),
        "session_high": f"max(high) {TODAY}", "session_low": f"min(low) {TODAY}", "week_high": f"max(high) {WEEK}", "week_low": f"min(low) {WEEK}", "session_vwap": f"sum(tp * volume) {TODAY} / nullif(sum(volume) {TODAY}, 0)",
        "bp": "CASE WHEN prev_close IS NOT NULL THEN close - least(low, prev_close) END", "tr": "CASE WHEN prev_close IS NOT NULL THEN greatest(high, prev_close) - least(low, prev_close) END",
    },
    {f"hma_{n}": wma_sql(f"raw_{n}", r) for n, r in ((20, 4), (100, 10), (200, 14))}
    | {
        "bb_upper_20_2": "sma_20 + 2 * dev", "bb_lower_20_2": "sma_20 - 2 * dev", "bb_width_20_2": div("400 * dev", "sma_20"), "roc_10": "roc_of_10", "stoch_k_14_3_3": agg("avg", "stoch", 3),
        "kst_10_15_20_30": " + ".join(f"{k} * ({agg('avg', f'roc_of_{r}', n)})" for r, n, k in ((10, 10, 1), (15, 10, 2), (20, 10, 3), (30, 15, 4))),
        "cci_20": if_full(div("tp - mean_tp", "0.015 * list_sum(list_transform(held_tp, lambda v: abs(v - mean_tp))) / 20"), "tp", 20),
        "flow_up": "CASE WHEN tp > ptp THEN tp * volume ELSE 0 END", "flow_down": "CASE WHEN tp < ptp THEN tp * volume ELSE 0 END",
        "ultimate_oscillator_7_14_28": "100 * (" + " + ".join(f"{k} * ({if_full(div(f'sum(bp) {o(n)}', f'sum(tr) {o(n)}'), 'bp', n)})" for n, k in ((7, 4), (14, 2), (28, 1))) + ") / 7",
    },
    {"stoch_d_14_3_3": agg("avg", "stoch_k_14_3_3", 3), "kst_signal_9": agg("avg", "kst_10_15_20_30", 9), "mfi_14": if_full(div(f"100 * sum(flow_up) {o(14)}", f"sum(flow_up + flow_down) {o(14)}"), "ptp", 14)},
    {"rsi9": "round(rsi_14, 9)"},
    {"raw_rsi": if_full(div(f"100 * (rsi9 - min(rsi9) {o(14)})", f"max(rsi9) {o(14)} - min(rsi9) {o(14)}"), "rsi9", 14)},
    {"stochrsi_k_14_14_3_3": agg("avg", "raw_rsi", 3)},
    {"stochrsi_d_14_14_3_3": agg("avg", "stochrsi_k_14_14_3_3", 3)},
]


def stepped(body: str, steps: list[dict[str, str]]) -> str:
    for s in steps:
        body = f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in s.items())} FROM ({body})"
    return body


def wide_sql(source: str = "base") -> str:
    """The wide frame over a table like base."""
    run = recursion([*features.RECURSIVE], FILTERS, f"{UPDOWN}{DM}, sum({MFM} * volume) {o()} AS ad").replace(" FROM base)", f" FROM {source})")
    return stepped(f"SELECT b.*, {', '.join(f'r.{k}' for k in features.RECURSIVE)} FROM {source} b JOIN ({run}) r USING (instrument_id, ts)", STEPS)


def slope(x: str, n: int) -> str:
    return f"degrees(atan(({x} - {lag(x, n)}) / {n}))"


def one_epoch(n: int, x: str, rolls: bool) -> str:
    return f"CASE WHEN count(roll_epoch) {o(n)} = {n} AND min(roll_epoch) {o(n)} = max(roll_epoch) {o(n)} THEN {x} END" if rolls else x


def derived_steps(rolls: bool = True) -> list[dict[str, str]]:
    corr = lambda x, y: one_epoch(20, if_full(f"CASE WHEN stddev_pop({x}) {o(20)} > 1e-12 AND stddev_pop({y}) {o(20)} > 1e-12 THEN corr({x}, {y}) {o(20)} END", x, 20), rolls)
    crossing = {f"d_{k}": f"round({a} - {lag(b, n) if n else b}, 9)" for k, (a, b, n) in features.CROSSES.items()}
    first = {f"distance_to_{k}": div(f"close - {v}", "atr_14") for k, v in features.DISTANCES.items()} | {k: div(f"close - {x}", f"{y} - {x}") for k, (x, y) in features.POSITIONS.items()}
    first |= {f"{x}_change_1": f"{x} - {lag(x)}" for x in ("close", "roc_10", "mom_10")} | {"volume_diff": f"volume - {lag('volume')}", "volume_change_1": one_epoch(2, f"volume - {lag('volume')}", rolls)}
    first |= {f"{x}_slope_5": slope(x, 5) for x in ("sma_20", "ema_20")} | {f"divergence_price_{x}_score": f"close_slope_20 - {slope(x, 20)}" for x in features.PRICE_SOURCES}
    first |= {f"divergence_price_{x}_score": one_epoch(21, f"close_slope_20 - {slope(x, 20)}", rolls) for x in features.NATIVE_SOURCES}
    second = {k: f"CASE WHEN d_{k} IS NULL OR {lag(f'd_{k}')} IS NULL THEN NULL WHEN {lag(f'd_{k}')} <= 0 AND d_{k} > 0 THEN 1 WHEN {lag(f'd_{k}')} >= 0 AND d_{k} < 0 THEN -1 ELSE 0 END" for k in features.CROSSES}
    second |= {"price_volume_corr_20": corr("close_change_1", "volume_diff"), "price_oi_corr_20": corr("close_change_1", "oi_change_1"), "volume_oi_corr_20": corr("volume_diff", "oi_change_1")}
    return [first | crossing, second]


def family(name: str, doubles: list[str], longs: list[str] | None = None) -> None:
    def run(spark, sf_dir):
        return features.derived(features.wide(continuous(spark, sf_dir)))

    spec = " ".join([KEYS, *(f"{k}:d" for k in doubles), *(f"{k}:i" for k in longs or [])])
    query(name, spec, stepped(wide_sql(), derived_steps()), P0_CTE)(run)


family("der_distances", [f"distance_to_{k}" for k in features.DISTANCES])
family("der_positions", ["rolling_high_20", "rolling_low_20", *features.POSITIONS])
family("der_cross_codes", [], list(features.CROSSES))
family("der_changes", ["close_change_1", "roc_10_change_1", "mom_10_change_1", "volume_change_1", "sma_20_slope_5", "ema_20_slope_5", "close_slope_20", "oi_change_1", "rvol_20", "volume_zscore_20"])
family("der_correlations", ["price_volume_corr_20", "price_oi_corr_20", "volume_oi_corr_20"])
family("der_divergences", [f"divergence_price_{k}_score" for k in (*features.PRICE_SOURCES, *features.NATIVE_SOURCES)])


# --- coarser frames on finer ones -----------------------------------------------------------------


def frame(spark: SparkSession, sf_dir: str, minutes: int) -> DataFrame:
    """Bars of all instruments with close_ts, when they are closed."""
    df = B.base_metrics(B.ohlc(market.ticks(spark, sf_dir), ["instrument_id"], minutes), ["instrument_id"])
    return df.withColumn("close_ts", F.col("ts") + F.make_dt_interval(mins=F.lit(minutes)))


def base_of(minutes: int) -> str:
    """CTEs bars_m and base_m."""
    bars = f", bars_{minutes} AS ({market._ohlc_sql('instrument_id', minutes)})"
    return bars + BASE.replace("base AS", f"base_{minutes} AS").replace("FROM hourly", f"FROM bars_{minutes}")


def trend_columns(df: DataFrame) -> DataFrame:
    """A frame with the columns that finer ones carry."""

    def run(f):
        return f.assign(ema_20=recursive.ema(f["close"].to_numpy(), 20), ema_50=recursive.ema(f["close"].to_numpy(), 50), adx_14=I.directional(f)[0], rsi_14=I.rsi(f))

    out = recursive.over_series(df, ["instrument_id"], "ts", run, dict.fromkeys(features.MTF_COLUMNS, "double"))
    return out.withColumns({k: F.when(~F.isnan(k), F.col(k)) for k in features.MTF_COLUMNS})


MTF_OUT = [f"mtf_{a}_to_{b}_{k}" for a, b in features.MTF for k in features.MTF_COLUMNS]
TREND = [FILTERS[0], FILTERS[1], FILTERS[2], FILTERS[3]]


def trend_sql(minutes: int) -> str:
    run = recursion(list(features.MTF_COLUMNS), TREND, f"{UPDOWN}{DM}, sum({MFM} * volume) {o()} AS ad").replace(" FROM base)", f" FROM base_{minutes})")
    return f"(SELECT instrument_id AS i, ts + INTERVAL {minutes} MINUTE AS source_close, {', '.join(features.MTF_COLUMNS)} FROM ({run}))"


def _mtf_sql() -> str:
    parts = []
    for target in ("15m", "1h", "4h"):
        sources = [a for a, b in features.MTF if b == target]
        m = features.MINUTES[target]
        joined = " ".join(f"ASOF LEFT JOIN trend_{a} s{a} ON s{a}.i = b.instrument_id AND b.ts + INTERVAL {m} MINUTE >= s{a}.source_close" for a in sources)
        cols = ", ".join(f"s{a}.{k} AS mtf_{a}_to_{b}_{k}" if b == target else f"CAST(NULL AS DOUBLE) AS mtf_{a}_to_{b}_{k}" for a, b in features.MTF for k in features.MTF_COLUMNS)
        parts.append(f"SELECT '{target}' AS timeframe, b.instrument_id, b.ts, {cols} FROM bars_{m} b {joined}")
    return " UNION ALL ".join(parts)


@query(
    "der_mtf_overlay",
    f"timeframe {KEYS} " + " ".join(f"{k}:d" for k in MTF_OUT),
    _mtf_sql(),
    market.CTE + "".join(base_of(m) for m in features.MINUTES.values()) + "".join(f", trend_{a} AS {trend_sql(features.MINUTES[a])}" for a in ("1h", "4h", "1d")),
)
def _(spark, sf_dir):
    """Of each coarser frame the last bar that is closed when the finer one closes: one as-of join for each coarser frame."""
    out = None
    for target in ("15m", "1h", "4h"):
        own = frame(spark, sf_dir, features.MINUTES[target]).select(F.lit(target).alias("timeframe"), "instrument_id", "ts", "close_ts")
        out = own if out is None else out.unionByName(own)
    for a in ("1h", "4h", "1d"):
        carried = [f"_{a}_{k}" for k in features.MTF_COLUMNS]
        source = trend_columns(frame(spark, sf_dir, features.MINUTES[a]))
        right = source.select("instrument_id", F.col("close_ts").alias("source_close"), *(F.col(k).alias(n) for k, n in zip(features.MTF_COLUMNS, carried, strict=True)))
        out = joins.asof(out, right, ["instrument_id"], "close_ts", "source_close", carried, bucket=lambda t: F.date_trunc("day", t)).drop("matched_source_close")
    return out.select("timeframe", "instrument_id", "ts", *(F.when(F.col("timeframe") == b, F.col(f"_{a}_{k}")).alias(f"mtf_{a}_to_{b}_{k}") for a, b in features.MTF for k in features.MTF_COLUMNS))

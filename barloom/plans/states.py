"""Signal states of all strategies: hourly bars trigger, four-hour bars signal, days are the regime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import features
from barloom.operators import signals
from barloom.plans import market
from barloom.plans.indicators import W, agg, lag, o
from barloom.plans.registry import query
from barloom.plans.wide import base_of, derived_steps, frame, stepped, trend_columns, trend_sql, wide_sql

SPEC = "instrument_id ts:t long_state short_state"
MINUTES = {"trigger": 60, "signal": 240, "regime": 1440}
CTE = market.CTE + "".join(base_of(m) for m in MINUTES.values())
CTE += "".join(f", {name} AS (SELECT *, ts + INTERVAL {m} MINUTE AS close_ts FROM ({stepped(wide_sql(f'base_{m}'), derived_steps(False))}))" for name, m in MINUTES.items() if name != "regime")
CTE += f", regime AS (SELECT i AS instrument_id, source_close AS close_ts, * EXCLUDE (i, source_close) FROM {trend_sql(1440)})"


def frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = {name: features.derived(features.wide(frame(spark, sf_dir, m))) for name, m in MINUTES.items() if name != "regime"}
    return out | {"regime": trend_columns(frame(spark, sf_dir, 1440))}


def one_frame(name: str, sql: tuple[str, str], sides) -> None:
    """A strategy on hourly bars alone; states are false where features are missing."""

    def run(spark, sf_dir):
        up, down = sides()
        return frames(spark, sf_dir)["trigger"].withColumns({"long_state": F.coalesce(up, F.lit(False)), "short_state": F.coalesce(down, F.lit(False))})

    query(name, SPEC, f"SELECT instrument_id, ts, coalesce({sql[0]}, false) AS long_state, coalesce({sql[1]}, false) AS short_state FROM trigger", CTE)(run)


def held(x: str, n: int) -> str:
    return f"(sum(CASE WHEN {x} THEN 1 ELSE 0 END) {o(n)} = {n} AND count(*) {o(n)} = {n})" if n > 1 else f"coalesce({x}, false)"


def several(name: str, sql: dict[str, tuple[str, str]], conditions, confirm: int = 1) -> None:
    """sql: (long, short) by frame. Frames are matched by when their bars close, strictly before."""

    def run(spark, sf_dir):
        by = frames(spark, sf_dir)
        return signals.states({k: by[k] for k in sql}, conditions(), ["instrument_id"], "close_ts", confirm, bucket=lambda t: F.date_trunc("day", t))

    own = "".join(f", c_{k} AS (SELECT instrument_id, ts, close_ts, coalesce({a}, false) AS up, coalesce({b}, false) AS down FROM {k})" for k, (a, b) in ((k, v if k == "regime" else v) for k, v in sql.items()) if k != "regime")
    if "regime" in sql:
        own += f", c_regime AS (SELECT instrument_id, close_ts, coalesce({sql['regime'][0]}, false) AS up, coalesce({sql['regime'][1]}, false) AS down FROM regime)"
    others = [k for k in sql if k != "trigger"]
    joined = " ".join(f"ASOF LEFT JOIN c_{k} {k} ON {k}.instrument_id = t.instrument_id AND t.close_ts > {k}.close_ts" for k in others)
    every = {side: " AND ".join(["t." + side, *(f"coalesce({k}.{side}, false)" for k in others)]) for side in ("up", "down")}
    body = f"SELECT t.instrument_id, t.ts, {every['up']} AS long_state, {every['down']} AS short_state FROM c_trigger t {joined}"
    if confirm > 1:
        body = f"SELECT instrument_id, ts, {held('long_state', confirm)} AS long_state, {held('short_state', confirm)} AS short_state FROM ({body})"
    query(name, SPEC, body, CTE + own)(run)


def c(name: str) -> Column:
    return F.col(name)


one_frame("sig_ma_cross", ("ema_20 > ema_100 AND ema_20 >= ema_50", "ema_20 < ema_100 AND ema_20 <= ema_50"), lambda: signals.ma_cross(c("ema_20"), c("ema_100"), c("ema_20"), c("ema_50")))
one_frame(
    "sig_breakout",
    (f"adx_14 >= 18 AND close >= {lag('rolling_high_20')} ", f"adx_14 >= 18 AND close <= {lag('rolling_low_20')} "),
    lambda: signals.breakout(c("close"), F.lag("rolling_high_20").over(W()), F.lag("rolling_low_20").over(W()), c("adx_14"), c("atr_14"), 18, 0.0),
)
one_frame("sig_mean_reversion", ("rsi_14 <= 45 AND distance_to_session_vwap <= -0.3", "rsi_14 >= 55 AND distance_to_session_vwap >= 0.3"), lambda: signals.mean_reversion(c("rsi_14"), c("distance_to_session_vwap"), 45, 0.3))

REGIME = ("ema_20 > ema_50", "ema_20 < ema_50")
STRONG = ("ema_20 >= ema_50 AND adx_14 >= 12 AND rsi_14 >= 48", "ema_20 <= ema_50 AND adx_14 >= 12 AND rsi_14 <= 52")
NEAR = "least(abs(distance_to_ema_20_atr), abs(distance_to_ema_50_atr)) BETWEEN 0.05 AND 0.9 AND distance_to_ema_20_atr IS NOT NULL AND distance_to_ema_50_atr IS NOT NULL"
several(
    "sig_mtf_pullback",
    {"regime": REGIME, "signal": STRONG, "trigger": (held(f"{NEAR} AND close_slope_20 >= 1 AND ema_20_slope_5 >= 1", 2), held(f"{NEAR} AND close_slope_20 <= -1 AND ema_20_slope_5 <= -1", 2))},
    lambda: signals.mtf_pullback(W(), adx_min=12, slope_min=1, pullback_min=0.05, pullback_max=0.9, rsi_long=48, rsi_short=52, confirm=2),
)
CODES = ("cross_close_ema_20_code", "cross_close_sma_20_code", "macd_signal_cross_code", "ppo_signal_cross_code", "trix_signal_cross_code", "kst_signal_cross_code")
ALL_CODES = " AND ".join(f"{k} IS NOT NULL" for k in CODES)
several(
    "sig_trend_movement",
    {
        "regime": REGIME, "signal": STRONG,
        "trigger": (
            f"close_slope_20 >= 0.5 AND ema_20_slope_5 >= 0 AND roc_10_change_1 >= 1 AND mom_10_change_1 >= 0 AND {ALL_CODES} AND greatest({', '.join(CODES)}) > 0",
            f"close_slope_20 <= -0.5 AND ema_20_slope_5 <= 0 AND roc_10_change_1 <= -1 AND mom_10_change_1 <= 0 AND {ALL_CODES} AND least({', '.join(CODES)}) < 0",
        ),
    },
    lambda: signals.trend_movement(adx_min=12, slope_min=0.5, roc_min=1, rsi_long=48, rsi_short=52, require_cross=True),
)


def channel(n: int) -> dict[str, tuple[str, str]]:
    move = ("close_slope_20 >= 0 AND roc_10_change_1 >= 0 AND cross_close_rolling_high_20_code >= 0", "close_slope_20 <= 0 AND roc_10_change_1 <= 0 AND cross_close_rolling_low_20_code <= 0")
    return {
        "regime": REGIME,
        "signal": (f"ema_20 >= ema_50 AND adx_14 >= 10 AND close >= donchian_high_{n}", f"ema_20 <= ema_50 AND adx_14 >= 10 AND close <= donchian_low_{n}"),
        "trigger": (f"{move[0]} AND abs(distance_to_donchian_high_{n}_atr) <= 2", f"{move[1]} AND abs(distance_to_donchian_low_{n}_atr) <= 2"),
    }


for _n in (20, 55):
    several(f"sig_channel_continuation_{_n}", channel(_n), lambda n=_n: signals.channel_continuation(W(), n, adx_min=10, most=2.0))

SQUEEZED = "CASE WHEN bb_position_20_2 BETWEEN 0.35 AND 0.65 AND kc_position_20_1_5 BETWEEN 0.35 AND 0.65 AND bb_width_20_2 <= 400 THEN 1 ELSE 0 END"
SETUP = f"sum({SQUEEZED}) {o(2).replace('CURRENT ROW', '1 PRECEDING')} >= 1"
BEYOND = ("coalesce(cross_close_rolling_high_20_code > 0, false)", "coalesce(cross_close_rolling_low_20_code < 0, false)")
BANDS = ("coalesce(bb_position_20_2 >= 0.8 AND kc_position_20_1_5 >= 0.65, false)", "coalesce(bb_position_20_2 <= 0.2 AND kc_position_20_1_5 <= 0.35, false)")
for _mode, _sides in {
    "range_break": BEYOND, "band_break": BANDS, "movement_confirmed": (f"({BEYOND[0]} OR {BANDS[0]}) AND close_slope_20 >= 0.5", f"({BEYOND[1]} OR {BANDS[1]}) AND close_slope_20 <= -0.5"),
}.items():
    several(
        f"sig_squeeze_{_mode}",
        {"signal": (SETUP, SETUP), "trigger": tuple(f"{x} AND volume_zscore_20 >= -1.5" for x in _sides)},
        lambda mode=_mode: signals.squeeze_release(W(), width_max=40_000, min_bars=1, mode=mode, slope_min=0.5, volume_z_min=-1.5),
        confirm=2 if _mode == "band_break" else 1,
    )
POSITIONS = "bb_position_20_2, kc_position_20_1_5, rolling_position_20, session_position"
several(
    "sig_band_reversion",
    {"signal": ("adx_14 <= 94 AND chop_14 >= 75",) * 2, "trigger": (f"least({POSITIONS}) <= 0.1 AND rsi_14 <= 47 AND close_slope_20 <= 0", f"greatest({POSITIONS}) >= 0.9 AND rsi_14 >= 53 AND close_slope_20 >= 0")},
    lambda: signals.band_reversion(adx_max=94, chop_min=75, oversold=47, overbought=53),
)


def broke(x: str) -> str:
    return f"coalesce(max(CASE WHEN {x} THEN 1 ELSE 0 END) {o(4).replace('CURRENT ROW', '1 PRECEDING')}, 0) = 1"


MIDDLE = "(rolling_position_20 + donchian_position_20) / 2"
for _mode, _slopes in {"close_back_inside": ("", ""), "close_back_plus_momentum": (" AND close_slope_20 >= 0", " AND close_slope_20 <= 0")}.items():
    several(
        f"sig_failed_{_mode}",
        {"signal": ("adx_14 <= 94",) * 2, "trigger": (f"{broke('cross_close_rolling_low_20_code < 0')} AND {MIDDLE} >= 0.2{_slopes[0]}", f"{broke('cross_close_rolling_high_20_code > 0')} AND {MIDDLE} <= 0.8{_slopes[1]}")},
        lambda mode=_mode: signals.failed_breakout(W(), adx_max=94, window=3, mode=mode),
    )
KNOWN = "rolling_position_20 IS NOT NULL AND bb_position_20_2 IS NOT NULL"
LOW, HIGH = "least(rolling_position_20, bb_position_20_2)", "greatest(rolling_position_20, bb_position_20_2)"
for _source, _mode, _more in (
    ("rsi", "slope_turn", ("false", "false")), ("obv", "oscillator_reclaim", ("true", "true")), ("macd_hist", "cross_back_inside", (f"{LOW} > 0.3", f"{HIGH} < 0.7")),
):
    _score = f"divergence_price_{signals.DIVERGENCES[_source]}_score"
    several(
        f"sig_divergence_{_mode}",
        {
            "signal": (f"{_score} >= 0.5", f"{_score} <= -0.5"),
            "trigger": (f"{KNOWN} AND {LOW} <= 0.3 AND (close_slope_20 >= 0 OR coalesce({_more[0]}, false))", f"{KNOWN} AND {HIGH} >= 0.7 AND (close_slope_20 <= 0 OR coalesce({_more[1]}, false))"),
        },
        lambda source=_source, mode=_mode: signals.divergence(source, long_max=0.3, short_min=0.7, mode=mode),
    )


@query(
    "rank_candidates",
    "candidate_id run_id:i instrument_id ts:t side entry_ref:d stop_ref:d target_ref:d score:d",
    """SELECT *, 'CAND-' || upper(left(sha256('trend-v1|' || instrument_id || '|1h|' || strftime(ts, '%Y-%m-%d %H:%M:%S')), 12)) AS candidate_id, ema_20 AS entry_ref,
        CASE side WHEN 'long' THEN ema_20 - a ELSE ema_20 + a END AS stop_ref, CASE side WHEN 'long' THEN ema_20 + 2 * a ELSE ema_20 - 2 * a END AS target_ref, least(1, abs(ema_20 - ema_50) / a) AS score
        FROM (SELECT *, greatest(coalesce(atr_14, 0), 1e-9) AS a, CASE WHEN rvol_20 >= 1 AND ema_20 > ema_50 THEN 'long' WHEN rvol_20 >= 1 AND ema_20 < ema_50 THEN 'short' END AS side FROM trigger),
             (SELECT o_orderkey AS run_id FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) WHERE side IS NOT NULL""",
    CTE,
)
def _(spark, sf_dir):
    """Every bar with a side, for the latest run: a table of one row."""
    df = features.wide(frame(spark, sf_dir, 60))
    loud, way = c("rvol_20") >= 1, F.when(c("side") == "long", 1).otherwise(-1)
    side = F.when(loud & (c("ema_20") > c("ema_50")), "long").when(loud & (c("ema_20") < c("ema_50")), "short")
    df = df.withColumns({"side": side, "a": F.greatest(F.coalesce("atr_14", F.lit(0.0)), F.lit(1e-9))}).where("side IS NOT NULL")
    run = market.table(spark, sf_dir, "orders").agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("run_id"))
    key = F.concat_ws("|", F.lit("trend-v1"), "instrument_id", F.lit("1h"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    made = {"candidate_id": F.concat(F.lit("CAND-"), F.upper(F.substring(F.sha2(key, 256), 1, 12))), "entry_ref": c("ema_20"), "stop_ref": c("ema_20") - way * c("a"), "target_ref": c("ema_20") + 2 * way * c("a"), "score": F.least(F.lit(1.0), F.abs(c("ema_20") - c("ema_50")) / c("a"))}
    return df.withColumns(made).crossJoin(F.broadcast(run))  # one row

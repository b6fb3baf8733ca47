"""The wide feature frame: indicators of a series under one name each, and what is derived from them.

Bars have instrument_id, ts, bar_index, open to close, volume, open_interest, prev_close, ret_1 and true_range; prices are
adjusted for rolls. Where bars have roll_epoch, features of unadjusted volume and interest are null where their window crosses a roll.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from barloom.functions import indicators as I
from barloom.functions import recursive
from barloom.functions.derived import cross_code, position
from barloom.operators.windows import correlation, full, rows

#: Targets of distance_to_*, in average true ranges.
DISTANCES = {
    **{k: k for k in ("session_vwap", "session_high", "session_low", "week_high", "week_low", "rolling_high_20", "rolling_low_20")},
    **{f"{k}_atr": k for k in ("sma_20", "sma_50", "sma_100", "sma_200", "ema_20", "ema_50", "ema_100", "ema_200", "hma_20", "hma_100", "hma_200", "vwma_20", "vwma_100", "vwma_200")},
    **{f"{k}_atr": k for k in ("bb_upper_20_2", "bb_lower_20_2", "kc_upper_20_1_5", "kc_lower_20_1_5", "donchian_high_20", "donchian_low_20", "donchian_high_55", "donchian_low_55")},
}
#: Positions of the close between two levels.
POSITIONS = {
    "rolling_position_20": ("rolling_low_20", "rolling_high_20"), "session_position": ("session_low", "session_high"), "week_position": ("week_low", "week_high"),
    "bb_position_20_2": ("bb_lower_20_2", "bb_upper_20_2"), "kc_position_20_1_5": ("kc_lower_20_1_5", "kc_upper_20_1_5"),
    "donchian_position_20": ("donchian_low_20", "donchian_high_20"), "donchian_position_55": ("donchian_low_55", "donchian_high_55"),
}
#: Crosses, as (what crosses, what is crossed, bars by which that is older).
CROSSES = {
    "cross_close_sma_20_code": ("close", "sma_20", 0), "cross_close_ema_20_code": ("close", "ema_20", 0), "cross_close_session_vwap_code": ("close", "session_vwap", 0),
    "cross_close_rolling_high_20_code": ("close", "rolling_high_20", 1), "cross_close_rolling_low_20_code": ("close", "rolling_low_20", 1),
    "macd_signal_cross_code": ("macd_12_26_9", "macd_signal_12_26_9", 0), "ppo_signal_cross_code": ("ppo_12_26_9", "ppo_signal_12_26_9", 0),
    "trix_signal_cross_code": ("trix_30_9", "trix_signal_30_9", 0), "kst_signal_cross_code": ("kst_10_15_20_30", "kst_signal_9", 0),
}
#: Indicators that prices may diverge from; those of volume and interest are null where 21 bars cross a roll.
PRICE_SOURCES = ("rsi_14", "stoch_k_14_3_3", "stoch_d_14_3_3", "cci_20", "willr_14", "stochrsi_k_14_14_3_3", "stochrsi_d_14_14_3_3", "ultimate_oscillator_7_14_28", "macd_hist_12_26_9", "ppo_hist_12_26_9", "tsi_25_13", "roc_10")
NATIVE_SOURCES = ("obv", "mfi_14", "cmf_20", "ad", "adosc_3_10", "force_index_13", "pvt", "pvo_12_26_9", "pvo_hist_12_26_9", "oi_change_1", "oi_roc_10", "oi_z_20", "oi_relative_activity_20")
#: Columns that coarser frames carry to finer ones, and which to which.
MTF_COLUMNS = ("ema_20", "ema_50", "adx_14", "rsi_14")
MTF = (("1h", "15m"), ("4h", "15m"), ("4h", "1h"), ("1d", "15m"), ("1d", "1h"), ("1d", "4h"))
MINUTES = {"15m": 15, "1h": 60, "4h": 240, "1d": 1440}

RECURSIVE = (
    *(f"ema_{n}" for n in (20, 50, 100, 200)), "atr_14", "adx_14", "rsi_14", "macd_12_26_9", "macd_signal_12_26_9", "macd_hist_12_26_9", "ppo_12_26_9", "ppo_signal_12_26_9", "ppo_hist_12_26_9",
    "pvo_12_26_9", "pvo_hist_12_26_9", "kc_upper_20_1_5", "kc_lower_20_1_5", "tsi_25_13", "trix_30_9", "trix_signal_30_9", "force_index_13", "adosc_3_10",
)


def filters(f: pd.DataFrame) -> pd.DataFrame:
    """The recursive indicators of one ordered series, which has `ad`."""
    close, volume = f["close"].to_numpy(float), f["volume"].to_numpy(float)
    atr, width = I.atr(f), recursive.ema(I.true_range(f), 20)
    mid = recursive.ema(close, 20)
    line, signal, hist = I.macd(close)
    share, share_signal, share_hist = I.percent_oscillator(close)
    pvo, _, pvo_hist = I.percent_oscillator(volume)
    trix, trix_signal = I.trix(close)
    made = {
        **{f"ema_{n}": recursive.ema(close, n) for n in (20, 50, 100, 200)}, "atr_14": atr, "adx_14": I.directional(f)[0], "rsi_14": I.rsi(f),
        "macd_12_26_9": line, "macd_signal_12_26_9": signal, "macd_hist_12_26_9": hist, "ppo_12_26_9": share, "ppo_signal_12_26_9": share_signal, "ppo_hist_12_26_9": share_hist,
        "pvo_12_26_9": pvo, "pvo_hist_12_26_9": pvo_hist, "kc_upper_20_1_5": mid + 1.5 * width, "kc_lower_20_1_5": mid - 1.5 * width, "tsi_25_13": I.tsi(f["close"]),
        "trix_30_9": trix, "trix_signal_30_9": trix_signal, "force_index_13": recursive.ema(f["close"].diff().to_numpy() * volume, 13),
        "adosc_3_10": recursive.ema(f["ad"].to_numpy(float), 3) - recursive.ema(f["ad"].to_numpy(float), 10),
    }
    return f.assign(**{k: np.asarray(made[k], float) for k in RECURSIVE})


def series_window() -> WindowSpec:
    return Window.partitionBy("instrument_id").orderBy("ts")


def wide(bars: DataFrame) -> DataFrame:
    """bars with every indicator that derived features need. A series' windows share one sort; filters are one pass in Python."""
    w, c = series_window(), F.col
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    day, week = (Window.partitionBy("instrument_id", F.date_trunc(k, "ts")).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0) for k in ("day", "week"))
    at, oi, volume = c("bar_index"), c("open_interest"), c("volume")
    flow = F.sum(I.money_flow_multiplier() * volume).over(so_far)
    kst = ((10, 10, 1), (15, 10, 2), (20, 10, 3), (30, 15, 4))
    steps: list[dict[str, Column]] = [
        {
            **{f"sma_{n}": I.sma(w, n) for n in (20, 50, 100, 200)}, **{f"vwma_{n}": I.vwma(w, n) for n in (20, 100, 200)},
            **{f"_raw_{n}": 2 * I.wma(w, n // 2, c("close"), at) - I.wma(w, n, c("close"), at) for n in (20, 100, 200)},
            **{f"donchian_{k}_{n}": v for n in (20, 55) for k, v in (("high", I.highest(w, n)), ("low", I.lowest(w, n)))},
            "rolling_high_20": I.highest(w, 20), "rolling_low_20": I.lowest(w, 20), "_dev": I.std(w, 20), "_stoch": I.raw_stochastic(w), "_tp": I.typical(), "_ptp": F.lag(I.typical()).over(w),
            **{f"_roc_{n}": I.roc(w, n) for n, _, _ in kst}, "roc_10": I.roc(w, 10), "mom_10": I.momentum(w, 10), "cci_20": I.cci(w), "willr_14": I.williams_r(w), "chop_14": I.chop(w), "cmf_20": I.cmf(w),
            "close_slope_20": I.slope_degrees(w, 20), "obv": F.sum(volume * F.coalesce(F.signum(c("close") - c("prev_close")), F.lit(0.0))).over(so_far), "ad": flow.cast("double"),
            "pvt": F.sum(F.coalesce(c("ret_1"), F.lit(0.0)) * volume).over(so_far), "oi_change_1": I.momentum(w, 1, oi).cast("double"), "oi_roc_10": I.roc(w, 10, oi), "oi_z_20": I.z_score(w, 20, oi),
            "oi_relative_activity_20": I.ratio(oi, I.sma(w, 20, oi)), "rvol_20": I.ratio(volume, I.sma(w, 20, volume)), "volume_zscore_20": I.z_score(w, 20, volume),
            "session_high": F.max("high").over(day), "session_low": F.min("low").over(day), "week_high": F.max("high").over(week), "week_low": F.min("low").over(week),
            "session_vwap": I.ratio(F.sum(I.typical() * volume).over(day), F.sum(volume).over(day)),
            "_bp": F.when(c("prev_close").isNotNull(), c("close") - F.least("low", "prev_close")), "_tr": F.when(c("prev_close").isNotNull(), F.greatest("high", "prev_close") - F.least("low", "prev_close")),
        },
        {
            **{f"hma_{n}": I.wma(w, r, c(f"_raw_{n}"), at) for n, r in ((20, 4), (100, 10), (200, 14))}, "bb_upper_20_2": c("sma_20") + 2 * c("_dev"), "bb_lower_20_2": c("sma_20") - 2 * c("_dev"),
            "bb_width_20_2": I.ratio(400 * c("_dev"), c("sma_20")), "stoch_k_14_3_3": I.sma(w, 3, c("_stoch")), "kst_10_15_20_30": sum((k * I.sma(w, n, c(f"_roc_{r}")) for r, n, k in kst[1:]), I.sma(w, 10, c("_roc_10"))),
            "_up": F.when(c("_tp") > c("_ptp"), c("_tp") * volume).otherwise(0.0), "_down": F.when(c("_tp") < c("_ptp"), c("_tp") * volume).otherwise(0.0),
            "ultimate_oscillator_7_14_28": 100 * sum((k * full(I.ratio(F.sum("_bp").over(rows(w, n)), F.sum("_tr").over(rows(w, n))), c("_bp"), w, n) for n, k in ((7, 4), (14, 2), (28, 1))), F.lit(0.0)) / 7,
        },
        {
            "stoch_d_14_3_3": I.sma(w, 3, c("stoch_k_14_3_3")), "kst_signal_9": I.sma(w, 9, c("kst_10_15_20_30")),
            "mfi_14": full(I.ratio(100 * F.sum("_up").over(rows(w, 14)), F.sum(c("_up") + c("_down")).over(rows(w, 14))), c("_ptp"), w, 14),
        },
    ]
    df = bars
    for step in steps:
        df = df.withColumns(step)
    df = df.drop(*(k for k in df.columns if k.startswith("_")))
    df = recursive.over_series(df, ["instrument_id"], "ts", filters, dict.fromkeys(RECURSIVE, "double"))
    df = df.withColumns({k: F.when(~F.isnan(k), F.col(k)) for k in RECURSIVE}).withColumn("_rsi", F.round("rsi_14", 9))
    low, high = I.lowest(w, 14, c("_rsi")), I.highest(w, 14, c("_rsi"))
    df = df.withColumn("_raw", I.ratio(100 * (c("_rsi") - low), high - low)).withColumn("stochrsi_k_14_14_3_3", I.sma(w, 3, c("_raw")))
    return df.withColumn("stochrsi_d_14_14_3_3", I.sma(w, 3, c("stochrsi_k_14_14_3_3"))).drop("_rsi", "_raw")


def crosses_roll(df: DataFrame, n: int) -> Column:
    """Whether the last n bars aren't all there or lie in several roll epochs; never where bars don't roll."""
    if "roll_epoch" not in df.columns:
        return F.lit(False)
    frame = rows(series_window(), n)
    return (F.count("roll_epoch").over(frame) < n) | (F.min("roll_epoch").over(frame) != F.max("roll_epoch").over(frame))


def derived(df: DataFrame) -> DataFrame:
    """The wide frame with distances, positions, crosses, changes, slopes, correlations and divergences."""
    w, c = series_window(), F.col
    made = {f"distance_to_{k}": I.ratio(c("close") - c(v), c("atr_14")) for k, v in DISTANCES.items()}
    made |= {k: position(c(lo), c(hi)) for k, (lo, hi) in POSITIONS.items()}
    made |= {f"_{k}": F.round(c(a) - (F.lag(b, n).over(w) if n else c(b)), 9) for k, (a, b, n) in CROSSES.items()}
    step = {k: I.momentum(w, 1, c(x)) for k, x in (("close_change_1", "close"), ("roc_10_change_1", "roc_10"), ("mom_10_change_1", "mom_10"))}
    made |= step | {"volume_change_1": F.when(~crosses_roll(df, 2), I.momentum(w, 1, c("volume"))).cast("double"), "_volume": I.momentum(w, 1, c("volume")).cast("double")}
    made |= {f"{k}_slope_5": I.slope_degrees(w, 5, c(k)) for k in ("sma_20", "ema_20")}
    other = crosses_roll(df, 21)
    made |= {f"divergence_price_{k}_score": c("close_slope_20") - I.slope_degrees(w, 20, c(k)) for k in PRICE_SOURCES}
    made |= {f"divergence_price_{k}_score": F.when(~other, c("close_slope_20") - I.slope_degrees(w, 20, c(k))) for k in NATIVE_SOURCES}
    out = df.withColumns(made)
    pairs = {"price_volume_corr_20": ("close_change_1", "_volume"), "price_oi_corr_20": ("close_change_1", "oi_change_1"), "volume_oi_corr_20": ("_volume", "oi_change_1")}
    same = {k: F.when(~crosses_roll(df, 20), correlation(c(a), c(b), w, 20)) for k, (a, b) in pairs.items()}
    return out.withColumns(same | {k: cross_code(c(f"_{k}"), w) for k in CROSSES}).drop("_volume", *(f"_{k}" for k in CROSSES))

"""Signal states of strategies and the events they give; all states are columns over features."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from barloom.operators.joins import asof


def edges(df: DataFrame, state: str, w: WindowSpec, delay: int = 1) -> DataFrame:
    """entry where state rose and exit where it fell, `delay` bars later."""
    prev = F.coalesce(F.lag(state).over(w), F.lit(False))
    out = df.withColumns({"_rise": F.col(state) & ~prev, "_fall": ~F.col(state) & prev})
    return out.withColumns({"entry": F.coalesce(F.lag("_rise", delay).over(w), F.lit(False)), "exit": F.coalesce(F.lag("_fall", delay).over(w), F.lit(False))}).drop("_rise", "_fall")


def confirmed(state: Column, w: WindowSpec, n: int) -> Column:
    """All of the last n bars hold."""
    frame = w.rowsBetween(-(n - 1), 0)
    return (F.sum(state.cast("int")).over(frame) == n) & (F.count(F.lit(1)).over(frame) == n)


def held(state: Column, w: WindowSpec, n: int) -> Column:
    """confirmed, where missing features don't hold; one bar is the state itself."""
    state = F.coalesce(state, F.lit(False))
    return state if n <= 1 else confirmed(state, w, n)


def recent(state: Column, w: WindowSpec, n: int) -> Column:
    """Any of the n bars before this one holds."""
    return F.coalesce(F.max(state.cast("int")).over(w.rowsBetween(-n, -1)), F.lit(0)) == 1


def ma_cross(fast: Column, slow: Column, trend_fast: Column, trend_slow: Column) -> tuple[Column, Column]:
    return (fast > slow) & (trend_fast >= trend_slow), (fast < slow) & (trend_fast <= trend_slow)


def breakout(close: Column, high: Column, low: Column, adx: Column, atr: Column, least: float, buffer: float) -> tuple[Column, Column]:
    """high and low are the levels of the bar before."""
    return (adx >= least) & (close >= high + buffer * atr), (adx >= least) & (close <= low - buffer * atr)


def mean_reversion(rsi: Column, distance: Column, level: float, far: float) -> tuple[Column, Column]:
    return (rsi <= level) & (distance <= -far), (rsi >= 100 - level) & (distance >= far)


# --- strategies over several timeframes: conditions by frame, each a pair (long, short) -------------

Sides = tuple[Column, Column]


def _c(name: str) -> Column:
    return F.col(name)


def _both(*pairs: Sides) -> Sides:
    return reduce(lambda a, b: a & b, (p[0] for p in pairs)), reduce(lambda a, b: a & b, (p[1] for p in pairs))


def _alike(x: Column) -> Sides:
    return x, x


def _mirror(x: Column, least: float) -> Sides:
    """At least so much for long, at most its negative for short."""
    return x >= least, x <= -least


def _extreme(fn: Callable[..., Column], *columns: Column) -> Column:
    """Least or greatest, null if any is null."""
    return F.when(reduce(lambda a, b: a & b, (x.isNotNull() for x in columns)), fn(*columns))


def trend(strict: bool) -> Sides:
    """The 20 over the 50 average, and under it."""
    return (_c("ema_20") > _c("ema_50"), _c("ema_20") < _c("ema_50")) if strict else (_c("ema_20") >= _c("ema_50"), _c("ema_20") <= _c("ema_50"))


def strength(adx_min: float, rsi_long: float, rsi_short: float) -> Sides:
    """Trend, strength and momentum of the signal frame."""
    return _both(trend(False), _alike(_c("adx_14") >= adx_min), (_c("rsi_14") >= rsi_long, _c("rsi_14") <= rsi_short))


def mtf_pullback(w: WindowSpec, adx_min: float = 18.0, slope_min: float = 0.0, pullback_min: float = 0.0, pullback_max: float = 0.8, rsi_long: float = 50.0, rsi_short: float = 50.0, confirm: int = 1) -> dict[str, Sides]:
    """A pullback to an average in the direction of the regime's and the signal's trend, held for some bars."""
    near = _extreme(F.least, F.abs("distance_to_ema_20_atr"), F.abs("distance_to_ema_50_atr"))
    trigger = _both(_alike(near.between(pullback_min, pullback_max)), _mirror(_c("close_slope_20"), slope_min), _mirror(_c("ema_20_slope_5"), slope_min))
    return {"regime": trend(True), "signal": strength(adx_min, rsi_long, rsi_short), "trigger": tuple(held(x, w, confirm) for x in trigger)}


def trend_movement(adx_min: float = 18.0, slope_min: float = 0.0, ema_slope_min: float = 0.0, roc_min: float = 0.0, mom_min: float = 0.0, rsi_long: float = 50.0, rsi_short: float = 50.0, require_cross: bool = False) -> dict[str, Sides]:
    """Movement with the trend: slopes and changes of momentum, and if wanted a cross of one of six pairs of lines."""
    crosses = [_c(k) for k in ("cross_close_ema_20_code", "cross_close_sma_20_code", "macd_signal_cross_code", "ppo_signal_cross_code", "trix_signal_cross_code", "kst_signal_cross_code")]
    trigger = _both(_mirror(_c("close_slope_20"), slope_min), _mirror(_c("ema_20_slope_5"), ema_slope_min), _mirror(_c("roc_10_change_1"), roc_min), _mirror(_c("mom_10_change_1"), mom_min))
    if require_cross:
        trigger = _both(trigger, (_extreme(F.greatest, *crosses) > 0, _extreme(F.least, *crosses) < 0))
    return {"regime": trend(True), "signal": strength(adx_min, rsi_long, rsi_short), "trigger": trigger}


def channel_continuation(w: WindowSpec, channel: int = 20, adx_min: float = 18.0, slope_min: float = 0.0, most: float = 1.0, confirm: int = 1) -> dict[str, Sides]:
    """A close at the edge of the signal's channel, with the trend, and not far from it on the trigger's frame."""
    edge = (_c("close") >= _c(f"donchian_high_{channel}"), _c("close") <= _c(f"donchian_low_{channel}"))
    near = tuple(F.abs(f"distance_to_donchian_{k}_{channel}_atr") <= most for k in ("high", "low"))
    moving = _both(_mirror(_c("close_slope_20"), slope_min), _mirror(_c("roc_10_change_1"), 0.0), (_c("cross_close_rolling_high_20_code") >= 0, _c("cross_close_rolling_low_20_code") <= 0), near)
    return {"regime": trend(True), "signal": _both(trend(False), _alike(_c("adx_14") >= adx_min), edge), "trigger": tuple(held(x, w, confirm) for x in moving)}


def squeeze_release(w: WindowSpec, width_max: float = 0.2, min_bars: int = 3, mode: str = "range_break", slope_min: float = 0.0, volume_z_min: float | None = None) -> dict[str, Sides]:
    """The signal's close in mid-channel and its bands narrow for some bars before; then the trigger's close breaks out.

    width_max is a raw limit, a number over 1 counts as percent of 1. mode: range_break (of the 20 bars' range), band_break (of both
    bands), movement_confirmed (either, with the slope). Confirmation over several bars is for the caller: of all frames together.
    """
    middle = _c("bb_position_20_2").between(0.35, 0.65) & _c("kc_position_20_1_5").between(0.35, 0.65)
    squeezed = F.coalesce(middle & (_c("bb_width_20_2") <= (width_max / 100 if width_max > 1 else width_max)), F.lit(False))
    setup = F.coalesce(F.sum(squeezed.cast("int")).over(w.rowsBetween(-min_bars, -1)) >= min_bars, F.lit(False))
    beyond = (_c("cross_close_rolling_high_20_code") > 0, _c("cross_close_rolling_low_20_code") < 0)
    bands = ((_c("bb_position_20_2") >= 0.8) & (_c("kc_position_20_1_5") >= 0.65), (_c("bb_position_20_2") <= 0.2) & (_c("kc_position_20_1_5") <= 0.35))
    either = tuple(F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)) for a, b in zip(beyond, bands, strict=True))
    release = {"range_break": beyond, "band_break": bands, "movement_confirmed": _both(either, _mirror(_c("close_slope_20"), slope_min))}[mode]
    loud = _c("volume_zscore_20") >= (float("-inf") if volume_z_min is None else volume_z_min)
    return {"signal": _alike(setup), "trigger": _both(release, _alike(loud))}


def band_reversion(adx_max: float = 20.0, chop_min: float = 55.0, long_max: float = 0.1, short_min: float = 0.9, oversold: float = 30.0, overbought: float = 70.0) -> dict[str, Sides]:
    """At the edge of a range, without trend: any of four positions is extreme (missing ones don't count), momentum too, the slope still that way."""
    positions = [_c(k) for k in ("bb_position_20_2", "kc_position_20_1_5", "rolling_position_20", "session_position")]
    extreme = (F.least(*positions) <= long_max, F.greatest(*positions) >= short_min)
    momentum = ((_c("rsi_14") <= oversold) & (_c("close_slope_20") <= 0), (_c("rsi_14") >= overbought) & (_c("close_slope_20") >= 0))
    return {"signal": _alike((_c("adx_14") <= adx_max) & (_c("chop_14") >= chop_min)), "trigger": _both(extreme, momentum)}


def failed_breakout(w: WindowSpec, adx_max: float = 22.0, window: int = 2, mode: str = "close_back_inside") -> dict[str, Sides]:
    """A break of the range within the bars before, the close back inside, without trend; with mode close_back_plus_momentum the slope agrees."""
    broke = (recent(F.coalesce(_c("cross_close_rolling_low_20_code") < 0, F.lit(False)), w, window), recent(F.coalesce(_c("cross_close_rolling_high_20_code") > 0, F.lit(False)), w, window))
    middle = (_c("rolling_position_20") + _c("donchian_position_20")) / 2
    inside = (middle >= 0.2, middle <= 0.8)
    trigger = _both(broke, inside, _mirror(_c("close_slope_20"), 0.0)) if mode == "close_back_plus_momentum" else _both(broke, inside)
    return {"signal": _alike(_c("adx_14") <= adx_max), "trigger": trigger}


#: Names of divergence sources.
DIVERGENCES = {"rsi": "rsi_14", "macd_hist": "macd_hist_12_26_9", "ppo_hist": "ppo_hist_12_26_9", "tsi": "tsi_25_13", "mfi": "mfi_14", "cmf": "cmf_20", "obv": "obv", "oi_change": "oi_change_1"}


def divergence(source: str = "rsi", least: float = 0.5, long_max: float = 0.1, short_min: float = 0.9, mode: str = "slope_turn") -> dict[str, Sides]:
    """Price and an indicator of the signal's frame diverge while the close is at an edge; mode: slope_turn, cross_back_inside or oscillator_reclaim."""
    score = _c(f"divergence_price_{DIVERGENCES.get(source, 'rsi_14')}_score")
    low, high = (_extreme(f, _c("rolling_position_20"), _c("bb_position_20_2")) for f in (F.least, F.greatest))
    turned = _mirror(_c("close_slope_20"), 0.0)
    back = {"cross_back_inside": (low > long_max, high < short_min), "oscillator_reclaim": _alike(F.lit(True))}.get(mode, _alike(F.lit(False)))
    confirmed_by = tuple(F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)) for a, b in zip(turned, back, strict=True))
    return {"signal": _mirror(score, least), "trigger": _both((low <= long_max, high >= short_min), confirmed_by)}


def states(frames: dict[str, DataFrame], conditions: dict[str, Sides], keys: list[str], ts: str, confirm: int = 1, bucket: Callable[[Column], Column] | None = None) -> DataFrame:
    """The trigger's frame with long_state and short_state: all conditions hold; missing features make them false.

    Conditions of other frames are those of their last bar with an earlier ts, which should be when a bar is closed.
    confirm: all of the last so many bars, of the frames together.
    """
    off = F.lit(False)
    out = frames["trigger"].withColumns({"long_state": F.coalesce(conditions["trigger"][0], off), "short_state": F.coalesce(conditions["trigger"][1], off)})
    for name, sides in conditions.items():
        if name == "trigger":
            continue
        got = frames[name].select(*keys, F.col(ts).alias(f"_{name}_ts"), *(F.coalesce(x, off).alias(f"_{name}_{k}") for k, x in zip(("long", "short"), sides, strict=True)))
        out = asof(out, got, keys, ts, f"_{name}_ts", [f"_{name}_long", f"_{name}_short"], exact=False, bucket=bucket)
        out = out.withColumns({f"{k}_state": F.col(f"{k}_state") & F.coalesce(f"_{name}_{k}", off) for k in ("long", "short")}).drop(f"matched__{name}_ts", f"_{name}_long", f"_{name}_short")
    w = Window.partitionBy(*keys).orderBy(ts)
    return out.withColumns({k: held(F.col(k), w, confirm) for k in ("long_state", "short_state")}) if confirm > 1 else out


def session_entry(hour: Column, first: int, last: int) -> Column:
    """Hours from first to last, which may lie past midnight."""
    return hour.between(first, last) if first <= last else (hour >= first) | (hour <= last)


def stops(price: Column, atr: Column, k: float, side: Column) -> Column:
    return F.when(side == "long", price - k * atr).when(side == "short", price + k * atr)


def alternated(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Entries and exits that take turns: repeated events of the same kind are left out."""
    marked = df.withColumn("_kind", F.when(F.col("entry"), 1).when(F.col("exit"), -1)).where("_kind IS NOT NULL")
    w = Window.partitionBy(*keys).orderBy(order)
    return marked.withColumn("_prev", F.coalesce(F.lag("_kind").over(w), F.lit(-1))).where("_kind <> _prev").withColumn("event", F.when(F.col("_kind") == 1, "entry").otherwise("exit")).drop("_kind", "_prev")

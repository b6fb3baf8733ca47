"""Technical indicators on bars (columns ts, open, high, low, close, volume, open_interest).

Window indicators are column expressions over a window that a series' key and time order give; they
are null until their window is full. Recursive ones work on ordered frames (see recursive.py) and
start from the first value. register_indicator adds one's own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from barloom.functions.recursive import ema, wilder
from barloom.operators.windows import full, rolling, rows

REGISTRY: dict[str, Callable[[WindowSpec], dict[str, Column]]] = {}


def register_indicator(name: str, fn: Callable[[WindowSpec], dict[str, Column]]) -> None:
    REGISTRY[name] = fn


def apply_registered(df: DataFrame, w: WindowSpec, names: list[str]) -> DataFrame:
    """df with the columns of registered indicators; an unknown name raises KeyError."""
    made: dict[str, Column] = {}
    for name in names:
        made |= REGISTRY[name](w)
    return df.withColumns(made)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.when(b != 0, a / b)


def c(name: str = "close") -> Column:
    return F.col(name)


def typical() -> Column:
    return (c("high") + c("low") + c("close")) / 3


def sma(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    return rolling(F.avg, c() if x is None else x, w, n)


def std(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    return rolling(F.stddev_pop, c() if x is None else x, w, n)


def highest(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    return rolling(F.max, c("high") if x is None else x, w, n)


def lowest(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    return rolling(F.min, c("low") if x is None else x, w, n)


def wma(w: WindowSpec, n: int, x: Column, at: Column | None = None) -> Column:
    """Weights 1 to n, the newest row heaviest. With at, the row's number in the series, two sums in constant memory; else the last n values are held."""
    if at is not None:
        total = F.sum(at * x).over(rows(w, n)) - (at - n) * F.sum(x).over(rows(w, n))
        return full(total / (n * (n + 1) / 2), x, w, n)
    held = F.collect_list(x).over(rows(w, n))
    total = F.aggregate(F.transform(held, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return full(total / (n * (n + 1) / 2), x, w, n)


def roc(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    x = c() if x is None else x
    return ratio(100 * (x - F.lag(x, n).over(w)), F.lag(x, n).over(w))


def momentum(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    x = c() if x is None else x
    return x - F.lag(x, n).over(w)


def slope_degrees(w: WindowSpec, n: int, x: Column | None = None) -> Column:
    return F.degrees(F.atan(momentum(w, n, x) / n))


def bollinger(w: WindowSpec, n: int = 20, k: float = 2.0) -> dict[str, Column]:
    mid, dev = sma(w, n), std(w, n)
    up, low = mid + k * dev, mid - k * dev
    return {"bb_upper": up, "bb_mid": mid, "bb_lower": low, "bb_width": ratio(100 * (up - low), mid), "bb_percent_b": ratio(c() - low, up - low)}


def donchian(w: WindowSpec, n: int) -> dict[str, Column]:
    hi, lo = highest(w, n), lowest(w, n)
    return {f"donchian_high_{n}": hi, f"donchian_low_{n}": lo, f"donchian_mid_{n}": (hi + lo) / 2, f"donchian_width_{n}": hi - lo}


def williams_r(w: WindowSpec, n: int = 14) -> Column:
    return ratio(-100 * (highest(w, n) - c()), highest(w, n) - lowest(w, n))


def raw_stochastic(w: WindowSpec, n: int = 14) -> Column:
    return ratio(100 * (c() - lowest(w, n)), highest(w, n) - lowest(w, n))


def aroon(w: WindowSpec, n: int = 25) -> dict[str, Column]:
    """Over n + 1 rows; the newest extreme counts."""
    at = F.col("bar_index")
    newest_high = F.max_by(at, F.struct("high", "bar_index")).over(rows(w, n + 1))
    newest_low = F.min_by(at, F.struct(F.col("low"), (-F.col("bar_index")).alias("i"))).over(rows(w, n + 1))
    return {
        "aroon_up": full(100 * (n - (at - newest_high)) / n, c("high"), w, n + 1),
        "aroon_down": full(100 * (n - (at - newest_low)) / n, c("low"), w, n + 1),
    }


def cci(w: WindowSpec, n: int = 20) -> Column:
    x = typical()
    held = F.collect_list(x).over(rows(w, n))
    mean = F.avg(x).over(rows(w, n))
    dev = F.aggregate(held, F.lit(0.0), lambda a, v: a + F.abs(v - mean)) / n
    return full(ratio(x - mean, 0.015 * dev), x, w, n)


def chop(w: WindowSpec, n: int = 14) -> Column:
    total = F.sum("true_range").over(rows(w, n))
    return full(ratio(100 * F.log10(ratio(total, highest(w, n) - lowest(w, n))), F.log10(F.lit(float(n)))), c("true_range"), w, n)


def money_flow_multiplier() -> Column:
    return F.coalesce(ratio((c() - c("low")) - (c("high") - c()), c("high") - c("low")), F.lit(0.0))


def cmf(w: WindowSpec, n: int = 20) -> Column:
    flow = money_flow_multiplier() * c("volume")
    return full(ratio(F.sum(flow).over(rows(w, n)), F.sum("volume").over(rows(w, n))), c("volume"), w, n)


def vwma(w: WindowSpec, n: int) -> Column:
    return full(ratio(F.sum(c() * c("volume")).over(rows(w, n)), F.sum("volume").over(rows(w, n))), c(), w, n)


def z_score(w: WindowSpec, n: int, x: Column) -> Column:
    return ratio(x - sma(w, n, x), std(w, n, x))


# --- recursive, on frames ------------------------------------------------------------------------


def _diff(x: pd.Series) -> np.ndarray:
    return x.diff().to_numpy()


def _ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(b != 0, a / b, np.nan)


def true_range(f: pd.DataFrame) -> np.ndarray:
    prev = f["close"].shift()
    spread = np.column_stack([f["high"] - f["low"], (f["high"] - prev).abs(), (f["low"] - prev).abs()])
    return np.nanmax(spread, axis=1)


def rsi(f: pd.DataFrame, n: int = 14) -> np.ndarray:
    d = _diff(f["close"])
    up, down = np.where(np.isnan(d), np.nan, np.maximum(d, 0)), np.where(np.isnan(d), np.nan, np.maximum(-d, 0))
    g, loss = wilder(up, n), wilder(down, n)
    return 100 * _ratio(g, g + loss)


def atr(f: pd.DataFrame, n: int = 14) -> np.ndarray:
    return wilder(true_range(f), n)


def macd(x: np.ndarray, fast: int = 12, slow: int = 26, signal: int = 9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    line = ema(x, fast) - ema(x, slow)
    s = ema(line, signal)
    return line, s, line - s


def percent_oscillator(x: np.ndarray, fast: int = 12, slow: int = 26, signal: int = 9) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    line = 100 * _ratio(ema(x, fast) - ema(x, slow), ema(x, slow))
    s = ema(line, signal)
    return line, s, line - s


def directional(f: pd.DataFrame, n: int = 14) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """adx, plus and minus directional indicators."""
    up, down = f["high"].diff().to_numpy(), -f["low"].diff().to_numpy()
    first = np.isnan(up)
    plus, minus = np.where((up > down) & (up > 0), up, 0.0), np.where((down > up) & (down > 0), down, 0.0)
    plus[first], minus[first] = np.nan, np.nan
    a = wilder(true_range(f), n)
    p, m = 100 * _ratio(wilder(plus, n), a), 100 * _ratio(wilder(minus, n), a)
    return wilder(100 * _ratio(np.abs(p - m), p + m), n), p, m


def tsi(x: pd.Series, slow: int = 25, fast: int = 13) -> np.ndarray:
    d = _diff(x)
    return 100 * _ratio(ema(ema(d, slow), fast), ema(ema(np.abs(d), slow), fast))


def trix(x: np.ndarray, n: int = 30, signal: int = 9) -> tuple[np.ndarray, np.ndarray]:
    t = pd.Series(ema(ema(ema(x, n), n), n))
    line = (100 * t.pct_change(fill_method=None)).to_numpy()
    return line, ema(line, signal)


def supertrend(f: pd.DataFrame, n: int = 10, k: float = 3.0) -> tuple[np.ndarray, np.ndarray]:
    """Line and direction (1 up, -1 down); bands only tighten while the trend holds."""
    a, mid = atr(f, n), ((f["high"] + f["low"]) / 2).to_numpy()
    close, upper, lower = f["close"].to_numpy(), mid + k * a, mid - k * a
    line, way = np.empty(len(f)), np.empty(len(f), np.int64)
    hi, lo, direction = np.inf, -np.inf, 1
    for i in range(len(f)):
        prev = close[i - 1] if i else close[0]
        hi = upper[i] if upper[i] < hi or prev > hi else hi
        lo = lower[i] if lower[i] > lo or prev < lo else lo
        direction = 1 if close[i] > hi else -1 if close[i] < lo else direction
        # the band of the side that was left starts anew
        line[i], way[i] = (lo, 1) if direction == 1 else (hi, -1)
    return line, way


def accumulation(f: pd.DataFrame) -> np.ndarray:
    """The accumulation/distribution line."""
    spread = (f["high"] - f["low"]).to_numpy()
    m = _ratio(((f["close"] - f["low"]) - (f["high"] - f["close"])).to_numpy(), spread)
    return (pd.Series(m).fillna(0).to_numpy() * f["volume"].to_numpy(float)).cumsum()


# --- volume profile ------------------------------------------------------------------------------


def value_area(ticks: list[int], volume: list[float], share: float = 0.7) -> tuple[int, int, int]:
    """Tick with the most volume (lowest on ties), and the area around it, grown toward the larger neighbour, left on ties."""
    by = dict(zip(ticks, volume, strict=True))
    lo = hi = poc = min(by, key=lambda t: (-by[t], t))
    total, goal = by[poc], share * sum(volume)
    first, last = min(by), max(by)
    while total < goal and (lo > first or hi < last):
        left = by.get(lo - 1, 0.0) if lo > first else -1.0
        right = by.get(hi + 1, 0.0) if hi < last else -1.0
        if left >= right:
            lo -= 1
            total += max(left, 0.0)
        else:
            hi += 1
            total += max(right, 0.0)
    return poc, lo, hi

"""Indicator queries on hourly bars, derived features, and the volume profile."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.functions import indicators as I
from barloom.functions import recursive
from barloom.functions.derived import session_opening, swing
from barloom.operators import bars as B
from barloom.operators.windows import full, masked, rolling, rows
from barloom.plans import market
from barloom.plans.registry import query

def W():
    """A series in time order; made when a query runs, since windows need a session."""
    return Window.partitionBy("instrument_id").orderBy("ts")


KEYS = "instrument_id ts:t"


def o(n: int | None = None, part: str = "instrument_id") -> str:
    """An OVER clause: the last n rows, or all so far."""
    return f"OVER (PARTITION BY {part} ORDER BY ts ROWS BETWEEN {'UNBOUNDED' if n is None else n - 1} PRECEDING AND CURRENT ROW)"


def lag(x: str, n: int = 1) -> str:
    return f"lag({x}, {n}) OVER (PARTITION BY instrument_id ORDER BY ts)"


def if_full(value: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) {o(n)} = {n} THEN {value} END"


def agg(fn: str, x: str, n: int) -> str:
    return if_full(f"{fn}({x}) {o(n)}", x, n)


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif(({b}), 0))"


BASE = f""", base AS (
    SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY ts) - 1 AS bar_index, {lag('close')} AS prev_close,
           CASE WHEN {lag('close')} <> 0 THEN close / {lag('close')} - 1 END AS ret_1,
           CASE WHEN {lag('close')} > 0 AND close > 0 THEN ln(close / {lag('close')}) END AS log_ret_1,
           CASE WHEN {lag('close')} IS NULL THEN high - low ELSE greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) END AS true_range,
           high - low AS hl_range, abs(close - open) AS oc_range, (high + low + close) / 3 AS tp
    FROM hourly
)"""
CTE = market.CTE + BASE


def base(spark, sf_dir):
    return B.base_metrics(market.hourly(spark, sf_dir), ["instrument_id"])


@query(
    "ohlc_daily_features",
    "instrument_id contract_id ts:t open:d high:d low:d close:d volume:i open_interest:i n:i ret_1:d log_ret_1:d true_range:d sma_20:d",
    """SELECT *, CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma_20 FROM (
        SELECT *, CASE WHEN p <> 0 THEN close / p - 1 END AS ret_1, CASE WHEN p > 0 AND close > 0 THEN ln(close / p) END AS log_ret_1,
               CASE WHEN p IS NULL THEN high - low ELSE greatest(high - low, abs(high - p), abs(low - p)) END AS true_range
        FROM (SELECT *, lag(close) OVER (PARTITION BY contract_id ORDER BY ts) AS p FROM daily)
    ) WINDOW w20 AS (PARTITION BY contract_id ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def _(spark, sf_dir):
    w = Window.partitionBy("instrument_id", "contract_id").orderBy("ts")
    return B.base_metrics(market.daily(spark, sf_dir), ["instrument_id", "contract_id"]).withColumn("sma_20", I.sma(w, 20))


def windowed(name: str, made: dict, sql: dict[str, str], steps: list[dict] | None = None, sql_steps: list[dict[str, str]] | None = None):
    """Register columns over W() on base bars; steps are earlier columns that they need, one window each."""
    body = "SELECT * FROM base"
    for s in sql_steps or []:
        body = f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in s.items())} FROM ({body})"
    body = f"SELECT *, {', '.join(f'{v} AS {k}' for k, v in sql.items())} FROM ({body})"

    def run(spark, sf_dir):
        df = base(spark, sf_dir)
        for s in steps or []:
            df = df.withColumns({k: f() for k, f in s.items()})
        return df.withColumns({k: f() for k, f in made.items()})

    query(name, f"{KEYS} " + " ".join(f"{k}:d" for k in sql), body, CTE)(run)


c = I.c
windowed("ind_l0_metrics", {}, {"ret_1": "ret_1", "log_ret_1": "log_ret_1", "true_range": "true_range", "hl_range": "hl_range", "oc_range": "oc_range", "bar_index": "bar_index"})
SMA = (10, 20, 50, 100, 200)
windowed("ind_sma", {f"sma_{n}": (lambda n=n: I.sma(W(), n)) for n in SMA}, {f"sma_{n}": agg("avg", "close", n) for n in SMA})


def wma_sql(x: str, n: int) -> str:
    """Weighted sum by lags: weight n for the newest."""
    return if_full("(" + " + ".join(f"{n - k} * {x if k == 0 else lag(x, k)}" for k in range(n)) + f") / {n * (n + 1) / 2}", x, n)


HMA = ((20, 4), (100, 10), (200, 14))
windowed(
    "ind_hma",
    {f"hma_{n}": (lambda n=n, r=r: I.wma(W(), r, c(f"raw_{n}"), c("bar_index"))) for n, r in HMA},
    {f"hma_{n}": wma_sql(f"raw_{n}", r) for n, r in HMA},
    [{f"raw_{n}": (lambda n=n: 2 * I.wma(W(), n // 2, c(), c("bar_index")) - I.wma(W(), n, c(), c("bar_index"))) for n, _ in HMA}],
    [{f"raw_{n}": f"2 * ({wma_sql('close', n // 2)}) - ({wma_sql('close', n)})" for n, _ in HMA}],
)
STOCH = div(f"100 * (close - min(low) {o(14)})", f"max(high) {o(14)} - min(low) {o(14)}")
windowed(
    "ind_stoch",
    {"stoch_k": lambda: c("k"), "stoch_d": lambda: I.sma(W(), 3, c("k"))},
    {"stoch_k": "k", "stoch_d": agg("avg", "k", 3)},
    [{"raw": lambda: I.raw_stochastic(W())}, {"k": lambda: I.sma(W(), 3, c("raw"))}],
    [{"raw": if_full(STOCH, "low", 14)}, {"k": agg("avg", "raw", 3)}],
)
windowed("ind_chop", {"chop_14": lambda: I.chop(W())}, {"chop_14": if_full(div(f"100 * log10({div(f'sum(true_range) {o(14)}', f'max(high) {o(14)} - min(low) {o(14)}')})", "log10(14.0)"), "true_range", 14)})
windowed("ind_close_slope", {"close_slope_20": lambda: I.slope_degrees(W(), 20)}, {"close_slope_20": f"degrees(atan((close - {lag('close', 20)}) / 20))"})
windowed(
    "ind_aroon",
    {k: (lambda k=k: I.aroon(W())[k]) for k in ("aroon_up", "aroon_down")},
    {
        "aroon_up": if_full(f"100 * (25 - (bar_index - arg_max(bar_index, (high, bar_index)) {o(26)})) / 25", "high", 26),
        "aroon_down": if_full(f"100 * (25 - (bar_index - arg_min(bar_index, (low, -bar_index)) {o(26)})) / 25", "low", 26),
    },
)
DON = {}
for n in (20, 55):
    DON |= {f"donchian_high_{n}": agg("max", "high", n), f"donchian_low_{n}": agg("min", "low", n), f"donchian_mid_{n}": f"({agg('max', 'high', n)} + {agg('min', 'low', n)}) / 2", f"donchian_width_{n}": f"{agg('max', 'high', n)} - {agg('min', 'low', n)}"}
windowed("ind_donchian", {k: (lambda k=k: I.donchian(W(), int(k.rsplit("_", 1)[1]))[k]) for k in DON}, DON)
BB = {
    "bb_upper": "m + 2 * s", "bb_mid": "m", "bb_lower": "m - 2 * s", "bb_width": div("400 * s", "m"), "bb_percent_b": div("close - (m - 2 * s)", "4 * s"),
}
windowed("ind_bbands", {k: (lambda k=k: I.bollinger(W())[k]) for k in BB}, BB, None, [{"m": agg("avg", "close", 20), "s": agg("stddev_pop", "close", 20)}])
windowed("ind_realized_vol", {"realized_volatility_20": lambda: I.std(W(), 20, c("log_ret_1"))}, {"realized_volatility_20": agg("stddev_pop", "log_ret_1", 20)})
windowed(
    "ind_ulcer",
    {"ulcer_index_14": lambda: F.sqrt(I.sma(W(), 14, c("dd") * c("dd")))},
    {"ulcer_index_14": f"sqrt({agg('avg', 'dd * dd', 14)})"},
    [{"dd": lambda: 100 * (c() / I.highest(W(), 14, c()) - 1)}],
    [{"dd": f"100 * (close / {agg('max', 'close', 14)} - 1)"}],
)
windowed("ind_obv", {"obv": lambda: F.sum(c("volume") * F.coalesce(F.signum(c() - c("prev_close")), F.lit(0.0))).over(W().rowsBetween(Window.unboundedPreceding, 0))}, {"obv": f"sum(volume * coalesce(sign(close - prev_close), 0)) {o()}"})
windowed(
    "ind_mfi",
    {"mfi_14": lambda: full(I.ratio(100 * F.sum("up").over(rows(W(), 14)), F.sum(c("up") + c("down")).over(rows(W(), 14))), c("ptp"), W(), 14)},
    {"mfi_14": if_full(div(f"100 * sum(up) {o(14)}", f"sum(up + down) {o(14)}"), "ptp", 14)},
    [{"tp": I.typical, "ptp": lambda: F.lag(I.typical()).over(W())}, {"up": lambda: F.when(c("tp") > c("ptp"), c("tp") * c("volume")).otherwise(0), "down": lambda: F.when(c("tp") < c("ptp"), c("tp") * c("volume")).otherwise(0)}],
    [{"ptp": lag("tp")}, {"up": "CASE WHEN tp > ptp THEN tp * volume ELSE 0 END", "down": "CASE WHEN tp < ptp THEN tp * volume ELSE 0 END"}],
)
MFM = "coalesce(((close - low) - (high - close)) / nullif(high - low, 0), 0)"
windowed("ind_cmf", {"cmf_20": lambda: I.cmf(W())}, {"cmf_20": if_full(div(f"sum({MFM} * volume) {o(20)}", f"sum(volume) {o(20)}"), "volume", 20)})
windowed("ind_vwma", {f"vwma_{n}": (lambda n=n: I.vwma(W(), n)) for n in (20, 100, 200)}, {f"vwma_{n}": if_full(div(f"sum(close * volume) {o(n)}", f"sum(volume) {o(n)}"), "close", n) for n in (20, 100, 200)})
windowed("ind_roc_mom", {"roc_10": lambda: I.roc(W(), 10), "mom_10": lambda: I.momentum(W(), 10)}, {"roc_10": div(f"100 * (close - {lag('close', 10)})", lag("close", 10)), "mom_10": f"close - {lag('close', 10)}"})
KST = ((10, 10, 1), (15, 10, 2), (20, 10, 3), (30, 15, 4))
windowed(
    "ind_kst",
    {"kst": lambda: c("k"), "kst_signal": lambda: I.sma(W(), 9, c("k"))},
    {"kst": "k", "kst_signal": agg("avg", "k", 9)},
    [{f"r{r}": (lambda r=r: I.roc(W(), r)) for r, _, _ in KST}, {"k": lambda: sum((wt * I.sma(W(), n, c(f"r{r}")) for r, n, wt in KST[1:]), I.sma(W(), 10, c("r10")))}],
    [{f"r{r}": div(f"100 * (close - {lag('close', r)})", lag("close", r)) for r, _, _ in KST}, {"k": " + ".join(f"{wt} * ({agg('avg', f'r{r}', n)})" for r, n, wt in KST)}],
)
windowed(
    "ind_cci",
    {"cci_20": lambda: I.cci(W())},
    {"cci_20": if_full(div("tp - m", "0.015 * list_sum(list_transform(held, lambda v: abs(v - m))) / 20"), "tp", 20)},
    None,
    [{"m": f"avg(tp) {o(20)}", "held": f"list(tp) {o(20)}"}],
)
windowed("ind_willr", {"willr_14": lambda: I.williams_r(W())}, {"willr_14": if_full(div(f"-100 * (max(high) {o(14)} - close)", f"max(high) {o(14)} - min(low) {o(14)}"), "high", 14)})
UO = (7, 14, 28)
windowed(
    "ind_uo",
    {"ultimate_oscillator": lambda: 100 * sum((wt * full(I.ratio(F.sum("bp").over(rows(W(), n)), F.sum("tr").over(rows(W(), n))), c("bp"), W(), n) for n, wt in zip(UO, (4, 2, 1), strict=True)), F.lit(0.0)) / 7},
    {"ultimate_oscillator": "100 * (" + " + ".join(f"{wt} * ({if_full(div(f'sum(bp) {o(n)}', f'sum(tr) {o(n)}'), 'bp', n)})" for n, wt in zip(UO, (4, 2, 1), strict=True)) + ") / 7"},
    [{"bp": lambda: F.when(c("prev_close").isNotNull(), c() - F.least("low", "prev_close")), "tr": lambda: F.when(c("prev_close").isNotNull(), F.greatest("high", "prev_close") - F.least("low", "prev_close"))}],
    [{"bp": "CASE WHEN prev_close IS NOT NULL THEN close - least(low, prev_close) END", "tr": "CASE WHEN prev_close IS NOT NULL THEN greatest(high, prev_close) - least(low, prev_close) END"}],
)
windowed("ind_ad", {"ad": lambda: F.sum(I.money_flow_multiplier() * c("volume")).over(W().rowsBetween(Window.unboundedPreceding, 0))}, {"ad": f"sum({MFM} * volume) {o()}"})
windowed("ind_pvt", {"pvt": lambda: F.sum(F.coalesce(c("ret_1"), F.lit(0.0)) * c("volume")).over(W().rowsBetween(Window.unboundedPreceding, 0))}, {"pvt": f"sum(coalesce(ret_1, 0) * volume) {o()}"})
windowed(
    "ind_rvol_z",
    {"rvol_20": lambda: I.ratio(c("volume"), I.sma(W(), 20, c("volume"))), "volume_z_20": lambda: I.z_score(W(), 20, c("volume"))},
    {"rvol_20": div("volume", agg("avg", "volume", 20)), "volume_z_20": div(f"volume - {agg('avg', 'volume', 20)}", agg("stddev_pop", "volume", 20))},
)
OI = "open_interest"
windowed(
    "ind_oi",
    {
        "oi_change_1": lambda: I.momentum(W(), 1, c(OI)), "oi_roc_10": lambda: I.roc(W(), 10, c(OI)), "oi_z_20": lambda: I.z_score(W(), 20, c(OI)),
        "oi_relative_activity_20": lambda: I.ratio(c(OI), I.sma(W(), 20, c(OI))), "volume_oi_ratio": lambda: I.ratio(c("volume"), c(OI)),
    },
    {
        "oi_change_1": f"{OI} - {lag(OI)}", "oi_roc_10": div(f"100.0 * ({OI} - {lag(OI, 10)})", lag(OI, 10)), "oi_z_20": div(f"{OI} - {agg('avg', OI, 20)}", agg("stddev_pop", OI, 20)),
        "oi_relative_activity_20": div(OI, agg("avg", OI, 20)), "volume_oi_ratio": div("volume", OI),
    },
)

# --- recursive ------------------------------------------------------------------------------------


def smooth(x: str, prev: str, a: float) -> str:
    """One step of exponential smoothing that starts with its first value and carries over missing ones."""
    return f"CASE WHEN ({x}) IS NULL THEN {prev} ELSE {a!r} * ({x}) + {1 - a!r} * coalesce({prev}, ({x})) END"


def recursion(outputs: list[str], layers: list[dict[str, str]], extra: str = "") -> str:
    """A recursive query over bars by rn; layers are steps whose columns later ones use. `p.x` is the row before's x."""
    names = [k for layer in layers for k in layer]
    inner = "SELECT s.*, " + ", ".join(f"p.{n} AS p_{n}" for n in names) + " FROM p JOIN s ON s.instrument_id = p.instrument_id AND s.rn = p.rn + 1"
    start = "SELECT s.*, " + ", ".join(f"CAST(NULL AS DOUBLE) AS p_{n}" for n in names) + " FROM s WHERE rn = 1"
    carry = "instrument_id, rn, ts, " + ", ".join(names)

    def steps(body: str) -> str:
        for layer in layers:
            body = f"SELECT *, {', '.join(f'CAST({v} AS DOUBLE) AS {k}' for k, v in layer.items())} FROM ({body})"
        return f"SELECT {carry} FROM ({body})"

    tail = ", ".join(outputs)
    return f"""SELECT instrument_id, ts, {tail} FROM (
        WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY ts) AS rn {extra} FROM base),
        p AS ({steps(start)} UNION ALL {steps(inner)}) SELECT * FROM p)"""


def recursive_query(name: str, outputs: list[str], fn, layers: list[dict[str, str]], extra: str = "", forgets: bool = True):
    def compute(f: pd.DataFrame) -> pd.DataFrame:
        return f.assign(**dict(zip(outputs, fn(f), strict=True)))

    def run(spark, sf_dir):
        out = recursive.over_series(base(spark, sf_dir), ["instrument_id"], "ts", compute, dict.fromkeys(outputs, "double"), forgets)
        return out.select("instrument_id", "ts", *(F.when(~F.isnan(k), F.col(k)).alias(k) for k in outputs))

    query(name, f"{KEYS} " + " ".join(f"{k}:d" for k in outputs), recursion(outputs, layers, extra), CTE)(run)


def a_(n: int) -> float:
    return 2 / (n + 1)


def sm(x: str, name: str, a: float) -> dict[str, str]:
    return {name: smooth(x, f"p_{name}", a)}


EMA = (10, 20, 50, 100, 200)
recursive_query("ind_ema", [f"ema_{n}" for n in EMA], lambda f: [recursive.ema(f["close"].to_numpy(), n) for n in EMA], [{k: v for n in EMA for k, v in sm("close", f"ema_{n}", a_(n)).items()}])
recursive_query("ind_atr_natr", ["atr_14", "natr_14"], lambda f: (lambda a: [a, 100 * a / f["close"].to_numpy()])(I.atr(f)), [sm("true_range", "atr_14", 1 / 14), {"natr_14": "100 * atr_14 / close"}])
UPDOWN = ", CASE WHEN prev_close IS NOT NULL THEN greatest(close - prev_close, 0) END AS up, CASE WHEN prev_close IS NOT NULL THEN greatest(prev_close - close, 0) END AS down"
RSI = [sm("up", "g", 1 / 14) | sm("down", "l", 1 / 14), {"rsi_14": "100 * g / nullif(g + l, 0)"}]
recursive_query("ind_rsi", ["rsi_14"], lambda f: [I.rsi(f)], RSI, UPDOWN)


def oscillator(x: str, line: str) -> list[dict[str, str]]:
    return [sm(x, "f", a_(12)) | sm(x, "s", a_(26)), {"line": line}, sm("line", "sig", a_(9)), {"hist": "line - sig"}]


recursive_query("ind_macd", ["line", "sig", "hist"], lambda f: list(I.macd(f["close"].to_numpy())), oscillator("close", "f - s"))
recursive_query("ind_ppo", ["line", "sig", "hist"], lambda f: list(I.percent_oscillator(f["close"].to_numpy())), oscillator("close", "100 * (f - s) / nullif(s, 0)"))
recursive_query("ind_pvo", ["line", "sig", "hist"], lambda f: list(I.percent_oscillator(f["volume"].to_numpy(float))), oscillator("volume", "100 * (f - s) / nullif(s, 0)"))
DM = f", high - {lag('high')} AS hd, {lag('low')} - low AS ld"
recursive_query(
    "ind_adx",
    ["adx_14", "dmp_14", "dmn_14"],
    lambda f: list(I.directional(f)),
    [
        sm("true_range", "atr", 1 / 14) | sm("CASE WHEN hd IS NULL THEN NULL WHEN hd > ld AND hd > 0 THEN hd ELSE 0 END", "sp", 1 / 14) | sm("CASE WHEN hd IS NULL THEN NULL WHEN ld > hd AND ld > 0 THEN ld ELSE 0 END", "sn", 1 / 14),
        {"dmp_14": "100 * sp / nullif(atr, 0)", "dmn_14": "100 * sn / nullif(atr, 0)"},
        {"dx": "100 * abs(dmp_14 - dmn_14) / nullif(dmp_14 + dmn_14, 0)"},
        sm("dx", "adx_14", 1 / 14),
    ],
    DM,
)
recursive_query("ind_kc", ["kc_upper", "kc_mid", "kc_lower"], lambda f: (lambda m, r: [m + 1.5 * r, m, m - 1.5 * r])(recursive.ema(f["close"].to_numpy(), 20), recursive.ema(I.true_range(f), 20)), [sm("close", "kc_mid", a_(20)) | sm("true_range", "rng", a_(20)), {"kc_upper": "kc_mid + 1.5 * rng", "kc_lower": "kc_mid - 1.5 * rng"}])
recursive_query(
    "ind_tsi", ["tsi_25_13"], lambda f: [I.tsi(f["close"])],
    [sm("close - prev_close", "a1", a_(25)) | sm("abs(close - prev_close)", "b1", a_(25)), sm("a1", "a2", a_(13)) | sm("b1", "b2", a_(13)), {"tsi_25_13": "100 * a2 / nullif(b2, 0)"}],
)
recursive_query("ind_trix", ["trix", "trix_signal"], lambda f: list(I.trix(f["close"].to_numpy())), [sm("close", "e1", a_(30)), sm("e1", "e2", a_(30)), sm("e2", "e3", a_(30)), {"trix": "100 * (e3 / p_e3 - 1)"}, sm("trix", "trix_signal", a_(9))])
recursive_query("ind_force", ["force_index_13"], lambda f: [recursive.ema(f["close"].diff().to_numpy() * f["volume"].to_numpy(float), 13)], [sm("(close - prev_close) * volume", "force_index_13", a_(13))])
recursive_query("ind_adosc", ["adosc_3_10"], lambda f: [recursive.ema(I.accumulation(f), 3) - recursive.ema(I.accumulation(f), 10)], [{"ad": f"coalesce(p_ad, 0) + {MFM} * volume"}, sm("ad", "f", a_(3)) | sm("ad", "s", a_(10)), {"adosc_3_10": "f - s"}], forgets=False)
recursive_query(
    "ind_supertrend", ["supertrend", "supertrend_direction"], lambda f: list(I.supertrend(f)),
    [
        sm("true_range", "atr", 1 / 10),
        {"up": "(high + low) / 2 + 3 * atr", "dn": "(high + low) / 2 - 3 * atr"},
        {"hi": "CASE WHEN p_hi IS NULL OR up < p_hi OR prev_close > p_hi THEN up ELSE p_hi END", "lo": "CASE WHEN p_lo IS NULL OR dn > p_lo OR prev_close < p_lo THEN dn ELSE p_lo END"},
        {"supertrend_direction": "CASE WHEN close > hi THEN 1 WHEN close < lo THEN -1 ELSE coalesce(p_supertrend_direction, 1) END"},
        {"supertrend": "CASE WHEN supertrend_direction = 1 THEN lo ELSE hi END"},
    ],
    forgets=False,
)


@query(
    "ind_stochrsi",
    f"{KEYS} k:d d:d",
    f"""SELECT *, {agg('avg', 'k', 3)} AS d FROM (SELECT *, {agg('avg', 'raw', 3)} AS k FROM (
        SELECT *, {if_full(div(f'100 * (rsi_14 - min(rsi_14) {o(14)})', f'max(rsi_14) {o(14)} - min(rsi_14) {o(14)}'), 'rsi_14', 14)} AS raw FROM ({recursion(['rsi_14'], RSI, UPDOWN)})))""",
    CTE,
)
def _(spark, sf_dir):
    df = recursive.over_series(base(spark, sf_dir), ["instrument_id"], "ts", lambda f: f.assign(rsi=I.rsi(f)), {"rsi": "double"})
    df = df.withColumn("rsi", F.when(~F.isnan("rsi"), F.round("rsi", 12)))
    lo, hi = I.lowest(W(), 14, c("rsi")), I.highest(W(), 14, c("rsi"))
    return df.withColumn("raw", I.ratio(100 * (c("rsi") - lo), hi - lo)).withColumn("k", I.sma(W(), 3, c("raw"))).withColumn("d", I.sma(W(), 3, c("k")))


def last_tick():
    """The highest tick that a bar touches: one without a range touches one."""
    return F.when(c("low") == c("high"), F.floor("low")).otherwise(F.ceil("high"))


@query(
    "ind_volume_profile",
    "instrument_id ts:t poc:i volume:d vwap:d n_ticks:i va_low:i va_high:i",
    """SELECT g.instrument_id, g.day AS ts, g.poc, g.volume, g.vwap, g.n_ticks, e.lo AS va_low, e.hi AS va_high FROM g JOIN (
        SELECT instrument_id, day, arg_max(lo, step) AS lo, arg_max(hi, step) AS hi FROM p GROUP BY 1, 2) e ON e.instrument_id = g.instrument_id AND e.day = g.day""",
    market.CTE
    + """, hist AS (SELECT instrument_id, day, tick, sum(v) AS raw, round(sum(v), 9) AS v FROM (
        SELECT instrument_id, date_trunc('day', ts) AS day, unnest(generate_series(floor(low)::BIGINT, CASE WHEN low = high THEN floor(low) ELSE ceil(high) END::BIGINT)) AS tick, volume / (CASE WHEN low = high THEN floor(low) ELSE ceil(high) END - floor(low) + 1) AS v FROM hourly) GROUP BY ALL),
    g AS (SELECT instrument_id, day, arg_min(tick, (-v, tick)) AS poc, max(v) AS top, sum(raw) AS volume, sum(tick * raw) / sum(raw) AS vwap, count(*) AS n_ticks, min(tick) AS first, max(tick) AS last, 0.7 * sum(v) AS goal FROM hist GROUP BY ALL),
    p AS (SELECT instrument_id, day, poc AS lo, poc AS hi, top AS total, 0 AS step FROM g UNION ALL
        SELECT instrument_id, day, CASE WHEN lv >= rv THEN lo - 1 ELSE lo END, CASE WHEN lv >= rv THEN hi ELSE hi + 1 END, total + greatest(0, CASE WHEN lv >= rv THEN lv ELSE rv END), step + 1 FROM (
            SELECT p.*, CASE WHEN p.lo > g.first THEN coalesce(l.v, 0) ELSE -1 END AS lv, CASE WHEN p.hi < g.last THEN coalesce(r.v, 0) ELSE -1 END AS rv FROM p JOIN g ON g.instrument_id = p.instrument_id AND g.day = p.day
            LEFT JOIN hist l ON l.instrument_id = p.instrument_id AND l.day = p.day AND l.tick = p.lo - 1 LEFT JOIN hist r ON r.instrument_id = p.instrument_id AND r.day = p.day AND r.tick = p.hi + 1
            WHERE p.total < g.goal AND (p.lo > g.first OR p.hi < g.last)))""",
)
def _(spark, sf_dir):
    """Daily: each hour's volume spread evenly over whole ticks from its low to its high."""
    h = market.hourly(spark, sf_dir)
    per_tick = (
        h.select("instrument_id", F.date_trunc("day", "ts").alias("ts"), F.sequence(F.floor("low"), last_tick()).alias("ticks"), "volume")
        .select("instrument_id", "ts", F.explode("ticks").alias("tick"), (F.col("volume") / F.size("ticks")).alias("v"))
        .groupBy("instrument_id", "ts", "tick").agg(F.sum("v").alias("v"))
    )

    def area(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("tick")
        poc, lo, hi = I.value_area(f["tick"].tolist(), f["v"].round(9).tolist())
        return pd.DataFrame({"instrument_id": [f["instrument_id"].iloc[0]], "ts": [f["ts"].iloc[0]], "poc": [poc], "volume": [f["v"].sum()], "vwap": [(f["tick"] * f["v"]).sum() / f["v"].sum()], "n_ticks": [len(f)], "va_low": [lo], "va_high": [hi]})

    from barloom.session import ship_package

    ship_package(spark)
    return per_tick.groupBy("instrument_id", "ts").applyInPandas(area, "instrument_id string, ts timestamp, poc long, volume double, vwap double, n_ticks long, va_low long, va_high long")


@query(
    "ind_volume_histogram",
    "instrument_id day:t poc:i volume:d vwap:d n_ticks:i",
    """SELECT instrument_id, day, arg_min(tick, (-round(v, 9), tick)) AS poc, sum(v) AS volume, sum(tick * v) / sum(v) AS vwap, count(*) AS n_ticks FROM (
        SELECT instrument_id, day, tick, sum(v) AS v FROM (
            SELECT instrument_id, date_trunc('day', ts) AS day, unnest(generate_series(floor(low)::BIGINT, CASE WHEN low = high THEN floor(low) ELSE ceil(high) END::BIGINT)) AS tick,
                   volume / (CASE WHEN low = high THEN floor(low) ELSE ceil(high) END - floor(low) + 1) AS v FROM hourly) GROUP BY ALL) GROUP BY ALL""",
)
def _(spark, sf_dir):
    h = market.hourly(spark, sf_dir)
    ticks = h.select("instrument_id", F.date_trunc("day", "ts").alias("day"), F.sequence(F.floor("low"), last_tick()).alias("ticks"), "volume").select(
        "instrument_id", "day", F.explode("ticks").alias("tick"), (F.col("volume") / F.size("ticks")).alias("v")
    )
    return (
        ticks.groupBy("instrument_id", "day", "tick")
        .agg(F.sum("v").alias("v"))
        .groupBy("instrument_id", "day")
        .agg(
            F.min_by("tick", F.struct((-F.round("v", 9)).alias("v"), F.col("tick"))).alias("poc"),
            F.sum("v").alias("volume"),
            (F.sum(F.col("tick") * F.col("v")) / F.sum("v")).alias("vwap"),
            F.count(F.lit(1)).alias("n_ticks"),
        )
    )


# --- derived --------------------------------------------------------------------------------------

def SO_FAR():
    return Window.partitionBy("instrument_id", "day").orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)


OD = "OVER (PARTITION BY instrument_id, day ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
DAYS = "(SELECT *, date_trunc('day', ts) AS day FROM base)"


def by_day(spark, sf_dir):
    return base(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts"))


@query(
    "der_session_levels",
    f"{KEYS} session_high:d session_low:d week_high:d week_low:d session_vwap:d distance:d",
    f"""SELECT *, close - session_vwap AS distance FROM (SELECT *, max(high) {OD} AS session_high, min(low) {OD} AS session_low,
        max(high) {o(None, "instrument_id, date_trunc('week', ts)")} AS week_high, min(low) {o(None, "instrument_id, date_trunc('week', ts)")} AS week_low,
        sum(tp * volume) {OD} / nullif(sum(volume) {OD}, 0) AS session_vwap FROM {DAYS})""",
    CTE,
)
def _(spark, sf_dir):
    week = Window.partitionBy("instrument_id", F.date_trunc("week", "ts")).orderBy("ts").rowsBetween(Window.unboundedPreceding, 0)
    vwap = I.ratio(F.sum(I.typical() * c("volume")).over(SO_FAR()), F.sum("volume").over(SO_FAR()))
    return by_day(spark, sf_dir).withColumns(
        {"session_high": F.max("high").over(SO_FAR()), "session_low": F.min("low").over(SO_FAR()), "week_high": F.max("high").over(week), "week_low": F.min("low").over(week), "session_vwap": vwap}
    ).withColumn("distance", c() - c("session_vwap"))


@query(
    "der_opening_range",
    f"{KEYS} opening_range_high:d opening_range_low:d",
    """SELECT *, CASE WHEN n_day >= 4 AND rn >= 4 THEN max(CASE WHEN rn <= 4 THEN high END) OVER (PARTITION BY instrument_id, day) END AS opening_range_high,
        CASE WHEN n_day >= 4 AND rn >= 4 THEN min(CASE WHEN rn <= 4 THEN low END) OVER (PARTITION BY instrument_id, day) END AS opening_range_low
        FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, day ORDER BY ts) AS rn, count(*) OVER (PARTITION BY instrument_id, day) AS n_day FROM """ + DAYS + ")",
    CTE,
)
def _(spark, sf_dir):
    return session_opening(by_day(spark, sf_dir), ["instrument_id", "day"], 4)


@query(
    "der_swings",
    f"{KEYS} swing_high:d swing_low:d",
    f"""SELECT *, last_value(ph IGNORE NULLS) {o()} AS swing_high, last_value(pl IGNORE NULLS) {o()} AS swing_low FROM (
        SELECT *, {if_full(f"CASE WHEN {lag('high', 5)} = max(high) {o(11)} THEN {lag('high', 5)} END", 'high', 11)} AS ph,
        {if_full(f"CASE WHEN {lag('low', 5)} = min(low) {o(11)} THEN {lag('low', 5)} END", 'low', 11)} AS pl FROM base)""",
    CTE,
)
def _(spark, sf_dir):
    return swing(base(spark, sf_dir), W(), 5, 5)


@query(
    "der_masked_hold",
    f"{KEYS} masked_sma_3:d",
    f"""SELECT b.instrument_id, b.ts, last_value(v.x IGNORE NULLS) OVER (PARTITION BY b.instrument_id ORDER BY b.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS masked_sma_3
        FROM base b LEFT JOIN (SELECT instrument_id, ts, {agg('avg', 'close', 3)} AS x FROM base WHERE (volume & 1) = 1) v USING (instrument_id, ts)""",
    CTE,
)
def _(spark, sf_dir):
    ok = F.col("volume").bitwiseAND(1) == 1
    return masked(base(spark, sf_dir), ["instrument_id"], "ts", ok, lambda d: d.withColumn("masked_sma_3", rolling(F.avg, c(), W(), 3)), "masked_sma_3", "hold")


@query(
    "ind_registered",
    f"{KEYS} balance_of_power_14:d range_rank_20:i",
    f"SELECT *, {agg('avg', div('close - open', 'high - low'), 14)} AS balance_of_power_14, CASE WHEN count(hl_range) {o(20)} = 20 THEN list_sum(list_transform(list(hl_range) {o(20)}, lambda v: CASE WHEN v < hl_range THEN 1 ELSE 0 END)) END AS range_rank_20 FROM base",
    CTE,
)
def _(spark, sf_dir):
    """Indicators of a user's own, found by name."""
    own = lambda v: F.when(v < c("hl_range"), 1).otherwise(0)
    I.register_indicator("balance_of_power", lambda w: {"balance_of_power_14": I.sma(w, 14, I.ratio(c() - c("open"), c("high") - c("low")))})
    I.register_indicator("range_rank", lambda w: {"range_rank_20": full(F.aggregate(F.transform(F.collect_list("hl_range").over(rows(w, 20)), own), F.lit(0), lambda a, b: a + b), c("hl_range"), w, 20)})
    return I.apply_registered(base(spark, sf_dir), W(), ["balance_of_power", "range_rank"])

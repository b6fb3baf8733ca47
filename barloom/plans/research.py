"""Continuous series, signals, simulation money, ranking, reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators import economics, ledger, quality, roll, scoring, signals
from barloom.operators.research import parameter_grid
from barloom.plans import market
from barloom.plans.indicators import CTE as BASE_CTE
from barloom.plans.indicators import W, agg, base, lag, o
from barloom.plans.market import table
from barloom.plans.registry import query
from barloom.functions import indicators as I

# --- continuous series ----------------------------------------------------------------------------


@query(
    "roll_calendar",
    "instrument_id ts:t active",
    """SELECT c.instrument_id, c.ts, arg_min(l.contract_id, l.maturity) AS active FROM (SELECT DISTINCT instrument_id, ts FROM daily) c
        JOIN (SELECT contract_id, any_value(instrument_id) AS instrument_id, any_value(maturity) AS maturity, min(ts) AS first_ts,
              CASE WHEN any_value(maturity) < 2 THEN list_sort(list(ts))[greatest(1, count(*) - 2 - 8 * (1 - any_value(maturity)))] END AS roll_ts FROM (SELECT *, CAST(right(contract_id, 1) AS INT) AS maturity FROM daily) GROUP BY contract_id) l
        ON c.instrument_id = l.instrument_id AND c.ts >= l.first_ts AND (l.roll_ts IS NULL OR c.ts < l.roll_ts) GROUP BY c.instrument_id, c.ts""",
)
def _(spark, sf_dir):
    d = market.daily(spark, sf_dir).withColumn("maturity", F.right("contract_id", F.lit(1)).cast("int"))
    back = F.lit(2) + 8 * (1 - F.col("maturity"))
    return roll.calendar_front(d, "instrument_id", "contract_id", "maturity", back, 2)


LIQ = """liq AS (
    SELECT instrument_id, ts, arg_max(contract_id, (open_interest, contract_id)) AS top, max(open_interest) / sum(open_interest) AS share FROM daily GROUP BY instrument_id, ts
), held AS (
    SELECT *, CASE WHEN count(*) OVER w = 2 AND min(top) OVER w = max(top) OVER w AND share >= 0.4 THEN CAST(right(top, 1) AS INT) END AS cand FROM liq
    WINDOW w AS (PARTITION BY instrument_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)
), act AS (
    SELECT instrument_id, ts, max(decided) OVER (PARTITION BY instrument_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS maturity FROM (
        SELECT *, lag(cand) OVER (PARTITION BY instrument_id ORDER BY ts) AS decided FROM held)
), ev AS (
    SELECT *, lag(maturity) OVER (PARTITION BY instrument_id ORDER BY ts) AS p, lag(ts) OVER (PARTITION BY instrument_id ORDER BY ts) AS decision_ts FROM act
)"""


@query("roll_liquidity", "instrument_id ts:t maturity:i", "SELECT * FROM act", market.CTE + ", " + LIQ)
def _(spark, sf_dir):
    return front(spark, sf_dir)


def front(spark, sf_dir):
    d = market.daily(spark, sf_dir).withColumn("maturity", F.right("contract_id", F.lit(1)).cast("int"))
    return roll.liquidity_front(d, "instrument_id", "contract_id", "maturity", "open_interest", 0.4, 2)


EVENTS = """gaps AS (
    SELECT ev.instrument_id, ev.ts, decision_ts, p AS old_maturity, maturity AS new_maturity, n.close - o.close AS gap, row_number() OVER (PARTITION BY ev.instrument_id ORDER BY ev.ts) AS seq FROM ev
    LEFT JOIN daily o ON o.contract_id = ev.instrument_id || '-' || p AND o.ts = decision_ts LEFT JOIN daily n ON n.contract_id = ev.instrument_id || '-' || maturity AND n.ts = decision_ts
    WHERE p IS NOT NULL AND p <> maturity
)"""


@query("roll_events", "instrument_id ts:t decision_ts:t old_maturity:i new_maturity:i gap:d seq:i", "SELECT * FROM gaps", f"{market.CTE}, {LIQ}, {EVENTS}")
def _(spark, sf_dir):
    return roll.roll_events(front(spark, sf_dir), market.daily(spark, sf_dir))


@query(
    "roll_front_bars",
    "instrument_id ts:t contract_id close:d roll_epoch:i bars_since_roll:i close0:d",
    """SELECT f.instrument_id, f.ts, d.contract_id, d.close, f.roll_epoch, row_number() OVER (PARTITION BY f.instrument_id, f.roll_epoch ORDER BY f.ts) - 1 AS bars_since_roll,
        d.close - coalesce(f.offset0, 0) AS close0 FROM (
        SELECT a.instrument_id, a.ts, a.maturity, count(g.seq) AS roll_epoch, sum(g.gap) AS offset0 FROM act a LEFT JOIN gaps g ON g.instrument_id = a.instrument_id AND g.ts <= a.ts GROUP BY ALL) f
        JOIN daily d ON d.contract_id = f.instrument_id || '-' || f.maturity AND d.ts = f.ts""",
    f"{market.CTE}, {LIQ}, {EVENTS}",
)
def _(spark, sf_dir):
    d = market.daily(spark, sf_dir)
    f = front(spark, sf_dir)
    return roll.front_bars(f, d, roll.roll_events(f, d))


# --- signals --------------------------------------------------------------------------------------

FEATURES = f"""feat AS (SELECT *, round({agg('avg', 'close', 5)}, 9) AS f5, round({agg('avg', 'close', 20)}, 9) AS s20, {agg('max', 'high', 20)} AS hi20, {agg('min', 'low', 20)} AS lo20,
    {agg('avg', 'true_range', 14)} AS atr, 4 * {agg('stddev_pop', 'close', 20)} AS width, (close - {agg('min', 'low', 20)}) / nullif({agg('max', 'high', 20)} - {agg('min', 'low', 20)}, 0) AS pos20,
    (close - {agg('min', 'low', 5)}) / nullif({agg('max', 'high', 5)} - {agg('min', 'low', 5)}, 0) AS pos5, {lag('close', 5)} AS c5 FROM base),
  feat2 AS (SELECT *, {lag('hi20')} AS ph, {lag('lo20')} AS pl FROM feat)"""
F_CTE = BASE_CTE + ", " + FEATURES


def features(spark, sf_dir):
    w = W()
    c = I.c()
    df = base(spark, sf_dir).withColumns(
        {
            "f5": F.round(I.sma(w, 5), 9), "s20": F.round(I.sma(w, 20), 9), "hi20": I.highest(w, 20), "lo20": I.lowest(w, 20), "atr": I.sma(w, 14, I.c("true_range")), "width": 4 * I.std(w, 20),
            "pos20": I.ratio(c - I.lowest(w, 20), I.highest(w, 20) - I.lowest(w, 20)), "pos5": I.ratio(c - I.lowest(w, 5), I.highest(w, 5) - I.lowest(w, 5)), "c5": F.lag("close", 5).over(w),
        }
    )
    return df.withColumns({"ph": F.lag("hi20").over(w), "pl": F.lag("lo20").over(w)})


c = F.col


@query(
    "sig_events_alternating",
    "instrument_id ts:t event",
    f"""SELECT instrument_id, ts, CASE WHEN k = 1 THEN 'entry' ELSE 'exit' END AS event FROM (SELECT *, coalesce(lag(k) OVER (PARTITION BY instrument_id ORDER BY ts), -1) AS pk FROM (
        SELECT instrument_id, ts, CASE WHEN coalesce({lag('rise')}, false) THEN 1 WHEN coalesce({lag('fall')}, false) THEN -1 END AS k FROM (
        SELECT *, s AND NOT coalesce({lag('s')}, false) AS rise, NOT s AND coalesce({lag('s')}, false) AS fall FROM (SELECT *, coalesce(f5 > s20, false) AS s FROM feat2))) WHERE k IS NOT NULL) WHERE k <> pk""",
    F_CTE,
)
def _(spark, sf_dir):
    df = features(spark, sf_dir).withColumn("state", F.coalesce(c("f5") > c("s20"), F.lit(False)))
    return signals.alternated(signals.edges(df, "state", W(), 1), ["instrument_id"], "ts")


@query(
    "sig_stops_and_entry_mask",
    "instrument_id ts:t stop:d may_enter",
    "SELECT instrument_id, ts, CASE WHEN f5 > s20 THEN close - 2 * atr WHEN f5 < s20 THEN close + 2 * atr END AS stop, hour(ts) >= 22 OR hour(ts) <= 4 AS may_enter FROM feat2",
    F_CTE,
)
def _(spark, sf_dir):
    side = F.when(c("f5") > c("s20"), "long").when(c("f5") < c("s20"), "short")
    return features(spark, sf_dir).withColumns({"stop": signals.stops(c("close"), c("atr"), 2, side), "may_enter": signals.session_entry(F.hour("ts"), 22, 4)})


@query(
    "sig_surface_grid",
    "fast:i slow:i instrument_id n_long:i n_short:i",
    f"""SELECT fast, slow, instrument_id, sum(CASE WHEN x > y THEN 1 ELSE 0 END) AS n_long, sum(CASE WHEN x < y THEN 1 ELSE 0 END) AS n_short FROM (
        SELECT *, CASE fast WHEN 3 THEN a3 ELSE a5 END AS x, CASE slow WHEN 10 THEN a10 ELSE a20 END AS y FROM (SELECT instrument_id, {', '.join(f"round({agg('avg', 'close', n)}, 9) AS a{n}" for n in (3, 5, 10, 20))} FROM base),
        (VALUES (3), (5)) f(fast), (VALUES (10), (20)) s(slow)) GROUP BY ALL""",
    BASE_CTE,
)
def _(spark, sf_dir):
    """The cube of time, parameters and instrument in long form: few literal parameter rows by all bars."""
    df = base(spark, sf_dir).withColumns({f"a{n}": F.round(I.sma(W(), n), 9) for n in (3, 5, 10, 20)})
    grid = parameter_grid(spark, {"fast": [3, 5], "slow": [10, 20]}, ["fast < slow"])
    x, y = F.when(c("fast") == 3, c("a3")).otherwise(c("a5")), F.when(c("slow") == 10, c("a10")).otherwise(c("a20"))
    long = df.crossJoin(F.broadcast(grid))
    return long.groupBy("fast", "slow", "instrument_id").agg(F.sum(F.when(x > y, 1).otherwise(0)).alias("n_long"), F.sum(F.when(x < y, 1).otherwise(0)).alias("n_short"))


@query(
    "sim_portfolio",
    "instrument_id entry_ts:t exit_ts:t entry_price:d exit_price:d reason",
    f"""SELECT instrument_id, ets AS entry_ts, ts AS exit_ts, xe AS entry_price, xp AS exit_price, reason FROM (WITH RECURSIVE e AS (
            SELECT *, s AND NOT coalesce({lag('s')}, false) AS rise, NOT s AND coalesce({lag('s')}, false) AS fall FROM (SELECT *, coalesce(f5 > s20, false) AS s FROM feat2)),
        b AS (SELECT instrument_id, ts, open, low, atr, coalesce({lag('rise')}, false) AS entry, coalesce({lag('fall')}, false) AS leave, row_number() OVER (PARTITION BY instrument_id ORDER BY ts) AS rn FROM e),
        p AS (SELECT instrument_id, rn, ts, entry AS held, CASE WHEN entry THEN open END AS ep, CASE WHEN entry THEN coalesce(open - 2 * atr, -1e300) END AS stop, CASE WHEN entry THEN ts END AS since,
                NULL::TIMESTAMP AS ets, NULL::DOUBLE AS xe, NULL::DOUBLE AS xp, NULL::VARCHAR AS reason FROM b WHERE rn = 1
            UNION ALL SELECT b.instrument_id, b.rn, b.ts, CASE WHEN p.held THEN NOT (b.leave OR b.low <= p.stop) ELSE b.entry END,
                CASE WHEN p.held THEN p.ep WHEN b.entry THEN b.open END, CASE WHEN p.held THEN p.stop WHEN b.entry THEN coalesce(b.open - 2 * b.atr, -1e300) END, CASE WHEN p.held THEN p.since WHEN b.entry THEN b.ts END,
                p.since, p.ep, CASE WHEN p.held AND b.leave THEN b.open WHEN p.held AND b.low <= p.stop THEN least(b.open, p.stop) END, CASE WHEN p.held AND b.leave THEN 'exit' WHEN p.held AND b.low <= p.stop THEN 'stop' END
            FROM p JOIN b ON b.instrument_id = p.instrument_id AND b.rn = p.rn + 1) SELECT * FROM p WHERE reason IS NOT NULL)""",
    F_CTE,
)
def _(spark, sf_dir):
    df = features(spark, sf_dir).withColumn("state", F.coalesce(c("f5") > c("s20"), F.lit(False)))
    marked = signals.edges(df, "state", W(), 1)
    return ledger.simulate_long(marked.select("instrument_id", "ts", "open", "low", "entry", "exit", "atr"), ["instrument_id"])


@query(
    "sim_long_short",
    "instrument_id side entry_ts:t exit_ts:t entry_price:d exit_price:d reason",
    f"""SELECT instrument_id, CASE was WHEN 1 THEN 'long' ELSE 'short' END AS side, ets AS entry_ts, ts AS exit_ts, xe AS entry_price, xp AS exit_price, reason FROM (WITH RECURSIVE
        st AS (SELECT *, coalesce(f5 > s20, false) AS u, coalesce(f5 < s20 AND pos20 < 0.3, false) AS d FROM feat2),
        e AS (SELECT *, u AND NOT coalesce({lag('u')}, false) AS ur, NOT u AND coalesce({lag('u')}, false) AS uf, d AND NOT coalesce({lag('d')}, false) AS dr, NOT d AND coalesce({lag('d')}, false) AS df FROM st),
        b AS (SELECT instrument_id, ts, open, high, low, coalesce(2 * atr, 1e300) AS dist, coalesce({lag('ur')}, false) AS le, coalesce({lag('uf')}, false) AS lx, coalesce({lag('dr')}, false) AS se, coalesce({lag('df')}, false) AS sx,
                row_number() OVER (PARTITION BY instrument_id ORDER BY ts) AS rn FROM e),
        p AS (SELECT instrument_id, rn, ts, CASE WHEN le THEN 1 WHEN se THEN -1 ELSE 0 END AS side, open AS ep, CASE WHEN le THEN open - dist ELSE open + dist END AS stop, ts AS since,
                0 AS was, NULL::TIMESTAMP AS ets, NULL::DOUBLE AS xe, NULL::DOUBLE AS xp, NULL::VARCHAR AS reason FROM b WHERE rn = 1
            UNION ALL SELECT instrument_id, rn, ts, now, CASE WHEN fresh THEN open ELSE ep END, CASE WHEN fresh THEN open - now * dist ELSE stop END, CASE WHEN fresh THEN ts ELSE since END, side, since, ep,
                CASE why WHEN 'stop' THEN CASE side WHEN 1 THEN least(open, stop) ELSE greatest(open, stop) END ELSE open END, why
            FROM (SELECT *, CASE why WHEN 'reverse' THEN -side WHEN 'exit' THEN 0 WHEN 'stop' THEN 0 ELSE CASE WHEN side <> 0 THEN side WHEN le THEN 1 WHEN se THEN -1 ELSE 0 END END AS now,
                    why = 'reverse' OR (side = 0 AND (le OR se)) AS fresh
                FROM (SELECT b.*, p.side, p.ep, p.stop, p.since, CASE WHEN p.side = 0 THEN '' WHEN p.side = 1 AND b.se OR p.side = -1 AND b.le THEN 'reverse' WHEN p.side = 1 AND b.lx OR p.side = -1 AND b.sx THEN 'exit'
                        WHEN p.side = 1 AND b.low <= p.stop OR p.side = -1 AND b.high >= p.stop THEN 'stop' ELSE '' END AS why
                    FROM p JOIN b ON b.instrument_id = p.instrument_id AND b.rn = p.rn + 1)))
        SELECT * FROM p WHERE reason <> '' AND reason IS NOT NULL)""",
    F_CTE,
)
def _(spark, sf_dir):
    df = features(spark, sf_dir).withColumns({"up": F.coalesce(c("f5") > c("s20"), F.lit(False)), "down": F.coalesce((c("f5") < c("s20")) & (c("pos20") < 0.3), F.lit(False))})
    df = signals.edges(df, "down", W(), 1).withColumnsRenamed({"entry": "short_entry", "exit": "short_exit"})
    df = signals.edges(df, "up", W(), 1)
    return ledger.simulate(df.select("instrument_id", "ts", "open", "high", "low", "entry", "exit", "short_entry", "short_exit", "atr"), ["instrument_id"])


@query("sim_drawdown", "instrument_id:i max_drawdown:d", "SELECT instrument_id, max(peak - eq) AS max_drawdown FROM (SELECT *, greatest(0, max(eq) OVER w) AS peak FROM (SELECT instrument_id, ts, order_id, fill_no, sum(net_pnl) OVER (PARTITION BY instrument_id ORDER BY ts, order_id, fill_no, net_pnl ROWS UNBOUNDED PRECEDING) AS eq, net_pnl FROM executions) WINDOW w AS (PARTITION BY instrument_id ORDER BY ts, order_id, fill_no, net_pnl ROWS UNBOUNDED PRECEDING)) GROUP BY 1")
def _(spark, sf_dir):
    return ledger.drawdown(market.executions(spark, sf_dir), ["instrument_id"], ["ts", "order_id", "fill_no", "net_pnl"])


@query(
    "sim_position_size",
    "p_partkey:i qty:i",
    "SELECT p_partkey, CASE WHEN q >= 1 THEN q END AS qty FROM (SELECT p_partkey, least(floor(100000 * 0.01 / (p_retailprice * 0.02 / 0.5 * (p_size + 1) / 10)), 50, floor(100000 / (p_retailprice * 3))) AS q FROM part)",
    "",
)
def _(spark, sf_dir):
    price = c("p_retailprice")
    qty = ledger.position_size(F.lit(100000.0), F.lit(0.01), price, F.lit(0.02), F.lit(0.5), (c("p_size") + 1) / 10, F.lit(50), price * 3)
    return table(spark, sf_dir, "part").withColumn("qty", qty)


TRADE_SQL = """SELECT l_orderkey, l_linenumber, price AS entry_price, price * (1 + l_discount - l_tax) AS exit_price, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_quantity AS qty FROM (SELECT *, l_extendedprice / l_quantity AS price FROM lineitem)"""


def trades(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", (c("l_extendedprice") / c("l_quantity")).alias("entry_price"),
        (c("l_extendedprice") / c("l_quantity") * (1 + c("l_discount") - c("l_tax"))).alias("exit_price"), (F.when(c("l_returnflag") == "R", -1).otherwise(1) * c("l_quantity")).alias("qty"),
    )


@query("sim_trade_money", "l_orderkey:i l_linenumber:i gross:f cost:f net:f", f"SELECT *, gross - cost AS net FROM (SELECT *, (exit_price - entry_price) / 0.5 * 2.5 * qty AS gross, 2 * abs(qty) * (1.25 + 0.5 * 2.5) AS cost FROM ({TRADE_SQL}))", "")
def _(spark, sf_dir):
    return ledger.trade_money(trades(spark, sf_dir), F.lit(0.5), F.lit(2.5), F.lit(1.25), F.lit(0.5))


@query(
    "sim_run_stats",
    "instrument_id:i total:f annualised:d sharpe:d sortino:d",
    """SELECT instrument_id, total, CASE WHEN total / 1e7 > -1 THEN pow(1 + total / 1e7, 12.0 / n) - 1 END AS annualised, m / nullif(s, 0) * sqrt(12) AS sharpe, m / nullif(d, 0) * sqrt(12) AS sortino FROM (
        SELECT instrument_id, sum(pnl) AS total, count(*) AS n, avg(pnl) AS m, stddev_pop(pnl) AS s, sqrt(avg(CASE WHEN pnl < 0 THEN pnl * pnl ELSE 0 END)) AS d
        FROM (SELECT instrument_id, date_trunc('month', ts) AS month, sum(net_pnl) AS pnl FROM executions GROUP BY 1, 2) GROUP BY 1)""",
)
def _(spark, sf_dir):
    monthly = market.executions(spark, sf_dir).groupBy("instrument_id", F.date_trunc("month", "ts").alias("month")).agg(F.sum("net_pnl").alias("pnl"))
    return scoring.run_stats(monthly, ["instrument_id"], "pnl", 12, 1e7)


@query(
    "sim_splits",
    "instrument_id role n:i first_ts:t last_ts:t",
    """SELECT instrument_id, role, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM base JOIN (VALUES ('train_1', 0, 99), ('test_1', 104, 149), ('train_2', 50, 149), ('test_2', 154, 199)) w(role, lo, hi) ON bar_index BETWEEN lo AND hi GROUP BY 1, 2""",
    BASE_CTE,
)
def _(spark, sf_dir):
    """Walk-forward windows by bar index with a purge of 4 bars."""
    windows = scoring.walk_forward(100, 46, 50, 4, 2)
    split = spark.createDataFrame(windows, "role string, lo int, hi int")
    return base(spark, sf_dir).join(F.broadcast(split), c("bar_index").between(c("lo"), c("hi"))).groupBy("instrument_id", "role").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


RUNS = """runs AS (SELECT instrument_id AS run_id, instrument_id % 4 AS strategy, instrument_id % 3 AS p1, instrument_id % 5 AS p2, sum(net_pnl) / 1e6 AS ret, count(*) AS n,
    avg(CASE WHEN net_pnl > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END) AS win, sum(abs(price) * abs(qty)) AS traded, sum(net_pnl) + sum(fee) AS gross, sum(net_pnl) AS net FROM executions GROUP BY instrument_id)"""


def runs(spark, sf_dir):
    e = market.executions(spark, sf_dir)
    return e.groupBy(c("instrument_id").alias("run_id")).agg(
        (F.sum("net_pnl") / 1e6).alias("ret"), F.count(F.lit(1)).alias("n"), F.avg((c("net_pnl") > 0).cast("double")).alias("win"), F.sum(F.abs("price") * F.abs("qty")).alias("traded"),
        (F.sum("net_pnl") + F.sum("fee")).alias("gross"), F.sum("net_pnl").alias("net"),
    ).withColumns({"strategy": c("run_id") % 4, "p1": c("run_id") % 3, "p2": c("run_id") % 5})


@query("rank_metric_score", "run_id:i score:d", "SELECT run_id, (2 * (0.5 + 0.5 * tanh(ret)) + greatest(0, least(1, (win - 0.3) / 0.4))) / 3 AS score FROM runs", f"{market.CTE}, {RUNS}")
def _(spark, sf_dir):
    return runs(spark, sf_dir).withColumn("score", scoring.rank_weighted([scoring.tanh_score(c("ret"), 1.0), scoring.linear_score(c("win"), 0.3, 0.7)]))


@query("rank_slippage_score", "run_id:i slippage_score:d", "SELECT run_id, CASE WHEN net - traded * 12.5 / 10000 > 0 THEN 1 WHEN gross <= 0 THEN 0 ELSE gross / (gross + traded * 12.5 / 10000) END AS slippage_score FROM runs", f"{market.CTE}, {RUNS}")
def _(spark, sf_dir):
    return runs(spark, sf_dir).withColumn("slippage_score", scoring.slippage_score(c("net"), c("gross"), c("traded"), 12.5))


@query(
    "rank_fold_consistency",
    "strategy:i consistency:d",
    "SELECT strategy, avg(CASE WHEN pnl > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END) / (1 + stddev_pop(pnl) / greatest(abs(avg(pnl)), 0.02)) AS consistency FROM (SELECT instrument_id % 4 AS strategy, year(ts) AS fold, sum(net_pnl) / 1e6 AS pnl FROM executions GROUP BY 1, 2) GROUP BY 1",
)
def _(spark, sf_dir):
    f = market.executions(spark, sf_dir).groupBy((c("instrument_id") % 4).alias("strategy"), F.year("ts").alias("fold")).agg((F.sum("net_pnl") / 1e6).alias("pnl"))
    return f.groupBy("strategy").agg(scoring.fold_consistency(c("pnl")).alias("consistency"))


@query(
    "rank_parameter_stability",
    "run_id:i stability:d",
    """SELECT a.run_id, CASE WHEN count(b.run_id) = 0 THEN 0.5 ELSE 1 - abs(any_value(a.ret) - avg(b.ret)) / greatest(abs(avg(b.ret)), 0.05) END AS stability
        FROM runs a LEFT JOIN runs b ON a.strategy = b.strategy AND (CASE WHEN a.p1 <> b.p1 THEN 1 ELSE 0 END + CASE WHEN a.p2 <> b.p2 THEN 1 ELSE 0 END) = 1 GROUP BY a.run_id""",
    f"{market.CTE}, {RUNS}",
)
def _(spark, sf_dir):
    return scoring.parameter_stability(runs(spark, sf_dir), "run_id", "strategy", ["p1", "p2"], "ret")


GRADED = """money AS (
    SELECT run_id, max(peak - eq) / 1e6 AS drawdown FROM (SELECT *, greatest(0, max(eq) OVER w) AS peak FROM (
        SELECT instrument_id AS run_id, ts, order_id, fill_no, sum(net_pnl) OVER (PARTITION BY instrument_id ORDER BY ts, order_id, fill_no, net_pnl ROWS UNBOUNDED PRECEDING) AS eq, net_pnl FROM executions)
        WINDOW w AS (PARTITION BY run_id ORDER BY ts, order_id, fill_no, net_pnl ROWS UNBOUNDED PRECEDING)) GROUP BY run_id
), folded AS (
    SELECT run_id, count(*) AS folds, sum(k) AS trades, min(k) AS least_trades, avg(CASE WHEN r > 0 THEN 1.0::DOUBLE ELSE 0.0 END) AS positive_folds,
           least(1, avg(CASE WHEN r > 0 THEN 1.0::DOUBLE ELSE 0.0 END) / (1 + stddev_pop(r) / greatest(abs(avg(r)), 0.02))) AS consistency
    FROM (SELECT instrument_id AS run_id, year(ts) AS fold, sum(net_pnl) / 1e6 AS r, count(*) AS k FROM executions GROUP BY ALL) GROUP BY run_id
), steady AS (
    SELECT a.run_id, CASE WHEN count(b.run_id) = 0 THEN 0.5 ELSE 1 - abs(any_value(a.ret) - avg(b.ret)) / greatest(abs(avg(b.ret)), 0.05) END AS stability
    FROM runs a LEFT JOIN runs b ON a.strategy = b.strategy AND (CASE WHEN a.p1 <> b.p1 THEN 1 ELSE 0 END + CASE WHEN a.p2 <> b.p2 THEN 1 ELSE 0 END) = 1 GROUP BY a.run_id
), graded AS (
    SELECT *, (2 * (0.5 + 0.5 * tanh(ret)) + greatest(0, least(1, (win - 0.3) / 0.4))) / 3 AS objective, greatest(0, least(1, (win - 0.3) / 0.4)) AS preferred,
           CASE WHEN net - traded * 12.5 / 10000 > 0 THEN 1 WHEN gross <= 0 THEN 0 ELSE gross / (gross + traded * 12.5 / 10000) END AS slippage
    FROM runs JOIN folded USING (run_id) JOIN money USING (run_id) JOIN steady USING (run_id)
)"""
SHORT = {
    "min_fold_count": "3 - folds", "min_trade_count": "20 - trades", "min_trade_count_per_fold": "greatest(1, least(4, trades)) - least_trades", "min_positive_fold_ratio": "0.5 - positive_folds",
    "max_drawdown": "drawdown - 0.03", "min_parameter_stability": "0.35 - stability", "min_slippage_score": "0.45 - slippage",
}
POLICY = scoring.Policy(folds=3, trades=20, trades_per_fold=4, positive_folds=0.5, drawdown=0.03, stability=0.35, slippage=0.45)


def graded(spark, sf_dir):
    """Runs with everything that a policy looks at."""
    r, e = runs(spark, sf_dir), market.executions(spark, sf_dir)
    dd = ledger.drawdown(e, ["instrument_id"], ["ts", "order_id", "fill_no", "net_pnl"]).select(c("instrument_id").alias("run_id"), (c("max_drawdown") / 1e6).alias("drawdown"))
    steady = scoring.parameter_stability(r, "run_id", "strategy", ["p1", "p2"], "ret").select("run_id", "stability")
    won = scoring.linear_score(c("win"), 0.3, 0.7)
    r = r.join(scoring.fold_summary(e, "instrument_id", F.year("ts"), 1e6), "run_id").join(dd, "run_id").join(steady, "run_id")
    return r.withColumns({"objective": scoring.rank_weighted([scoring.tanh_score(c("ret"), 1.0), won]), "preferred": won, "slippage": scoring.slippage_score(c("net"), c("gross"), c("traded"), 12.5)})


@query(
    "rank_policy",
    "run_id:i failures policy_pass total:d family_rank:i overall_rank:i",
    f"""SELECT *, fr AS family_rank, row_number() OVER (ORDER BY fr, total DESC, run_id) AS overall_rank FROM (SELECT *, failures = '' AS policy_pass, row_number() OVER (PARTITION BY strategy ORDER BY total DESC, run_id) AS fr FROM (
        SELECT run_id, strategy, concat_ws(',', {', '.join(f"CASE WHEN {x} > 0 THEN '{k}' END" for k, x in SHORT.items())}) AS failures,
        round(0.3 * objective + 0.2 * consistency + 0.2 * stability + 0.15 * slippage + 0.15 * preferred, 9) AS total FROM graded))""",
    f"{market.CTE}, {RUNS}, {GRADED}",
)
def _(spark, sf_dir):
    df = graded(spark, sf_dir)
    df = df.withColumns({"failures": quality.reasons(**{k: x > 0 for k, x in POLICY.shortfalls().items()}), "total": F.round(scoring.total_score(**{k: c(k) for k in scoring.WEIGHTS}), 9)})
    return scoring.family_first(df.withColumn("policy_pass", c("failures") == ""), "strategy", "total", "run_id")


@query(
    "rank_confirmation",
    "strategy:i confirmed confirm_pnl:f n_confirm:i",
    "SELECT strategy, coalesce(sum(pnl) FILTER (WHERE fold >= 1999), 0) > 0 AS confirmed, sum(pnl) FILTER (WHERE fold >= 1999) AS confirm_pnl, count(*) FILTER (WHERE fold >= 1999) AS n_confirm FROM (SELECT instrument_id % 4 AS strategy, year(ts) AS fold, sum(net_pnl) AS pnl FROM executions GROUP BY 1, 2) GROUP BY 1",
)
def _(spark, sf_dir):
    blind = c("fold") >= 1999
    f = market.executions(spark, sf_dir).groupBy((c("instrument_id") % 4).alias("strategy"), F.year("ts").alias("fold")).agg(F.sum("net_pnl").alias("pnl"))
    out = f.groupBy("strategy").agg(F.sum(F.when(blind, c("pnl"))).alias("confirm_pnl"), F.count(F.when(blind, 1)).alias("n_confirm"))
    return out.withColumn("confirmed", F.coalesce(c("confirm_pnl"), F.lit(0.0)) > 0)


@query(
    "eval_forward_observations",
    "event_id:i status entry:d mfe:d mae:d pnl:d",
    f"""SELECT t.event_id, CASE WHEN h.ts IS NULL THEN 'no_market_data' WHEN h.n_ahead < 4 THEN 'no_forward_window' ELSE 'ok' END AS status, h.open AS entry,
        CASE WHEN n_ahead = 4 THEN hi - open END AS mfe, CASE WHEN n_ahead = 4 THEN open - lo END AS mae, CASE WHEN n_ahead = 4 THEN last_close - open END AS pnl
        FROM (SELECT event_id, instrument_id, date_trunc('hour', ts) AS ts FROM ticks) t ASOF LEFT JOIN (
            SELECT *, count(*) OVER f AS n_ahead, max(high) OVER f AS hi, min(low) OVER f AS lo, last_value(close) OVER f AS last_close FROM hourly
            WINDOW f AS (PARTITION BY instrument_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) h ON t.instrument_id = h.instrument_id AND t.ts <= h.ts""",
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).select("event_id", "instrument_id", F.date_trunc("hour", "ts").alias("ts"))
    return scoring.forward_observations(t, market.hourly(spark, sf_dir), ["instrument_id"], 4)


@query(
    "recon_cross_feed",
    "o_orderkey:i status drift_bps:d gate",
    """SELECT coalesce(o_orderkey, l_orderkey) AS o_orderkey, CASE WHEN o_orderkey IS NULL THEN 'unexpected' WHEN l_orderkey IS NULL THEN 'missing' ELSE 'matched' END AS status,
        abs(total - o_totalprice) / nullif(o_totalprice, 0) * 10000 AS drift_bps, CASE WHEN o_orderkey IS NULL OR l_orderkey IS NULL THEN 'FAIL' WHEN coalesce(abs(total - o_totalprice) / nullif(o_totalprice, 0) * 10000, 0) > CASE WHEN o_orderstatus = 'F' THEN 5000 ELSE 9000 END THEN 'FAIL' ELSE 'PASS' END AS gate
        FROM orders FULL JOIN (SELECT l_orderkey, sum(l_extendedprice) AS total FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
    "",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("total"))
    return scoring.reconciled(table(spark, sf_dir, "orders"), lines)


BROKER = """intents AS (SELECT o_orderkey AS intent_id, o_custkey % 4 + 1 AS qty FROM orders WHERE o_orderpriority <> '5-LOW'),
broker AS (
    SELECT o_orderkey * 10 + k AS broker_order_id, o_orderkey AS intent_id, CASE WHEN o_orderpriority <> '1-URGENT' THEN 'X' || o_orderkey END AS external_order_id,
           CASE WHEN k = 0 THEN 'new' WHEN o_orderstatus = 'F' THEN 'filled' WHEN o_orderstatus = 'O' THEN 'submitted' ELSE 'partially_filled' END AS state, o_orderdate::DATE + k AS ts
    FROM orders, (VALUES (0), (1)) v(k) WHERE month(o_orderdate::DATE) <> 1 AND (k = 1 OR o_orderkey % 2 = 0)
), filled AS (SELECT l_orderkey * 10 + CASE WHEN l_returnflag = 'R' AND l_linenumber >= 5 THEN 5 ELSE 1 END AS broker_order_id, 1 AS qty FROM lineitem)"""


@query(
    "recon_execution_reasons",
    "intent_id:i broker_order_id:i reason n:i",
    """SELECT intent_id, broker_order_id, reason, count(*) AS n FROM (
        SELECT intent_id, broker_order_id, unnest(list_filter([CASE WHEN broker_order_id IS NULL THEN 'missing_broker_order_ack' END,
            CASE WHEN broker_order_id IS NOT NULL AND coalesce(external_order_id, '') = '' THEN 'missing_external_order_id' END,
            CASE WHEN filled > 0 AND state IN ('new', 'submitted', 'replaced') THEN 'stale_order_state_vs_fill' END,
            CASE WHEN state = 'filled' AND filled < qty THEN 'filled_state_without_enough_fills' END,
            CASE WHEN broker_order_id IS NOT NULL AND filled > qty THEN 'fill_qty_exceeds_expected' END], lambda x: x IS NOT NULL)) AS reason
        FROM (SELECT i.intent_id, i.qty, o.broker_order_id, o.external_order_id, o.state, coalesce(f.q, 0) AS filled FROM intents i
            LEFT JOIN (SELECT * FROM broker QUALIFY row_number() OVER (PARTITION BY intent_id ORDER BY ts DESC, broker_order_id DESC) = 1) o USING (intent_id)
            LEFT JOIN (SELECT broker_order_id, sum(qty) AS q FROM filled GROUP BY 1) f ON f.broker_order_id = o.broker_order_id)
        UNION ALL SELECT intent_id, broker_order_id, 'unexpected_broker_order' FROM broker WHERE intent_id NOT IN (SELECT intent_id FROM intents)
        UNION ALL SELECT NULL, broker_order_id, 'orphan_fill_without_order' FROM filled WHERE broker_order_id NOT IN (SELECT broker_order_id FROM broker)) GROUP BY ALL""",
    f"{market.CTE}, {BROKER}",
)
def _(spark, sf_dir):
    o, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    intents = o.where("o_orderpriority <> '5-LOW'").select(c("o_orderkey").alias("intent_id"), (c("o_custkey") % 4 + 1).alias("qty"))
    tries = o.where(F.month(F.to_date("o_orderdate")) != 1).withColumn("k", F.explode(F.array(F.lit(0), F.lit(1)))).where("k = 1 OR o_orderkey % 2 = 0")
    state = F.when(c("k") == 0, "new").when(c("o_orderstatus") == "F", "filled").when(c("o_orderstatus") == "O", "submitted").otherwise("partially_filled")
    broker = tries.select(
        (c("o_orderkey") * 10 + c("k")).alias("broker_order_id"), c("o_orderkey").alias("intent_id"), F.when(c("o_orderpriority") != "1-URGENT", F.concat(F.lit("X"), c("o_orderkey").cast("string"))).alias("external_order_id"),
        state.alias("state"), F.date_add(F.to_date("o_orderdate"), c("k")).alias("ts"),
    )
    late = F.when((c("l_returnflag") == "R") & (c("l_linenumber") >= 5), 5).otherwise(1)
    fills = lines.select((c("l_orderkey") * 10 + late).alias("broker_order_id"), F.lit(1).alias("qty"))
    return scoring.execution_drifts(intents, broker, fills).groupBy("intent_id", "broker_order_id", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "recon_positions",
    "instrument_id:i reason",
    """SELECT coalesce(a.i, b.i) AS instrument_id, CASE WHEN a.q IS NULL THEN 'unexpected_position' WHEN b.q IS NULL THEN 'missing_position' WHEN a.q <> b.q THEN 'position_qty_mismatch' ELSE 'position_price_mismatch' END AS reason
        FROM (SELECT instrument_id AS i, sum(qty) AS q, max(price) AS p FROM executions WHERE year(ts) < 1998 GROUP BY 1) a
        FULL JOIN (SELECT instrument_id AS i, sum(qty) AS q, max(price) AS p FROM executions WHERE month(ts) <> 2 GROUP BY 1) b ON a.i = b.i WHERE a.q IS DISTINCT FROM b.q OR abs(a.p - b.p) > 1e-9""",
)
def _(spark, sf_dir):
    e = market.executions(spark, sf_dir)
    held = lambda when: e.where(when).groupBy("instrument_id").agg(F.sum("qty").alias("qty"), F.max("price").alias("price"))
    return scoring.position_drifts(held(F.year("ts") < 1998), held(F.month("ts") != 2), ["instrument_id"])


@query(
    "paper_positions",
    "order_id:i fill_no:i position:d average_price:d",
    """SELECT order_id, fill_no, q AS position, avg AS average_price FROM (WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts, fill_no, price, qty) AS rn FROM executions),
        p AS (SELECT order_id, fill_no, rn, qty AS q, price AS avg FROM s WHERE rn = 1 UNION ALL
            SELECT s.order_id, s.fill_no, s.rn, p.q + s.qty, CASE WHEN p.q * s.qty >= 0 THEN (abs(p.q) * p.avg + abs(s.qty) * s.price) / (abs(p.q) + abs(s.qty))
                WHEN abs(s.qty) > abs(p.q) THEN s.price WHEN abs(s.qty) = abs(p.q) THEN 0 ELSE p.avg END FROM p JOIN s ON s.order_id = p.order_id AND s.rn = p.rn + 1) SELECT * FROM p)""",
)
def _(spark, sf_dir):
    fills = market.executions(spark, sf_dir).select("order_id", "fill_no", "ts", "price", "qty")
    return ledger.folded_positions(fills, ["order_id"], ["ts", "fill_no", "price", "qty"])


RULES = [("view", "1990-01-01", "2024-01-15", "USD", 0.5, 10, 0.2), ("view", "2024-01-16", "2099-01-01", "USD", 0.5, 10, 0.3), ("click", "1990-01-01", "2099-01-01", "RUB", 0.5, 10, 7.0), ("purchase", "1990-01-01", "2099-01-01", "RUB", 1.0, 10, 3.0)]
ECONOMICS = f"""spec AS (
    SELECT contract_id, instrument_id AS asset, ts::DATE AS trade_date, CASE WHEN instrument_id IN ('view', 'signup') THEN 'USD' ELSE 'RUB' END AS currency, 0.5::DOUBLE AS min_step, 10 AS lot,
           CASE WHEN n % 3 = 0 THEN open / 100 END AS official_step_price, close AS settle, CASE WHEN volume % 2 = 0 THEN high * 2 END AS official_margin FROM daily
), rate AS (SELECT 'USD' AS currency, ts::DATE AS rate_date, CASE user_id % 3 WHEN 0 THEN 'tc' WHEN 1 THEN 'mc' ELSE 'xx' END AS clearing, 60 + max(value) / 10 AS rate FROM events WHERE day(ts) <> 7 GROUP BY ALL),
day_rate AS (SELECT currency, rate_date, arg_min(rate, CASE clearing WHEN 'tc' THEN 1 WHEN 'mc' THEN 2 ELSE 3 END) AS rate FROM rate GROUP BY ALL),
risk AS (SELECT instrument_id AS asset, ts::DATE AS risk_date, 0.1 + max(high) / 1000 AS mr1, max(n) % 5 * 1.5 AS radius_pct FROM daily WHERE day(ts) % 2 = 0 GROUP BY ALL),
rule AS (SELECT asset, f::DATE AS f, t::DATE AS t, cur, step, lot, v FROM (VALUES {', '.join(str(r) for r in RULES)}) r(asset, f, t, cur, step, lot, v)),
priced AS (
    SELECT s.*, k.mr1, k.radius_pct, CASE WHEN official_step_price > 0 THEN official_step_price WHEN r.step = s.min_step AND r.lot = s.lot THEN r.v * CASE WHEN r.cur = 'RUB' THEN 1 ELSE d.rate END END AS step_price,
           CASE WHEN official_step_price > 0 THEN 'official' WHEN r.step = s.min_step AND r.lot = s.lot AND r.v * CASE WHEN r.cur = 'RUB' THEN 1 ELSE d.rate END > 0 THEN 'rule' ELSE 'unavailable' END AS step_source,
           CASE WHEN s.currency = 'RUB' THEN 1 ELSE d.rate END AS fx_rate
    FROM spec s ASOF LEFT JOIN risk k ON k.asset = s.asset AND s.trade_date >= k.risk_date LEFT JOIN rule r ON r.asset = s.asset AND s.trade_date BETWEEN r.f AND r.t LEFT JOIN day_rate d ON d.rate_date = s.trade_date
), margins AS (
    SELECT *, step_price / fx_rate AS tick_value, settle * (step_price / min_step) * mr1 AS margin_base,
           settle * (step_price / min_step) * mr1 * (1 + CASE WHEN currency <> 'RUB' OR asset = 'click' THEN radius_pct ELSE 0 END / 100) AS margin_radius, lead(trade_date) OVER (PARTITION BY contract_id ORDER BY trade_date) AS effective_to FROM priced
), usable AS (SELECT * FROM margins WHERE official_margin > 0 AND margin_radius > 0),
factor AS (SELECT asset, min(official_margin / margin_radius) AS factor FROM usable u WHERE trade_date = (SELECT max(trade_date) FROM usable x WHERE x.asset = u.asset) GROUP BY asset)"""


@query(
    "contract_economics",
    "contract_id trade_date:D effective_to:D step_source step_price:d tick_value:d margin_base:d margin_radius:d margin:d",
    "SELECT *, margin_radius * factor AS margin FROM margins LEFT JOIN factor USING (asset)",
    f"{market.CTE}, {ECONOMICS}",
)
def _(spark, sf_dir):
    d, e = market.daily(spark, sf_dir), table(spark, sf_dir, "events")
    day = F.to_date("ts")
    specs = d.select(
        "contract_id", c("instrument_id").alias("asset"), day.alias("trade_date"), F.when(c("instrument_id").isin("view", "signup"), "USD").otherwise("RUB").alias("currency"), F.lit(0.5).alias("min_step"), F.lit(10).alias("lot"),
        F.when(c("n") % 3 == 0, c("open") / 100).alias("official_step_price"), c("close").alias("settle"), F.when(c("volume") % 2 == 0, c("high") * 2).alias("official_margin"),
    )
    clearing = F.when(c("user_id") % 3 == 0, "tc").when(c("user_id") % 3 == 1, "mc").otherwise("xx")
    rates = e.where(F.dayofmonth("ts") != 7).groupBy(F.lit("USD").alias("currency"), day.alias("rate_date"), clearing.alias("clearing")).agg((60 + F.max("value") / 10).alias("rate"))
    risk = d.where(F.dayofmonth("ts") % 2 == 0).groupBy(c("instrument_id").alias("asset"), day.alias("risk_date")).agg((0.1 + F.max("high") / 1000).alias("mr1"), (F.max("n") % 5 * 1.5).alias("radius_pct"))
    rules = spark.createDataFrame(RULES, "asset string, valid_from string, valid_to string, rule_currency string, rule_min_step double, rule_lot int, tick_value_quote double")
    rules = rules.withColumns({k: c(k).cast("date") for k in ("valid_from", "valid_to")})
    return economics.economics(specs, rates, risk, rules, linked=("click",))


@query(
    "instrument_tree",
    "instrument_id n_contracts:i contracts first_ts:t",
    "SELECT instrument_id, count(DISTINCT contract_id) AS n_contracts, string_agg(DISTINCT contract_id, ',' ORDER BY contract_id) AS contracts, min(ts) AS first_ts FROM ticks GROUP BY 1",
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).groupBy("instrument_id", "contract_id").agg(F.min("ts").alias("first_ts"))
    return t.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n_contracts"), F.array_join(F.array_sort(F.collect_list("contract_id")), ",").alias("contracts"), F.min("first_ts").alias("first_ts"))


@query(
    "bar_usage_profiles",
    "contract_id ts:t profile flags:i may_enter",
    """SELECT contract_id, ts, profile, flags, flags & 2 = 2 AS may_enter FROM (SELECT *, CASE profile WHEN 'shortened_risk' THEN 261 WHEN 'boundary_risk' THEN 133 WHEN 'incomplete' THEN 5 WHEN 'risk_only' THEN 5 ELSE 127 END AS flags FROM (
        SELECT *, CASE WHEN n = 1 THEN 'shortened_risk' WHEN day(ts) IN (1, 30) THEN 'boundary_risk' WHEN n = 2 THEN 'incomplete' WHEN dayofweek(ts) IN (0, 6) THEN 'risk_only' ELSE 'regular_trading' END AS profile FROM daily))""",
)
def _(spark, sf_dir):
    from barloom.functions.scalars import PROFILES, has_flags

    profile = (
        F.when(c("n") == 1, "shortened_risk").when(F.dayofmonth("ts").isin(1, 30), "boundary_risk").when(c("n") == 2, "incomplete").when(F.dayofweek("ts").isin(1, 7), "risk_only").otherwise("regular_trading")
    )
    lookup = F.create_map(*[F.lit(x) for kv in PROFILES.items() for x in kv])
    df = market.daily(spark, sf_dir).withColumn("profile", profile).withColumn("flags", lookup[c("profile")])
    return df.withColumn("may_enter", has_flags(c("flags"), 2))



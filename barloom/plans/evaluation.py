"""Evaluation queries: scorecards, trial scores, nested walk-forward plans, outcomes, admission, specs, manifests."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators import bars as B
from barloom.operators import joins, quality, scoring
from barloom.plans import market
from barloom.plans.indicators import CTE as BASE_CTE
from barloom.plans.indicators import base
from barloom.plans.market import table
from barloom.plans.registry import query
from barloom.plans.research import GRADED, POLICY, RUNS, SHORT, graded, runs

c = F.col
R_CTE = f"{market.CTE}, {RUNS}"


@query(
    "eval_scorecard",
    "strategy:i avg_score:d risk_reward:d active:i criteria readiness",
    """SELECT *, CASE WHEN criteria = '' THEN 'ready' WHEN criteria LIKE '%,%' THEN 'blocked' ELSE 'watch' END AS readiness FROM (
        SELECT strategy, avg(0.5 + 0.5 * tanh(ret)) AS avg_score, avg(gross) / nullif(avg(traded), 0) AS risk_reward, count(DISTINCT run_id) FILTER (WHERE n > 100) AS active,
        concat_ws(',', CASE WHEN avg(ret) <= 0 THEN 'return' END, CASE WHEN avg(win) < 0.5 THEN 'win_rate' END, CASE WHEN count(DISTINCT run_id) FILTER (WHERE n > 100) < 2 THEN 'breadth' END) AS criteria FROM runs GROUP BY 1)""",
    R_CTE,
)
def _(spark, sf_dir):
    active = F.countDistinct(F.when(c("n") > 100, c("run_id")))
    s = runs(spark, sf_dir).groupBy("strategy").agg(
        F.avg(scoring.tanh_score(c("ret"), 1.0)).alias("avg_score"), (F.avg("gross") / F.when(F.avg("traded") != 0, F.avg("traded"))).alias("risk_reward"), active.alias("active"), F.avg("ret").alias("r"), F.avg("win").alias("w")
    )
    s = s.withColumn("criteria", quality.reasons(**{"return": c("r") <= 0}, win_rate=c("w") < 0.5, breadth=c("active") < 2))
    return s.withColumn("readiness", F.when(c("criteria") == "", "ready").when(c("criteria").contains(","), "blocked").otherwise("watch"))


@query(
    "eval_trial_score",
    "run_id:i score:d passed " + " ".join(f"{k}:d" for k in SHORT),
    f"""SELECT *, round(0.3 * objective + 0.2 * consistency + 0.2 * 0.5 + 0.15 * slippage + 0.15 * objective, 9) AS score, {' AND '.join(f'{k} <= 0' for k in SHORT)} AS passed
        FROM (SELECT run_id, objective, consistency, slippage, {', '.join(f"{x.replace('stability', '0.5')} AS {k}" for k, x in SHORT.items())} FROM graded)""",
    f"{R_CTE}, {GRADED}",
)
def _(spark, sf_dir):
    """A trial before its neighbours are known: stability is a half, the objective is the preferred metric too."""
    df = graded(spark, sf_dir).withColumn("stability", F.lit(0.5))
    score = scoring.total_score(**{k: c("objective" if k == "preferred" else k) for k in scoring.WEIGHTS})
    short = POLICY.shortfalls()
    return df.withColumns({"score": F.round(score, 9), "passed": reduce(lambda a, b: a & b, (x <= 0 for x in short.values())), **short})


@query(
    "eval_nested_walk_forward",
    "window_id role warmup_start:D analysis_start:D analysis_end:D score_start:D score_end:D embargo_end:D n:i",
    """SELECT *, (SELECT count(*) FROM executions e WHERE e.ts::DATE >= score_start AND e.ts::DATE < score_end) AS n FROM (
        SELECT window_id, role, lo - INTERVAL 20 DAY AS warmup_start, lo AS analysis_start, cut AS analysis_end, cut + INTERVAL 5 DAY AS score_start, hi AS score_end, hi + INTERVAL 3 DAY AS embargo_end FROM (
            SELECT format('outer-{:02d}__inner-{:02d}', k + 1, j + 1) AS window_id, 'optimization_validation' AS role, s + to_months(6 * k + 3 * j) AS lo, s + to_months(6 * k + 3 * j + 6) AS cut, s + to_months(6 * k + 3 * j + 9) AS hi
            FROM (SELECT DATE '1993-01-31' AS s), generate_series(0, 99) o(k), generate_series(0, 99) i(j) WHERE s + to_months(6 * k + 15) <= DATE '1998-07-01' AND 3 * j + 9 <= 12
            UNION ALL SELECT format('outer-{:02d}__confirmation', k + 1), 'confirmation', s + to_months(6 * k), s + to_months(6 * k + 12), s + to_months(6 * k + 15)
            FROM (SELECT DATE '1993-01-31' AS s), generate_series(0, 99) o(k) WHERE s + to_months(6 * k + 15) <= DATE '1998-07-01'))""",
)
def _(spark, sf_dir):
    plan = scoring.nested_walk_forward(dt.date(1993, 1, 31), dt.date(1998, 7, 1), (12, 3, 6), (6, 3, 3), purge=5, embargo=3, warmup=20)
    p = spark.createDataFrame([tuple(w.values()) for w in plan], ", ".join(f"{k} {'string' if k in ('window_id', 'role') else 'date'}" for k in plan[0]))
    day = F.to_date("ts")
    e = market.executions(spark, sf_dir).groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("m"))
    return F.broadcast(p).join(e, (c("day") >= c("score_start")) & (c("day") < c("score_end")), "left").groupBy(*plan[0]).agg(F.coalesce(F.sum("m"), F.lit(0)).alias("n"))  # a plan, not data


@query(
    "eval_candidate_policies",
    "policy run_id:i",
    """SELECT 'robust' AS policy, run_id FROM runs WHERE win >= 0.49 QUALIFY row_number() OVER (ORDER BY ret DESC, run_id) <= 3
        UNION ALL SELECT 'policy', run_id FROM runs WHERE n >= 12 QUALIFY row_number() OVER (ORDER BY win DESC, run_id) <= 3
        UNION ALL SELECT 'family', run_id FROM runs QUALIFY row_number() OVER (PARTITION BY strategy ORDER BY ret DESC, run_id) = 1
        UNION ALL SELECT 'all', run_id FROM runs""",
    R_CTE,
)
def _(spark, sf_dir):
    r = runs(spark, sf_dir)
    top = lambda df, by, k: df.orderBy(F.desc(by), "run_id").limit(k)
    first = F.row_number().over(Window.partitionBy("strategy").orderBy(F.desc("ret"), "run_id"))
    picks = {"robust": top(r.where("win >= 0.49"), "ret", 3), "policy": top(r.where("n >= 12"), "win", 3), "family": r.withColumn("k", first).where("k = 1"), "all": r}
    out = None
    for name, df in picks.items():
        part = df.select(F.lit(name).alias("policy"), "run_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "eval_readiness",
    "run_id:i blockers n_blockers:i level:i",
    """SELECT run_id, blockers, n_blockers, CASE WHEN n_blockers = 0 THEN 3 WHEN n_blockers = 1 THEN 2 WHEN n_blockers = 2 THEN 1 ELSE 0 END AS level FROM (
        SELECT run_id, concat_ws(',', CASE WHEN ret <= 0 THEN 'no_return' END, CASE WHEN win < 0.5 THEN 'low_win' END, CASE WHEN gross < traded * 0.001 THEN 'thin_edge' END) AS blockers,
        CASE WHEN ret <= 0 THEN 1 ELSE 0 END + CASE WHEN win < 0.5 THEN 1 ELSE 0 END + CASE WHEN gross < traded * 0.001 THEN 1 ELSE 0 END AS n_blockers FROM runs)""",
    R_CTE,
)
def _(spark, sf_dir):
    blocks = {"no_return": c("ret") <= 0, "low_win": c("win") < 0.5, "thin_edge": c("gross") < c("traded") * 0.001}
    n = sum((b.cast("int") for b in blocks.values()), F.lit(0))
    r = runs(spark, sf_dir).withColumns({"blockers": quality.reasons(**blocks), "n_blockers": n})
    return r.withColumn("level", F.greatest(F.lit(0), 3 - c("n_blockers")))


@query(
    "eval_signal_outcomes",
    "user_id:i opened:t fills:i qty:d outcome",
    """SELECT user_id, opened, coalesce(fills, 0) AS fills, qty, CASE WHEN fills IS NULL THEN 'unfilled' WHEN abs(qty) < 1e-9 THEN 'flat' WHEN closed IS NULL THEN 'open' ELSE 'closed_with_position' END AS outcome FROM (
        SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS opened, max(ts) FILTER (WHERE event_type = 'purchase') AS closed FROM events GROUP BY 1) e
        LEFT JOIN (SELECT order_id AS user_id, count(*) AS fills, sum(qty) AS qty FROM executions GROUP BY 1) f USING (user_id)""",
)
def _(spark, sf_dir):
    when = lambda kind: F.when(c("event_type") == kind, c("ts"))
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(when("signup")).alias("opened"), F.max(when("purchase")).alias("closed"))
    f = market.executions(spark, sf_dir).groupBy(c("order_id").alias("user_id")).agg(F.count(F.lit(1)).alias("f"), F.sum("qty").alias("qty"))
    outcome = F.when(c("f").isNull(), "unfilled").when(F.abs("qty") < 1e-9, "flat").when(c("closed").isNull(), "open").otherwise("closed_with_position")
    return e.join(f, "user_id", "left").withColumns({"fills": F.coalesce("f", F.lit(0)), "outcome": outcome})


SESSIONS = """sessions AS (
    SELECT d.day, s.opens + d.day AS opens, s.closes + d.day AS closes FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM ticks) d,
        (VALUES (INTERVAL 7 HOUR, INTERVAL 14 HOUR), (INTERVAL 845 MINUTE, INTERVAL 1125 MINUTE), (INTERVAL 1145 MINUTE, INTERVAL 1430 MINUTE)) s(opens, closes) WHERE dayofweek(d.day) NOT IN (0, 6)
)"""


def verdicts_sql(candles: str, minutes: int) -> str:
    """instrument_id, ts, best: 2 within an interval, 1 at its boundary, 0."""
    end = f"c.ts + INTERVAL {minutes} MINUTE"
    return f"""SELECT c.instrument_id, c.ts, coalesce(max(CASE WHEN c.ts >= s.opens - INTERVAL 60 SECOND AND {end} <= s.closes AND {end} > s.opens THEN 2 WHEN {end} = s.opens OR c.ts = s.closes THEN 1 ELSE 0 END), 0) AS best
        FROM ({candles}) c LEFT JOIN sessions s ON s.day = date_trunc('day', c.ts) GROUP BY ALL"""


QUARTERS = "SELECT DISTINCT instrument_id, to_timestamp(floor(epoch(ts) / 900) * 900)::TIMESTAMP AS ts FROM ticks"


@query(
    "admission_pipeline",
    "instrument_id ts:t verdict",
    f"""SELECT h.instrument_id, h.ts, CASE WHEN h.best = 2 THEN 'admitted' WHEN h.best = 1 THEN 'boundary_ignored' WHEN x.n > 0 AND x.n = x.k THEN 'covered_ignored' ELSE 'rejected' END AS verdict
        FROM ({verdicts_sql('SELECT instrument_id, ts FROM hourly', 60)}) h LEFT JOIN (
            SELECT instrument_id, date_trunc('hour', ts) AS ts, count(*) FILTER (WHERE best = 2) AS n, count(*) FILTER (WHERE best = 2 AND there) AS k FROM (
                SELECT v.*, q.ts IS NOT NULL AS there FROM ({verdicts_sql("SELECT instrument_id, ts + to_minutes(CAST(m AS BIGINT)) AS ts FROM hourly, (VALUES (0), (15), (30), (45)) k(m)", 15)}) v LEFT JOIN ({QUARTERS}) q USING (instrument_id, ts)) GROUP BY 1, 2) x USING (instrument_id, ts)""",
    f"{market.CTE}, {SESSIONS}",
)
def _(spark, sf_dir):
    """Hourly candles against a table of session intervals: admitted, ignored at a boundary, ignored because admitted quarters cover them, or rejected."""
    t = market.ticks(spark, sf_dir)
    day = F.date_trunc("day", "ts")
    days = t.select(day.alias("day")).distinct().where(~F.dayofweek("day").isin(1, 7))
    spans = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in ((420, 840), (845, 1125), (1145, 1430))))
    minute = lambda m: F.timestamp_seconds(F.unix_timestamp("day") + m * 60)
    intervals = days.withColumn("s", F.explode(spans)).select("day", minute(c("s.a")).alias("opens"), minute(c("s.b")).alias("closes"))
    coarse = market.hourly(spark, sf_dir).select("instrument_id", "ts", day.alias("day"))
    fine = t.select("instrument_id", B.bucket_start(c("ts"), 15).alias("ts")).distinct().withColumn("day", day)
    every = intervals.join(coarse.select("instrument_id").distinct(), how="cross")  # a few instruments by a day's intervals: the table of intervals
    keys = ["instrument_id", "day"]
    out = joins.admitted(coarse, every, keys, 60)
    fine = joins.admitted(fine, every, keys, 15).where("verdict = 'admitted'")
    covered = joins.covered_by_finer(out.where("verdict = 'rejected'"), fine, every, keys, 60, 15).select(*(c(k).alias(f"_{k}") for k in ("instrument_id", "ts")), F.lit(True).alias("_covered"))
    out = out.join(covered, (c("instrument_id") == c("_instrument_id")) & (c("ts") == c("_ts")), "left")
    return out.withColumn("verdict", F.when(c("_covered"), "covered_ignored").otherwise(c("verdict")))


@query(
    "spec_latest_snapshot",
    "user_id:i k:i seen:i source",
    """SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, n AS seen, event_type AS source FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL) WHERE rn = 1""",
    "",
)
def _(spark, sf_dir):
    """Payload history parsed, and the last payload of each key."""
    e = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long")).where("k IS NOT NULL")
    last = F.max_by(F.struct("k", "event_type"), F.struct("ts", "event_id"))
    return e.groupBy("user_id").agg(last.alias("r"), F.count(F.lit(1)).alias("seen")).select("user_id", "r.k", "seen", c("r.event_type").alias("source"))


ROW_TEXT = "event_id || '|' || contract_id || '|' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '|' || CAST(round(price * 1000) AS BIGINT) || '|' || volume || '|' || open_interest"


@query(
    "dataset_manifest",
    "name n_rows:i first_ts:t last_ts:t digest",
    f"""SELECT 'ticks-v1' AS name, count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts, sha256('ticks-v1|' || count(*) || '|' || sum(h)) AS digest
        FROM (SELECT *, ('0x' || left(sha256({ROW_TEXT}), 12))::BIGINT AS h FROM ticks)""",
)
def _(spark, sf_dir):
    """A digest of the content: row hashes are summed up, so it doesn't depend on order."""
    text = F.concat_ws("|", "event_id", "contract_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.round(c("price") * 1000).cast("long"), "volume", "open_interest")
    h = F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("decimal(38,0)")
    m = market.ticks(spark, sf_dir).withColumn("h", h).agg(F.count(F.lit(1)).alias("n_rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("h").cast("string").alias("total")).withColumn("name", F.lit("ticks-v1"))
    return m.withColumn("digest", F.sha2(F.concat_ws("|", "name", c("n_rows").cast("string"), "total"), 256))


@query(
    "frame_loader",
    "instrument_id ts:t close:d ret_1:d hits:i",
    "SELECT b.instrument_id, b.ts, b.close, b.ret_1, t.hits FROM base b LEFT JOIN (SELECT instrument_id, date_trunc('hour', ts) AS ts, count(*) AS hits FROM ticks WHERE price > 50 GROUP BY ALL) t USING (instrument_id, ts) WHERE b.instrument_id IN ('click', 'view') AND b.ts >= TIMESTAMP '2024-01-05'",
    BASE_CTE,
)
def _(spark, sf_dir):
    """Bars with indicators and derived columns of a scope."""
    hits = market.ticks(spark, sf_dir).where("price > 50").groupBy("instrument_id", F.date_trunc("hour", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("hits"))
    b = base(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    return b.join(hits, ["instrument_id", "ts"], "left").where("instrument_id IN ('click', 'view') AND ts >= TIMESTAMP'2024-01-05'")


@query("input_fail_codes", "column_name code", "SELECT * FROM (VALUES ('close', 'OK'), ('ema_20', 'MISSING_CLOCK_INPUT'), ('mtf_1h_to_15m_rsi_14', 'MISSING_MTF_INPUT')) v(column_name, code)", "")
def _(spark, sf_dir):
    """Which required columns bars don't have, by kind."""
    have = set(market.hourly(spark, sf_dir).columns)
    needed = ["close", "ema_20", "mtf_1h_to_15m_rsi_14"]
    code = lambda n: "OK" if n in have else "MISSING_MTF_INPUT" if n.startswith("mtf_") else "MISSING_CLOCK_INPUT"
    return spark.createDataFrame([(n, code(n)) for n in needed], "column_name string, code string")


@query(
    "roll_aware_change",
    "instrument_id ts:t roc_native:d crosses_roll",
    """SELECT instrument_id, ts, CASE WHEN NOT crosses_roll THEN 100 * (close - p) / nullif(p, 0) END AS roc_native, crosses_roll FROM (SELECT *, lag(close, 3) OVER w AS p,
        min(epoch_id) OVER (PARTITION BY instrument_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) <> max(epoch_id) OVER (PARTITION BY instrument_id ORDER BY ts ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS crosses_roll
        FROM (SELECT instrument_id, ts, close, floor((bar_index) / 25) AS epoch_id FROM base) WINDOW w AS (PARTITION BY instrument_id ORDER BY ts))""",
    BASE_CTE,
)
def _(spark, sf_dir):
    """A change over native prices is null where its window crosses a roll."""
    w = Window.partitionBy("instrument_id").orderBy("ts")
    four = w.rowsBetween(-3, 0)
    df = base(spark, sf_dir).withColumn("e", F.floor(c("bar_index") / 25))
    p = F.lag("close", 3).over(w)
    df = df.withColumns({"p": p, "crosses_roll": F.min("e").over(four) != F.max("e").over(four)})
    return df.withColumn("roc_native", F.when(~c("crosses_roll") & (c("p") != 0), 100 * (c("close") - c("p")) / c("p")))


@query(
    "recon_watermarks",
    "contract_id status:i",
    "SELECT coalesce(a.contract_id, b.contract_id) AS contract_id, CASE WHEN a.w IS NULL THEN 2 WHEN b.w IS NULL THEN 1 WHEN a.w > b.w THEN 3 ELSE 0 END AS status FROM (SELECT contract_id, max(ts) AS w FROM ticks WHERE contract_id <> 'click-0' GROUP BY 1) a FULL JOIN (SELECT contract_id, max(ts) AS w FROM ticks WHERE contract_id <> 'view-1' AND event_id % 2 = 0 GROUP BY 1) b USING (contract_id)",
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir)
    a = t.where("contract_id <> 'click-0'").groupBy("contract_id").agg(F.max("ts").alias("w"))
    b = t.where("contract_id <> 'view-1' AND event_id % 2 = 0").groupBy(c("contract_id").alias("k")).agg(F.max("ts").alias("v"))
    j = a.join(b, c("contract_id") == c("k"), "full")
    status = F.when(c("w").isNull(), 2).when(c("v").isNull(), 1).when(c("w") > c("v"), 3).otherwise(0)
    return j.select(F.coalesce("contract_id", "k").alias("contract_id"), status.alias("status"))


@query("audit_scope_difference", "contract_id status", "SELECT contract_id, CASE WHEN contract_id = 'extra-9' THEN 'missing' WHEN contract_id LIKE '%-2' THEN 'unexpected' ELSE 'matched' END AS status FROM (SELECT DISTINCT contract_id FROM ticks UNION ALL SELECT 'extra-9')")
def _(spark, sf_dir):
    have = market.ticks(spark, sf_dir).select("contract_id").distinct()
    wanted = have.where("contract_id NOT LIKE '%-2'").unionByName(spark.createDataFrame([("extra-9",)], "contract_id string"))
    return joins.key_difference(wanted, have, ["contract_id"])

"""Aggregation, deduplication and quality-gate queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators import bars as B
from barloom.operators import ledger, merge, quality
from barloom.plans import market
from barloom.plans.market import table
from barloom.plans.registry import query

BAR = "ts:t open:d high:d low:d close:d volume:i open_interest:i n:i"


@query("agg_ohlc_hourly", f"instrument_id {BAR}", "SELECT * FROM hourly")
def _(spark, sf_dir):
    return market.hourly(spark, sf_dir)


@query("agg_ohlc_daily", f"instrument_id contract_id {BAR}", "SELECT * FROM daily")
def _(spark, sf_dir):
    return market.daily(spark, sf_dir)


@query(
    "agg_rebucket_4h",
    f"instrument_id {BAR}",
    """SELECT instrument_id, to_timestamp(floor(epoch(ts) / 14400) * 14400)::TIMESTAMP AS ts, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close,
        sum(volume) AS volume, arg_max(open_interest, ts) AS open_interest, count(*) AS n FROM hourly h GROUP BY instrument_id, floor(epoch(h.ts) / 14400)""",
)
def _(spark, sf_dir):
    return B.rebucket(market.hourly(spark, sf_dir), ["instrument_id"], 240)


@query(
    "agg_session_buckets",
    "instrument_id bucket:t close:d volume:i n:i",
    """SELECT instrument_id, bucket, arg_max(close, ts) AS close, sum(volume) AS volume, count(*) AS n FROM (
        SELECT *, to_timestamp(epoch(opens) + floor((epoch(ts) - epoch(opens)) / 14400) * 14400)::TIMESTAMP AS bucket FROM (
            SELECT *, date_trunc('day', ts) + INTERVAL 9 HOUR AS opens, date_trunc('day', ts) + INTERVAL 19 HOUR AS closes FROM hourly) WHERE ts >= opens AND ts < closes)
        WHERE bucket + INTERVAL 4 HOUR <= closes GROUP BY ALL""",
)
def _(spark, sf_dir):
    day = F.unix_timestamp(F.date_trunc("day", "ts"))
    h = market.hourly(spark, sf_dir).withColumns({"opens": F.timestamp_seconds(day + 9 * 3600), "closes": F.timestamp_seconds(day + 19 * 3600)}).where("ts >= opens AND ts < closes")
    h = h.withColumn("bucket", B.session_bucket(F.col("ts"), F.col("opens"), F.col("closes"), 240)).where("bucket IS NOT NULL")
    return h.groupBy("instrument_id", "bucket").agg(F.max_by("close", "ts").alias("close"), F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("n"))


@query(
    "agg_source_interval",
    "target:i source:i",
    "SELECT target, max(source) AS source FROM (VALUES (15), (60), (240), (7)) t(target), (VALUES (1), (5), (10), (30), (60)) s(source) WHERE target % source = 0 GROUP BY target",
    "",
)
def _(spark, sf_dir):
    """The exact interval if there is one, else the coarsest divisor: the largest divisor is both."""
    t, s = spark.sql("SELECT * FROM VALUES (15), (60), (240), (7) AS t(target)"), spark.sql("SELECT * FROM VALUES (1), (5), (10), (30), (60) AS s(source)")
    return t.join(F.broadcast(s), F.pmod("target", "source") == 0).groupBy("target").agg(F.max("source").alias("source"))  # literal tables


@query("agg_first_last_seen", "contract_id first_ts:t last_ts:t", "SELECT contract_id, min(ts) AS first_ts, max(ts) AS last_ts FROM ticks GROUP BY contract_id")
def _(spark, sf_dir):
    return market.ticks(spark, sf_dir).groupBy("contract_id").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query(
    "agg_session_class",
    "d:D opens:t closes:t session_class",
    "SELECT ts::DATE AS d, min(ts) AS opens, max(ts) AS closes, CASE WHEN count(*) < 30 THEN 'partial' WHEN max(CASE WHEN event_id % 41 = 0 THEN 1 ELSE 0 END) = 1 THEN 'special' ELSE 'regular' END AS session_class FROM ticks GROUP BY 1",
)
def _(spark, sf_dir):
    special = F.max(F.when(F.col("event_id") % 41 == 0, 1).otherwise(0)) == 1
    kind = F.when(F.count(F.lit(1)) < 30, "partial").when(special, "special").otherwise("regular")
    return market.ticks(spark, sf_dir).groupBy(F.to_date("ts").alias("d")).agg(F.min("ts").alias("opens"), F.max("ts").alias("closes"), kind.alias("session_class"))


@query(
    "agg_sessions_per_week",
    "contract_id week:D actual:i expected:i complete",
    "SELECT contract_id, date_trunc('week', ts) AS week, count(DISTINCT ts) AS actual, any_value(e.expected) AS expected, count(DISTINCT ts) = any_value(e.expected) AS complete FROM daily JOIN (SELECT date_trunc('week', ts) AS w, count(DISTINCT ts) AS expected FROM daily GROUP BY 1) e ON date_trunc('week', ts) = e.w GROUP BY 1, 2",
)
def _(spark, sf_dir):
    d = market.daily(spark, sf_dir).withColumn("week", F.date_trunc("week", "ts"))
    expected = d.groupBy("week").agg(F.countDistinct("ts").alias("expected"))
    out = d.groupBy("contract_id", "week").agg(F.countDistinct("ts").alias("actual")).join(expected, "week")
    return out.withColumn("complete", F.col("actual") == F.col("expected"))


@query("agg_duplicate_keys", "l_orderkey:i n:i", "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1", "")
def _(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("dedup_latest", "contract_id d:D event_id:i price:d", "SELECT contract_id, ts::DATE AS d, event_id, price FROM ticks QUALIFY row_number() OVER (PARTITION BY contract_id, ts::DATE ORDER BY ts DESC, event_id DESC) = 1")
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).withColumn("d", F.to_date("ts"))
    last = F.max_by(F.struct("event_id", "price"), F.struct("ts", "event_id"))
    return t.groupBy("contract_id", "d").agg(last.alias("r")).select("contract_id", "d", "r.event_id", "r.price")


@query("dedup_drop_duplicates", "event_type user_id:i", "SELECT DISTINCT event_type, user_id FROM events", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").dropDuplicates(["event_type", "user_id"])


@query(
    "agg_watermark_merged",
    "contract_id watermark:t",
    "SELECT contract_id, greatest(max(ts), any_value(p.prior)) AS watermark FROM ticks LEFT JOIN (SELECT contract_id, max(ts) + INTERVAL 1 HOUR AS prior FROM ticks WHERE event_id % 3 = 0 GROUP BY 1) p USING (contract_id) GROUP BY 1",
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir)
    prior = t.where("event_id % 3 = 0").groupBy("contract_id").agg((F.max("ts") + F.expr("INTERVAL 1 HOUR")).alias("prior"))
    return t.groupBy("contract_id").agg(F.max("ts").alias("w")).join(prior, "contract_id", "left").withColumn("watermark", F.greatest("w", "prior"))


@query("agg_changed_windows", "instrument_id bucket:t n:i", "SELECT instrument_id, to_timestamp(floor(epoch(ts) / 86400) * 86400)::TIMESTAMP AS bucket, count(*) AS n FROM ticks WHERE price > 90 GROUP BY ALL")
def _(spark, sf_dir):
    return market.ticks(spark, sf_dir).where("price > 90").groupBy("instrument_id", B.bucket_start(F.col("ts"), 1440).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "gate_bars",
    "gate n_failed:i status",
    """SELECT gate, n_failed, CASE WHEN n_failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
        SELECT 'unique_bar' AS gate, count(*) AS n_failed FROM (SELECT contract_id, ts FROM daily GROUP BY ALL HAVING count(*) > 1)
        UNION ALL SELECT 'unique_provenance', count(*) FROM (SELECT contract_id, ts::DATE FROM ticks WHERE event_id % 2 = 0 GROUP BY ALL HAVING count(DISTINCT volume) > 1)
        UNION ALL SELECT 'ohlcv', count(*) FILTER (WHERE NOT (high >= greatest(open, close, low) AND low <= least(open, close) AND volume >= 0 AND open_interest >= 0)) FROM daily
        UNION ALL SELECT 'monotonic_ts', count(*) FILTER (WHERE ts < p) FROM (SELECT ts, lag(ts) OVER (PARTITION BY contract_id ORDER BY arrived) AS p FROM (SELECT contract_id, date_trunc('day', ts) AS ts, min(event_id) AS arrived FROM ticks GROUP BY ALL))
        UNION ALL SELECT 'has_interest', count(*) FILTER (WHERE open_interest < 110) FROM daily
        UNION ALL SELECT 'provenance', count(*) FROM daily d WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE t.contract_id = d.contract_id AND date_trunc('day', t.ts) = d.ts AND t.event_id % 2 = 0)
        UNION ALL SELECT 'row_count', abs((SELECT count(*) FROM daily) - (SELECT count(DISTINCT (contract_id, ts::DATE)) FROM ticks)))""",
)
def _(spark, sf_dir):
    """All gates in one pass over bars with what they came from: their first tick by arrival, and sources of their provenance."""
    t = market.ticks(spark, sf_dir)
    source = F.when(F.col("event_id") % 2 == 0, F.col("volume"))
    origin = t.groupBy("contract_id", F.date_trunc("day", "ts").alias("ts")).agg(F.min("event_id").alias("arrived"), F.count_distinct(source).alias("sources"))
    bars = market.daily(spark, sf_dir).withColumn("same", F.count(F.lit(1)).over(Window.partitionBy("contract_id", "ts"))).join(origin, ["contract_id", "ts"], "full")
    bars = bars.withColumn("before", F.lag("ts").over(Window.partitionBy("contract_id").orderBy("arrived")))
    there = F.col("n").isNotNull()
    return quality.all_gates(
        bars,
        {
            "unique_bar": there & (F.col("same") > 1), "unique_provenance": F.col("sources") > 1, "ohlcv": there & ~B.valid_ohlcv(), "monotonic_ts": F.col("ts") < F.col("before"),
            "has_interest": F.col("open_interest") < 110, "provenance": there & (F.coalesce("sources", F.lit(0)) == 0), "row_count": ~there | F.col("arrived").isNull(),
        },
    )


@query(
    "agg_series_qc",
    "contract_id n:i n_thin:i max_gap:d mean_gap:d blocked",
    """SELECT contract_id, n, n_thin, max_gap, mean_gap, CASE WHEN n < 25 THEN 'short' WHEN n_thin > 10 THEN 'thin' WHEN max_gap > 400 THEN 'gappy' END AS blocked FROM (
        SELECT contract_id, count(*) AS n, sum(CASE WHEN n < 3 THEN 1 ELSE 0 END) AS n_thin, max(abs(open - p)) AS max_gap, avg(abs(open - p)) AS mean_gap
        FROM (SELECT *, lag(close) OVER (PARTITION BY contract_id ORDER BY ts) AS p FROM daily) GROUP BY contract_id)""",
)
def _(spark, sf_dir):
    w = Window.partitionBy("contract_id").orderBy("ts")
    d = market.daily(spark, sf_dir).withColumn("gap", F.abs(F.col("open") - F.lag("close").over(w)))
    out = d.groupBy("contract_id").agg(F.count(F.lit(1)).alias("total"), F.sum(F.when(F.col("n") < 3, 1).otherwise(0)).alias("n_thin"), F.max("gap").alias("max_gap"), F.avg("gap").alias("mean_gap")).withColumnRenamed("total", "n")
    return out.withColumn("blocked", F.when(F.col("n") < 25, "short").when(F.col("n_thin") > 10, "thin").when(F.col("max_gap") > 400, "gappy"))


@query("agg_roll_map_conflict", "instrument_id d:D n_contracts:i first_contract", "SELECT instrument_id, ts::DATE AS d, count(DISTINCT contract_id) AS n_contracts, min(contract_id) AS first_contract FROM ticks GROUP BY ALL HAVING count(DISTINCT contract_id) > 2")
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).groupBy("instrument_id", F.to_date("ts").alias("d"))
    return t.agg(F.countDistinct("contract_id").alias("n_contracts"), F.min("contract_id").alias("first_contract")).where("n_contracts > 2")


@query("percentile_linear", "event_type p50:d p95:d", "SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.95) AS p95 FROM events GROUP BY 1", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.percentile("value", 0.5).alias("p50"), F.percentile("value", 0.95).alias("p95"))


@query("percentile_nearest_rank", "event_type p95:d", "SELECT event_type, list_sort(list(value))[ceil(0.95 * count(*))::INT] AS p95 FROM events GROUP BY 1", "")
def _(spark, sf_dir):
    """The value of rank ceil(0.95 n), by ranking instead of gathering values."""
    w = Window.partitionBy("event_type")
    e = table(spark, sf_dir, "events").withColumns({"rn": F.row_number().over(w.orderBy("value")), "n": F.count(F.lit(1)).over(w)})
    return e.where(F.col("rn") == F.ceil(0.95 * F.col("n"))).select("event_type", F.col("value").alias("p95"))


@query("percentile_approximate", "event_type near", "SELECT DISTINCT event_type, true AS near FROM events", "")
def _(spark, sf_dir):
    """percentile_approx(0.95, 10000) lies within a rank error of n/10000 of the exact percentile."""
    e = table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.percentile_approx("value", 0.95, 10000).alias("a"), F.percentile("value", 0.94).alias("lo"), F.percentile("value", 0.96).alias("hi")
    )
    return e.select("event_type", F.col("a").between(F.col("lo"), F.col("hi")).alias("near"))


@query(
    "gate_missing_inputs",
    "n:i no_k:i big:i blocked",
    "SELECT count(*) AS n, count(*) FILTER (WHERE json_extract_string(props, '$.k') IS NULL) AS no_k, count(*) FILTER (WHERE value > 300) AS big, count(*) FILTER (WHERE value > 300) > 0 AS blocked FROM events",
    "",
)
def _(spark, sf_dir):
    missing = F.get_json_object("props", "$.k").isNull()
    out = table(spark, sf_dir, "events").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(missing, 1)).alias("no_k"), F.count(F.when(F.col("value") > 300, 1)).alias("big"))
    return out.withColumn("blocked", F.col("big") > 0)


TRADES = "SELECT instrument_id, order_id, fill_no, ts, price, qty, fee, net_pnl FROM executions"


@query(
    "agg_trade_stats",
    "instrument_id trades:i net_pnl:f fees:f profit_factor:d win_rate:d avg_trade:f total_return:d max_drawdown:d",
    """SELECT t.*, max_drawdown FROM (SELECT instrument_id, count(*) AS trades, sum(net_pnl) AS net_pnl, sum(fee) AS fees,
        sum(CASE WHEN net_pnl > 0 THEN net_pnl ELSE 0 END) / nullif(-sum(CASE WHEN net_pnl < 0 THEN net_pnl ELSE 0 END), 0) AS profit_factor,
        avg(CASE WHEN net_pnl > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END) AS win_rate, avg(net_pnl) AS avg_trade, sum(net_pnl) / 1000000 AS total_return FROM executions GROUP BY 1) t
        JOIN (SELECT instrument_id, max(peak - eq) / 1000000 AS max_drawdown FROM (SELECT *, greatest(0, max(eq) OVER w) AS peak FROM (
            SELECT instrument_id, ts, order_id, fill_no, sum(net_pnl) OVER (PARTITION BY instrument_id ORDER BY ts, order_id, fill_no, price, qty ROWS UNBOUNDED PRECEDING) AS eq, price, qty FROM executions)
            WINDOW w AS (PARTITION BY instrument_id ORDER BY ts, order_id, fill_no, price, qty ROWS UNBOUNDED PRECEDING)) GROUP BY 1) USING (instrument_id)""",
)
def _(spark, sf_dir):
    return ledger.trade_stats(market.executions(spark, sf_dir), ["instrument_id"], ["ts", "order_id", "fill_no", "price", "qty"], 1_000_000)


@query(
    "agg_r_multiples",
    "year:i side n:i total_r:d avg_r:d wins:i",
    "SELECT year(ts) AS year, CASE WHEN qty > 0 THEN 'long' ELSE 'short' END AS side, count(*) AS n, sum(net_pnl / fee1) AS total_r, avg(net_pnl / fee1) AS avg_r, sum(CASE WHEN net_pnl > 0 THEN 1 ELSE 0 END) AS wins FROM (SELECT *, fee + 1 AS fee1 FROM executions) GROUP BY 1, 2",
)
def _(spark, sf_dir):
    r = F.col("net_pnl") / (F.col("fee") + 1)
    e = market.executions(spark, sf_dir).withColumns({"year": F.year("ts"), "side": F.when(F.col("qty") > 0, "long").otherwise("short"), "r": r})
    return e.groupBy("year", "side").agg(F.count(F.lit(1)).alias("n"), F.sum("r").alias("total_r"), F.avg("r").alias("avg_r"), F.sum((F.col("net_pnl") > 0).cast("int")).alias("wins"))


@query(
    "agg_event_folding",
    "user_id:i opened:t activated:t closed:t latency:i status",
    """SELECT user_id, opened, activated, closed, CAST(epoch(date_trunc('second', activated)) - epoch(date_trunc('second', opened)) AS BIGINT) AS latency,
        CASE WHEN closed IS NOT NULL THEN 'closed' WHEN activated IS NOT NULL THEN 'active' WHEN opened IS NOT NULL THEN 'open' ELSE 'none' END AS status FROM (
        SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS opened, min(ts) FILTER (WHERE event_type = 'click') AS activated, max(ts) FILTER (WHERE event_type = 'purchase' AND value > 60) AS closed FROM events GROUP BY 1)""",
    "",
)
def _(spark, sf_dir):
    return ledger.folded_signals(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "signup", F.col("event_type") == "click", (F.col("event_type") == "purchase") & (F.col("value") > 60))


@query(
    "agg_fold_stats",
    "strategy:i mean:f std:f positive:d worst:f min_trades:i trades:i",
    "SELECT strategy, avg(pnl) AS mean, stddev_pop(pnl) AS std, avg(CASE WHEN pnl > 0 THEN 1::DOUBLE ELSE 0::DOUBLE END) AS positive, min(pnl) AS worst, min(n) AS min_trades, sum(n) AS trades FROM (SELECT instrument_id % 4 AS strategy, year(ts) AS fold, sum(net_pnl) AS pnl, count(*) AS n FROM executions GROUP BY 1, 2) GROUP BY 1",
)
def _(spark, sf_dir):
    f = market.executions(spark, sf_dir).groupBy((F.col("instrument_id") % 4).alias("strategy"), F.year("ts").alias("fold")).agg(F.sum("net_pnl").alias("pnl"), F.count(F.lit(1)).alias("n"))
    return f.groupBy("strategy").agg(
        F.avg("pnl").alias("mean"), F.stddev_pop("pnl").alias("std"), F.avg((F.col("pnl") > 0).cast("double")).alias("positive"), F.min("pnl").alias("worst"), F.min("n").alias("min_trades"), F.sum("n").alias("trades")
    )


@query(
    "agg_representative_run",
    "strategy:i instrument_id:i ret:f",
    "SELECT strategy, arg_max(instrument_id, (ret, n, -instrument_id)) AS instrument_id, max(ret) AS ret FROM (SELECT instrument_id % 4 AS strategy, instrument_id, round(sum(net_pnl), 4) AS ret, count(*) AS n FROM executions GROUP BY 1, 2) GROUP BY 1",
)
def _(spark, sf_dir):
    r = market.executions(spark, sf_dir).groupBy((F.col("instrument_id") % 4).alias("strategy"), "instrument_id").agg(F.round(F.sum("net_pnl"), 4).alias("ret"), F.count(F.lit(1)).alias("n"))
    return r.groupBy("strategy").agg(F.max_by("instrument_id", F.struct(F.col("ret"), F.col("n"), (-F.col("instrument_id")).alias("i"))).alias("instrument_id"), F.max("ret").alias("ret"))


@query(
    "agg_policy_failures",
    "instrument_id:i failures",
    """SELECT instrument_id, concat_ws(',', CASE WHEN n < 300 THEN 'few_trades' END, CASE WHEN pnl <= 0 THEN 'loss' END, CASE WHEN fee > 100000 THEN 'fees' END) AS failures
        FROM (SELECT instrument_id, count(*) AS n, sum(net_pnl) AS pnl, sum(fee) AS fee FROM executions GROUP BY 1)""",
)
def _(spark, sf_dir):
    e = market.executions(spark, sf_dir).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("n"), F.sum("net_pnl").alias("pnl"), F.sum("fee").alias("fee"))
    return e.select("instrument_id", quality.reasons(few_trades=F.col("n") < 300, loss=F.col("pnl") <= 0, fees=F.col("fee") > 100000).alias("failures"))


@query("agg_distinct_values", "o_orderstatus o_orderpriority", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query("agg_margin_factor", "asset:i rank:i factor:d", "SELECT p_size % 5 AS asset, p_size AS rank, min(p_retailprice / (p_size + 1.0)) AS factor FROM part GROUP BY 1, 2", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy((F.col("p_size") % 5).alias("asset"), F.col("p_size").alias("rank")).agg(F.min(F.col("p_retailprice") / (F.col("p_size") + 1.0)).alias("factor"))

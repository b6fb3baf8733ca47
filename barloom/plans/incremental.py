"""Incremental, streaming, lineage and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators import bars as B
from barloom.operators import merge, quality
from barloom.plans import market
from barloom.plans.market import table
from barloom.plans.registry import query
from barloom.streaming import pipelines as P


@query(
    "inc_stale_rows",
    "event_id:i",
    "SELECT event_id FROM ticks JOIN (SELECT contract_id, max(ts) AS mark FROM ticks WHERE event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-20' GROUP BY 1) USING (contract_id) WHERE ts > mark - INTERVAL 30 MINUTE",
)
def _(spark, sf_dir):
    """Rows after their key's high watermark, with half an hour of overlap for corrections."""
    t = market.ticks(spark, sf_dir)
    marks = t.where("event_id % 2 = 0 AND ts < TIMESTAMP'2024-01-20'").groupBy("contract_id").agg(F.max("ts").alias("mark"))
    return t.join(marks, "contract_id").where(F.col("ts") > F.col("mark") - F.expr("INTERVAL 30 MINUTES"))


@query(
    "inc_changed_windows",
    "instrument_id ts:t close:d",
    """SELECT h.instrument_id, h.ts, h.close FROM hourly h WHERE EXISTS (SELECT 1 FROM ticks t WHERE t.instrument_id = h.instrument_id AND t.price > 98
        AND h.ts >= date_trunc('hour', t.ts) - INTERVAL 2 HOUR AND h.ts <= date_trunc('hour', t.ts) + INTERVAL 2 HOUR)""",
)
def _(spark, sf_dir):
    """Only bars of windows whose source changed, dilated by two hours, are computed anew."""
    t = market.ticks(spark, sf_dir)
    hour = F.date_trunc("hour", "ts")
    near = F.explode(F.sequence(hour - F.expr("INTERVAL 2 HOURS"), hour + F.expr("INTERVAL 2 HOURS"), F.expr("INTERVAL 1 HOUR")))
    scope = t.where("price > 98").select("instrument_id", near.alias("hour")).distinct()
    changed = t.withColumn("hour", hour).join(scope, ["instrument_id", "hour"], "left_semi")
    return B.ohlc(changed, ["instrument_id"], 60)


@query(
    "inc_reconcile",
    "o_orderkey:i action",
    "SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'delete' WHEN b.o_orderkey IS NULL THEN 'insert' ELSE 'update' END AS action FROM (SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS p FROM orders WHERE o_orderkey % 17 <> 0) a FULL JOIN (SELECT o_orderkey, o_totalprice AS p FROM orders WHERE o_orderkey % 19 <> 0) b USING (o_orderkey) WHERE a.p IS DISTINCT FROM b.p",
    "",
)
def _(spark, sf_dir):
    """Source against target by key and fingerprint: what to insert, update, delete."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("p"))
    new = o.where("o_orderkey % 17 <> 0").withColumn("p", F.col("p") + F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)).withColumn("h", merge.fingerprint("p"))
    old = o.where("o_orderkey % 19 <> 0").withColumn("h2", merge.fingerprint("p")).select(F.col("o_orderkey").alias("k2"), "h2")
    j = new.join(old, F.col("o_orderkey") == F.col("k2"), "full").where(~F.col("h").eqNullSafe(F.col("h2")))
    action = F.when(F.col("o_orderkey").isNull(), "delete").when(F.col("k2").isNull(), "insert").otherwise("update")
    return j.select(F.coalesce("o_orderkey", "k2").alias("o_orderkey"), action.alias("action"))


@query("stream_tumbling", "event_type bucket:t n:i total:d", "SELECT event_type, to_timestamp(floor(epoch(ts) / 900) * 900)::TIMESTAMP AS bucket, count(*) AS n, sum(value) AS total FROM events GROUP BY ALL", "")
def _(spark, sf_dir):
    return P.run_to_end(P.tumbling(P.table_stream(spark, sf_dir, "events"), 15), "complete")


@query("stream_sliding", "event_type bucket:t n:i", "SELECT event_type, bucket - INTERVAL 30 MINUTE * k AS bucket, count(*) AS n FROM (SELECT event_type, to_timestamp(floor(epoch(ts) / 1800) * 1800)::TIMESTAMP AS bucket FROM events), (VALUES (0), (1)) v(k) GROUP BY 1, 2", "")
def _(spark, sf_dir):
    return P.run_to_end(P.sliding(P.table_stream(spark, sf_dir, "events"), 60, 30), "complete")


@query(
    "stream_sessions",
    "event_type opens:t n:i",
    "SELECT event_type, min(ts) AS opens, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY event_type ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY event_type ORDER BY ts) + INTERVAL 10 MINUTE THEN 0 ELSE 1 END AS new FROM events)) GROUP BY event_type, s",
    "",
)
def _(spark, sf_dir):
    return P.run_to_end(P.sessions(P.table_stream(spark, sf_dir, "events"), "10 minutes"), "complete")


@query("stream_unique", "user_id:i event_type n:i", "SELECT user_id, event_type, 1 AS n FROM events GROUP BY user_id, event_type", "")
def _(spark, sf_dir):
    s = P.unique_events(P.table_stream(spark, sf_dir, "events"), ["user_id", "event_type"])
    return P.run_to_end(s, "append").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


COOLDOWN = """WITH RECURSIVE s AS (SELECT user_id, event_id, epoch(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT user_id, event_id, rn, t AS last, true AS ok FROM s WHERE rn = 1 UNION ALL
          SELECT s.user_id, s.event_id, s.rn, CASE WHEN s.t - r.last >= 21600 THEN s.t ELSE r.last END, s.t - r.last >= 21600 FROM r JOIN s ON s.user_id = r.user_id AND s.rn = r.rn + 1)
    SELECT user_id, event_id FROM r WHERE ok"""


@query("stream_cooldown", "user_id:i event_id:i", f"SELECT * FROM ({COOLDOWN})", "")
def _(spark, sf_dir):
    return P.run_to_end(P.admitted(P.table_stream(spark, sf_dir, "events"), "user_id", 21600), "append")


@query("replay_cooldown", "user_id:i event_id:i", f"SELECT * FROM ({COOLDOWN})", "")
def _(spark, sf_dir):
    return P.admitted_batch(table(spark, sf_dir, "events"), "user_id", 21600)


@query(
    "replay_lifecycle",
    "user_id:i event_id:i status",
    """SELECT user_id, event_id, CASE WHEN blackout THEN 'blocked' WHEN next_ts IS NOT NULL AND next_ts < ts + INTERVAL 12 HOUR THEN 'superseded' ELSE 'expired' END AS status FROM (
        SELECT *, hour(ts) BETWEEN 1 AND 2 AS blackout, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events)""",
    "",
)
def _(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    nxt = F.lead("ts").over(w)
    status = F.when(F.hour("ts").between(1, 2), "blocked").when(nxt.isNotNull() & (nxt < F.col("ts") + F.expr("INTERVAL 12 HOURS")), "superseded").otherwise("expired")
    return table(spark, sf_dir, "events").withColumn("status", status)


@query("audit_hash_chain", "n_broken:i", "SELECT count(*) AS n_broken FROM orders WHERE o_orderkey % 23 = 0", "")
def _(spark, sf_dir):
    """Derived rows whose input hash is no source row's hash: those whose source was changed since."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    derived = o.withColumn("input_hash", merge.fingerprint("o_orderkey", "o_totalprice"))
    changed = o.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 23 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    source = changed.withColumn("row_hash", merge.fingerprint("o_orderkey", "o_totalprice"))
    return quality.broken_links(derived, source, "input_hash", "row_hash").agg(F.count(F.lit(1)).alias("n_broken"))


@query("audit_window_flags", "contract_id n_flagged:i", "SELECT contract_id, count(*) FILTER (WHERE i < 20 AND i > 0) AS n_flagged FROM (SELECT contract_id, row_number() OVER (PARTITION BY contract_id ORDER BY ts) - 1 AS i FROM daily) GROUP BY 1")
def _(spark, sf_dir):
    i = F.row_number().over(Window.partitionBy("contract_id").orderBy("ts")) - 1
    d = market.daily(spark, sf_dir).withColumn("i", i)
    return d.groupBy("contract_id").agg(F.count(F.when((F.col("i") > 0) & (F.col("i") < 20), 1)).alias("n_flagged"))


@query(
    "audit_prefix_cuts",
    "contract_id cut:i",
    "SELECT DISTINCT contract_id, cut FROM (SELECT contract_id, i + k AS cut, n FROM (SELECT contract_id, row_number() OVER w AS i, count(*) OVER (PARTITION BY contract_id) AS n, open_interest < lag(open_interest) OVER w - 500 AS roll FROM daily WINDOW w AS (PARTITION BY contract_id ORDER BY ts)), (VALUES (-1), (0), (1), (20)) v(k) WHERE roll UNION ALL SELECT contract_id, count(*) - 1, count(*) FROM daily GROUP BY 1) WHERE cut BETWEEN 1 AND n",
)
def _(spark, sf_dir):
    w = Window.partitionBy("contract_id")
    d = market.daily(spark, sf_dir).withColumns(
        {"i": F.row_number().over(w.orderBy("ts")), "total": F.count(F.lit(1)).over(w), "roll": F.col("open_interest") < F.lag("open_interest").over(w.orderBy("ts")) - 500}
    )
    around = d.where("roll").select("contract_id", "total", F.explode(F.array(*(F.col("i") + k for k in (-1, 0, 1, 20)))).alias("cut"))
    last = d.where("i = total - 1").select("contract_id", "total", F.col("i").alias("cut"))
    return around.unionByName(last).where("cut BETWEEN 1 AND total").select("contract_id", "cut").distinct()


@query(
    "audit_column_coverage",
    "name n:i has_value",
    """SELECT 'prev' AS name, count(p) AS n, count(p) > 0 AS has_value FROM (SELECT lag(close) OVER (PARTITION BY contract_id ORDER BY ts) AS p FROM daily)
        UNION ALL SELECT 'close', count(close), count(close) > 0 FROM daily UNION ALL SELECT 'never', 0, false""",
)
def _(spark, sf_dir):
    d = market.daily(spark, sf_dir).withColumns({"prev": F.lag("close").over(Window.partitionBy("contract_id").orderBy("ts")), "never": F.lit(None).cast("double")})
    return quality.coverage(d, ["prev", "close", "never"])


@query("audit_identity", "n_different:i", "SELECT count(*) FILTER (WHERE abs(a.close - b.close) > 1e-9) AS n_different FROM hourly a JOIN hourly b USING (instrument_id, ts)")
def _(spark, sf_dir):
    """Bars from ticks and the same bars from quarter-hour bars agree."""
    a = market.hourly(spark, sf_dir).select("instrument_id", "ts", "close")
    fine = B.ohlc(market.ticks(spark, sf_dir), ["instrument_id"], 15)
    b = B.rebucket(fine, ["instrument_id"], 60).select("instrument_id", "ts", F.col("close").alias("other"))
    return a.join(b, ["instrument_id", "ts"]).agg(F.count(F.when(F.abs(F.col("close") - F.col("other")) > 1e-9, 1)).alias("n_different"))


@query("audit_scope_counts", "event_type n:i expected", "SELECT event_type, count(*) AS n, event_type IN ('click', 'view', 'purchase') AS expected FROM events GROUP BY 1", "")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return df.withColumn("expected", F.col("event_type").isin("click", "view", "purchase"))

"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom.operators import joins, merge
from barloom.operators.bars import rebucket
from barloom.plans import market
from barloom.plans.market import table
from barloom.plans.registry import query


@query("join_inner", "contract_id ts:t close:d ticks:i", "SELECT d.contract_id, d.ts, d.close, t.ticks FROM daily d JOIN (SELECT contract_id, date_trunc('day', ts) AS ts, count(*) AS ticks FROM ticks GROUP BY ALL HAVING count(*) > 3) t USING (contract_id, ts)")
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).groupBy("contract_id", F.date_trunc("day", "ts").alias("ts")).agg(F.count(F.lit(1)).alias("ticks")).where("ticks > 3")
    return market.daily(spark, sf_dir).join(t, ["contract_id", "ts"])


@query(
    "join_left_null_safe",
    "o_orderkey:i grp label",
    "SELECT o.o_orderkey, o.grp, l.label FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS grp FROM orders) o LEFT JOIN (VALUES ('F', 'filled'), (NULL, 'unknown')) l(grp, label) ON o.grp IS NOT DISTINCT FROM l.grp",
    "",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("grp"))
    labels = spark.createDataFrame([("F", "filled"), (None, "unknown")], "g string, label string")
    return o.join(F.broadcast(labels), F.col("grp").eqNullSafe(F.col("g")), "left")  # a literal table


@query("join_anti_missing", "c_custkey:i", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)", "")
def _(spark, sf_dir):
    return merge.anti(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("join_semi_scope", "o_orderkey:i", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')", "")
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    return table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "join_full_outer",
    "nationkey:i n_customers:i n_suppliers:i",
    "SELECT coalesce(c.k, s.k) AS nationkey, c.n AS n_customers, s.n AS n_suppliers FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 8000 GROUP BY 1) c FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier WHERE s_acctbal > 2000 GROUP BY 1) s ON c.k = s.k",
    "",
)
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_acctbal > 8000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n_customers"))
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 2000").groupBy(F.col("s_nationkey").alias("k2")).agg(F.count(F.lit(1)).alias("n_suppliers"))
    return c.join(s, F.col("k") == F.col("k2"), "full").withColumn("nationkey", F.coalesce("k", "k2"))


@query("join_cross_bounds", "event_id:i share:d", "SELECT event_id, value / hi AS share FROM events, (SELECT max(value) AS hi FROM events)", "")
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.crossJoin(F.broadcast(e.agg(F.max("value").alias("hi")))).withColumn("share", F.col("value") / F.col("hi"))  # one row


@query("join_broadcast_dimension", "s_suppkey:i n_name r_name", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", "")
def _(spark, sf_dir):
    """Catalyst broadcasts what its statistics say is small."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey"))


SESSIONS = """sessions AS (SELECT day, k, day + INTERVAL 1 HOUR * (9 + 6 * k) AS opens, day + INTERVAL 1 HOUR * (13 + 6 * k) AS closes
    FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM ticks), (VALUES (0), (1)) s(k))"""


def sessions(spark, sf_dir):
    days = market.ticks(spark, sf_dir).select(F.date_trunc("day", "ts").alias("day")).distinct()
    return days.select("day", F.explode(F.array(F.lit(0), F.lit(1))).alias("k")).withColumns(
        {"opens": F.timestamp_seconds(F.unix_timestamp("day") + 3600 * (9 + 6 * F.col("k"))), "closes": F.timestamp_seconds(F.unix_timestamp("day") + 3600 * (13 + 6 * F.col("k")))}
    )


@query(
    "join_session_containment",
    "event_id:i k:i",
    "SELECT event_id, k FROM ticks t JOIN sessions s ON date_trunc('day', t.ts) = s.day WHERE epoch(t.ts) >= epoch(opens) - 60 AND t.ts + INTERVAL 15 MINUTE <= closes AND t.ts + INTERVAL 15 MINUTE <> opens",
    market.CTE + ", " + SESSIONS,
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).withColumn("day", F.date_trunc("day", "ts")).withColumn("te", F.col("ts") + F.expr("INTERVAL 15 MINUTES"))
    within = (F.col("ts") >= F.col("opens") - F.expr("INTERVAL 60 SECONDS")) & (F.col("te") <= F.col("closes")) & (F.col("te") != F.col("opens"))
    return joins.contained(t, sessions(spark, sf_dir), ["day"], within)


@query(
    "join_coarse_covers_fine",
    "instrument_id coarse:t n:i volume:i same",
    """SELECT h.instrument_id, c.ts AS coarse, count(*) AS n, sum(h.volume) AS volume, sum(h.volume) = any_value(c.volume) AS same FROM
        (SELECT instrument_id, to_timestamp(floor(epoch(ts) / 14400) * 14400)::TIMESTAMP AS ts, sum(volume) AS volume FROM hourly GROUP BY ALL) c
        JOIN hourly h ON h.instrument_id = c.instrument_id AND h.ts >= c.ts AND h.ts < c.ts + INTERVAL 4 HOUR GROUP BY h.instrument_id, c.ts""",
)
def _(spark, sf_dir):
    h = market.hourly(spark, sf_dir)
    c = rebucket(h, ["instrument_id"], 240).select("instrument_id", F.col("ts").alias("coarse"), F.col("volume").alias("whole"), F.to_date("ts").alias("d"))
    inside = joins.contained(h.withColumn("d", F.to_date("ts")), c, ["instrument_id", "d"], (F.col("ts") >= F.col("coarse")) & (F.col("ts") < F.col("coarse") + F.expr("INTERVAL 4 HOURS")))
    return inside.groupBy("instrument_id", "coarse").agg(F.count(F.lit(1)).alias("n"), F.sum("volume").alias("volume"), (F.sum("volume") == F.first("whole")).alias("same"))


SPECS = "specs AS (SELECT contract_id, ts AS from_ts, CASE day(ts) % 3 WHEN 0 THEN ts + INTERVAL 1 DAY WHEN 1 THEN ts + INTERVAL 7 DAY END AS to_ts, close AS step FROM daily WHERE day(ts) % 2 = 0)"


def specs(spark, sf_dir):
    d = market.daily(spark, sf_dir).where(F.dayofmonth("ts") % 2 == 0)
    to = F.when(F.dayofmonth("ts") % 3 == 0, F.col("ts") + F.expr("INTERVAL 1 DAY")).when(F.dayofmonth("ts") % 3 == 1, F.col("ts") + F.expr("INTERVAL 7 DAYS"))  # they overlap
    return d.select("contract_id", F.col("ts").alias("from_ts"), to.alias("to_ts"), F.col("close").alias("step"))


@query(
    "join_scd_interval",
    "event_id:i step:d",
    "SELECT event_id, arg_max(step, from_ts) AS step FROM ticks t LEFT JOIN specs s ON t.contract_id = s.contract_id AND t.ts >= s.from_ts AND (s.to_ts IS NULL OR t.ts < s.to_ts) GROUP BY event_id",
    market.CTE + ", " + SPECS,
)
def _(spark, sf_dir):
    return joins.valid_at(market.ticks(spark, sf_dir).select("event_id", "contract_id", "ts"), specs(spark, sf_dir), ["contract_id"], "ts", "from_ts", "to_ts", ["step"])


for _name, _op, _exact, _forward in (("join_asof_backward", ">=", True, False), ("join_asof_strict", ">", False, False), ("join_asof_forward", "<=", True, True)):

    def _run(spark, sf_dir, exact=_exact, forward=_forward):
        h = market.hourly(spark, sf_dir).select("instrument_id", F.col("ts").alias("bar_ts"), "close")
        t = market.ticks(spark, sf_dir).select("event_id", "instrument_id", F.date_trunc("hour", "ts").alias("ts"))
        return joins.asof(t, h.where("minute(bar_ts) = 0 AND hour(bar_ts) % 3 = 0"), ["instrument_id"], "ts", "bar_ts", ["close"], exact, forward, bucket=lambda t: F.date_trunc("day", t))

    query(
        _name,
        "event_id:i close:d matched_bar_ts:t",
        f"""SELECT t.event_id, h.close, h.bar_ts AS matched_bar_ts FROM (SELECT event_id, instrument_id, date_trunc('hour', ts) AS ts FROM ticks) t
            ASOF LEFT JOIN (SELECT instrument_id, ts AS bar_ts, close FROM hourly WHERE hour(ts) % 3 = 0) h ON t.instrument_id = h.instrument_id AND t.ts {_op} h.bar_ts""",
    )(_run)


@query(
    "join_asof_date_latest",
    "contract_id d:D price:d",
    "SELECT t.contract_id, t.d, e.price FROM (SELECT DISTINCT contract_id, ts::DATE AS d FROM ticks) t ASOF LEFT JOIN (SELECT contract_id, ts::DATE AS d, max(price) AS price FROM ticks WHERE user_id % 4 = 0 GROUP BY ALL) e ON t.contract_id = e.contract_id AND t.d >= e.d".replace("user_id % 4", "event_id % 4"),
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).withColumn("d", F.to_date("ts"))
    e = t.where("event_id % 4 = 0").groupBy("contract_id", F.col("d").alias("ed")).agg(F.max("price").alias("price"))
    return joins.asof(t.select("contract_id", "d").distinct(), e, ["contract_id"], "d", "ed", ["price"])


@query(
    "join_nearest_rank",
    "s_suppkey:i p_partkey:i",
    """SELECT s_suppkey, p_partkey FROM (SELECT s_suppkey, p_partkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY abs(rank - size_rank), size_rank) AS rn
        FROM (SELECT s_suppkey, s_suppkey % 5 AS grp, CAST(floor(s_acctbal / 100) AS BIGINT) % 50 AS rank FROM supplier) JOIN
             (SELECT min(p_partkey) AS p_partkey, p_partkey % 5 AS grp, p_size AS size_rank FROM part GROUP BY p_partkey % 5, p_size) USING (grp)) WHERE rn = 1""",
    "",
)
def _(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 5).alias("grp"), (F.floor(F.col("s_acctbal") / 100) % 50).alias("rank"))
    p = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 5).alias("grp"), F.col("p_size").alias("size_rank")).agg(F.min("p_partkey").alias("p_partkey"))
    return joins.nearest(s, p, ["grp"], "rank", "size_rank", ["s_suppkey"])


@query(
    "join_dated_rule",
    "o_orderkey:i regime",
    "SELECT o_orderkey, regime FROM orders JOIN (VALUES ('a', DATE '1992-01-01', DATE '1995-06-30'), ('b', DATE '1995-07-01', DATE '1997-12-31'), ('c', DATE '1998-01-01', DATE '2099-01-01')) r(regime, lo, hi) ON o_orderdate::DATE BETWEEN lo AND hi",
    "",
)
def _(spark, sf_dir):
    rules = spark.sql("SELECT * FROM VALUES ('a', DATE'1992-01-01', DATE'1995-06-30'), ('b', DATE'1995-07-01', DATE'1997-12-31'), ('c', DATE'1998-01-01', DATE'2099-01-01') AS r(regime, lo, hi)")
    return table(spark, sf_dir, "orders").join(F.broadcast(rules), F.to_date("o_orderdate").between(F.col("lo"), F.col("hi")))  # a literal table


@query(
    "join_any_key",
    "o_orderkey:i c_custkey:i",
    "SELECT o_orderkey, c_custkey FROM (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderstatus = 'P') JOIN customer ON o_custkey = c_custkey OR o_orderkey = c_custkey",
    "",
)
def _(spark, sf_dir):
    o, c = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer").select("c_custkey")
    o = o.unionAll(table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select("o_orderkey", "o_custkey"))  # repeated rows stay
    return joins.any_key(o, c, [("o_custkey", "c_custkey"), ("o_orderkey", "c_custkey")])


@query(
    "join_or_left",
    "o_orderkey:i c_name",
    "SELECT o_orderkey, coalesce(a.c_name, b.c_name) AS c_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) a ON o_custkey = a.c_custkey LEFT JOIN customer b ON o_orderkey = b.c_custkey",
    "",
)
def _(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    a, b = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("ka"), F.col("c_name").alias("na")), c.select(F.col("c_custkey").alias("kb"), F.col("c_name").alias("nb"))
    out = table(spark, sf_dir, "orders").join(a, F.col("o_custkey") == F.col("ka"), "left").join(b, F.col("o_orderkey") == F.col("kb"), "left")
    return out.withColumn("c_name", F.coalesce("na", "nb"))


@query(
    "join_top1_window",
    "day:t event_type event_id:i",
    "SELECT day, event_type, event_id FROM (SELECT day, event_type, event_id, row_number() OVER (PARTITION BY day ORDER BY value DESC, event_id) AS rn FROM (SELECT date_trunc('day', ts) AS day, * FROM events)) WHERE rn = 1",
    "",
)
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.date_trunc("day", "ts"))
    return e.groupBy("day").agg(F.max_by(F.struct("event_type", "event_id"), F.struct(F.col("value"), (-F.col("event_id")).alias("i"))).alias("r")).select("day", "r.event_type", "r.event_id")


@query("join_scope_dilation", "contract_id d:D", "SELECT DISTINCT contract_id, (ts::DATE + k)::DATE AS d FROM ticks, (VALUES (-1), (1)) v(k) WHERE price > 95")
def _(spark, sf_dir):
    scope = market.ticks(spark, sf_dir).where("price > 95").select("contract_id", F.to_date("ts").alias("d"))
    return scope.select("contract_id", F.date_sub("d", 1).alias("d")).union(scope.select("contract_id", F.date_add("d", 1).alias("d"))).distinct()


@query(
    "join_key_difference",
    "custkey:i status",
    "SELECT coalesce(a.k, b.k) AS custkey, CASE WHEN a.k IS NULL THEN 'unexpected' WHEN b.k IS NULL THEN 'missing' ELSE 'matched' END AS status FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k",
    "",
)
def _(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("custkey"))
    return joins.key_difference(a, table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey")), ["custkey"])


@query("join_one_to_one", "o_orderkey:i n_lines:i", "SELECT o_orderkey, n AS n_lines FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey", "")
def _(spark, sf_dir):
    from barloom.operators.quality import duplicate_keys

    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    if not duplicate_keys(o, ["o_orderkey"]).isEmpty():
        raise ValueError("orders aren't unique")
    return o.join(lines, "o_orderkey")


@query(
    "join_close_lookup",
    "instrument_id d:D old_close:d new_close:d gap:d",
    """SELECT a.instrument_id, a.ts::DATE AS d, a.close AS old_close, b.close AS new_close, b.close - a.close AS gap FROM daily a JOIN daily b
        ON a.instrument_id = b.instrument_id AND a.ts = b.ts AND a.contract_id = a.instrument_id || '-0' AND b.contract_id = b.instrument_id || '-1'""",
)
def _(spark, sf_dir):
    d = market.daily(spark, sf_dir).withColumn("d", F.to_date("ts"))
    old = d.where("contract_id = concat(instrument_id, '-0')").select("instrument_id", "d", F.col("close").alias("old_close"))
    new = d.where("contract_id = concat(instrument_id, '-1')").select("instrument_id", "d", F.col("close").alias("new_close"))
    return old.join(new, ["instrument_id", "d"]).withColumn("gap", F.col("new_close") - F.col("old_close"))


@query(
    "join_orphan_fills",
    "order_id:i fill_no:i reason",
    "SELECT order_id, fill_no, CASE WHEN o.o_orderkey IS NULL THEN 'orphan' WHEN o.o_orderstatus = 'P' THEN 'pending_order' END AS reason FROM executions LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 7 <> 0) o ON order_id = o.o_orderkey WHERE o.o_orderkey IS NULL OR o.o_orderstatus = 'P'",
)
def _(spark, sf_dir):
    o = table(spark, sf_dir, "orders").where("o_orderkey % 7 <> 0").select("o_orderkey", "o_orderstatus")
    j = market.executions(spark, sf_dir).join(o, F.col("order_id") == F.col("o_orderkey"), "left")
    return j.withColumn("reason", F.when(F.col("o_orderkey").isNull(), "orphan").when(F.col("o_orderstatus") == "P", "pending_order")).where("reason IS NOT NULL")


@query(
    "join_covered_spans",
    "contract_id lo:D hi:D n_days:i n_covered:i is_covered",
    """SELECT s.contract_id, s.lo, s.hi, count(*) AS n_days, count(t.d) AS n_covered, count(*) = count(t.d) AS is_covered FROM
        (SELECT contract_id, lo, hi, unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM (SELECT contract_id, min(ts::DATE) AS lo, min(ts::DATE) + 9 AS hi FROM ticks GROUP BY 1)) s
        LEFT JOIN (SELECT DISTINCT contract_id, ts::DATE AS d FROM ticks WHERE event_id % 2 = 0) t USING (contract_id, d) GROUP BY ALL""",
)
def _(spark, sf_dir):
    t = market.ticks(spark, sf_dir).withColumn("d", F.to_date("ts"))
    spans = t.groupBy("contract_id").agg(F.min("d").alias("lo")).withColumn("hi", F.date_add("lo", 9))
    return joins.covered_spans(spans, t.where("event_id % 2 = 0"), ["contract_id"], "lo", "hi", "d")

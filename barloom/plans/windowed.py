"""Window, sort, limit and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom.operators import windows
from barloom.plans import market
from barloom.plans.market import table
from barloom.plans.registry import query


def series():
    return Window.partitionBy("contract_id").orderBy("ts")


def o(frame: str = "") -> str:
    return f"OVER (PARTITION BY contract_id ORDER BY ts {frame})"


SO_FAR = "ROWS UNBOUNDED PRECEDING"


@query(
    "win_ranks",
    "p_partkey:i rn:i dr:i",
    "SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) AS dr FROM part",
    "",
)
def _(spark, sf_dir):
    w = Window.partitionBy("p_brand")
    return table(spark, sf_dir, "part").withColumns({"rn": F.row_number().over(w.orderBy(F.desc("p_retailprice"), "p_partkey")), "dr": F.dense_rank().over(w.orderBy("p_size"))})


@query("win_lag_lead", "contract_id ts:t prev_close:d effective_to:t", f"SELECT *, lag(close) {o()} AS prev_close, lead(ts) {o()} AS effective_to FROM daily")
def _(spark, sf_dir):
    return market.daily(spark, sf_dir).withColumns({"prev_close": F.lag("close").over(series()), "effective_to": F.lead("ts").over(series())})


@query(
    "win_partition_totals",
    "contract_id ts:t share:d n_bars:i first_ts:t last_ts:t",
    "SELECT contract_id, ts, volume / sum(volume) OVER w AS share, count(*) OVER w AS n_bars, min(ts) OVER w AS first_ts, max(ts) OVER w AS last_ts FROM daily WINDOW w AS (PARTITION BY contract_id)",
)
def _(spark, sf_dir):
    w = Window.partitionBy("contract_id")
    return market.daily(spark, sf_dir).withColumns({"share": F.col("volume") / F.sum("volume").over(w), "n_bars": F.count(F.lit(1)).over(w), "first_ts": F.min("ts").over(w), "last_ts": F.max("ts").over(w)})


LEADERS = "SELECT instrument_id, ts, arg_max(contract_id, (volume, contract_id)) AS top FROM daily GROUP BY instrument_id, ts"
OI_ = "OVER (PARTITION BY instrument_id ORDER BY ts ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)"


def leaders(spark, sf_dir):
    return market.daily(spark, sf_dir).groupBy("instrument_id", "ts").agg(F.max_by("contract_id", F.struct("volume", "contract_id")).alias("top"))


def by_instrument():
    return Window.partitionBy("instrument_id").orderBy("ts")


@query(
    "win_confirmation",
    "instrument_id ts:t confirmed",
    f"SELECT instrument_id, ts, CASE WHEN count(*) {OI_} = 2 AND len(list_distinct(list(top) {OI_})) = 1 THEN top END AS confirmed FROM ({LEADERS})",
)
def _(spark, sf_dir):
    """The same leader for two bars."""
    w = windows.rows(by_instrument(), 2)
    same = (F.count(F.lit(1)).over(w) == 2) & (F.size(F.array_distinct(F.collect_list("top").over(w))) == 1)
    return leaders(spark, sf_dir).withColumn("confirmed", F.when(same, F.col("top")))


@query("win_running_max", "contract_id ts:t peak:d monotone:i", f"SELECT contract_id, ts, max(close) {o(SO_FAR)} AS peak, max(open_interest) {o(SO_FAR)} AS monotone FROM daily")
def _(spark, sf_dir):
    w = series().rowsBetween(Window.unboundedPreceding, 0)
    return market.daily(spark, sf_dir).withColumns({"peak": F.max("close").over(w), "monotone": F.max("open_interest").over(w)})


ISLANDS = f"""SELECT *, sum(CASE WHEN p IS NOT NULL AND p <> top THEN 1 ELSE 0 END) OVER (PARTITION BY instrument_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS epoch_id
    FROM (SELECT *, lag(top) OVER (PARTITION BY instrument_id ORDER BY ts) AS p FROM ({LEADERS}))"""


@query(
    "win_islands",
    "instrument_id ts:t epoch_id:i bars_since:i carried:t",
    f"""SELECT instrument_id, ts, epoch_id, row_number() OVER (PARTITION BY instrument_id, epoch_id ORDER BY ts) - 1 AS bars_since,
        last_value(CASE WHEN p <> top THEN ts END IGNORE NULLS) OVER (PARTITION BY instrument_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS carried FROM ({ISLANDS})""",
)
def _(spark, sf_dir):
    w = by_instrument()
    df = leaders(spark, sf_dir).withColumn("p", F.lag("top").over(w))
    changed = F.col("p").isNotNull() & (F.col("p") != F.col("top"))
    df = df.withColumn("epoch_id", windows.islands(changed, w))
    return df.withColumns(
        {"bars_since": F.row_number().over(Window.partitionBy("instrument_id", "epoch_id").orderBy("ts")) - 1, "carried": windows.carried(F.when(changed, F.col("ts")), w)}
    )


@query(
    "win_ladder",
    "instrument_id ts:t ladder:d",
    f"SELECT instrument_id, ts, sum(g) OVER (PARTITION BY instrument_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS ladder FROM (SELECT instrument_id, ts, CASE WHEN p <> top THEN 1.5 ELSE 0 END AS g FROM ({ISLANDS}))",
)
def _(spark, sf_dir):
    w = by_instrument()
    df = leaders(spark, sf_dir).withColumn("p", F.lag("top").over(w)).withColumn("g", F.when(F.col("p") != F.col("top"), 1.5).otherwise(0.0))
    return df.withColumn("ladder", F.sum("g").over(w.rowsBetween(Window.unboundedPreceding, 0)))


@query(
    "win_warmup_slices",
    "contract_id ts:t slice_role",
    "SELECT contract_id, ts, CASE WHEN i >= first_i THEN 'analysis' WHEN i >= first_i - 5 THEN 'warmup' END AS slice_role FROM (SELECT *, min(CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN i END) OVER (PARTITION BY contract_id) AS first_i FROM (SELECT *, row_number() "
    + o()
    + " AS i FROM daily)) WHERE i >= first_i - 5",
)
def _(spark, sf_dir):
    df = market.daily(spark, sf_dir).withColumn("i", F.row_number().over(series()))
    df = df.withColumn("first_i", F.min(F.when(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"), F.col("i"))).over(Window.partitionBy("contract_id")))
    return df.withColumn("slice_role", F.when(F.col("i") >= F.col("first_i"), "analysis").when(F.col("i") >= F.col("first_i") - 5, "warmup")).where("slice_role IS NOT NULL")


R5 = "ROWS BETWEEN 4 PRECEDING AND CURRENT ROW"


@query(
    "win_rolling",
    "contract_id ts:t mean:d dev:d lo:d hi:d cor:d",
    f"SELECT contract_id, ts, CASE WHEN c THEN m END AS mean, CASE WHEN c THEN s END AS dev, CASE WHEN c THEN a END AS lo, CASE WHEN c THEN b END AS hi, CASE WHEN c AND s > 1e-12 AND sv > 1e-12 THEN r END AS cor FROM (SELECT contract_id, ts, count(close) {o(R5)} = 5 AS c, avg(close) {o(R5)} AS m, stddev_pop(close) {o(R5)} AS s, stddev_pop(volume) {o(R5)} AS sv, min(close) {o(R5)} AS a, max(close) {o(R5)} AS b, corr(close, volume) {o(R5)} AS r FROM daily)",
)
def _(spark, sf_dir):
    w, x = series(), F.col("close")
    return market.daily(spark, sf_dir).withColumns(
        {
            "mean": windows.rolling(F.avg, x, w, 5),
            "dev": windows.rolling(F.stddev_pop, x, w, 5),
            "lo": windows.rolling(F.min, x, w, 5),
            "hi": windows.rolling(F.max, x, w, 5),
            "cor": windows.correlation(x, F.col("volume").cast("double"), w, 5),
        }
    )


@query("win_epoch_mask", "instrument_id ts:t crosses", f"SELECT instrument_id, ts, min(epoch_id) {OI_.replace('1 PRECEDING', '3 PRECEDING')} <> max(epoch_id) {OI_.replace('1 PRECEDING', '3 PRECEDING')} AS crosses FROM ({ISLANDS})")
def _(spark, sf_dir):
    w = by_instrument()
    df = leaders(spark, sf_dir).withColumn("p", F.lag("top").over(w)).withColumn("e", windows.islands(F.col("p").isNotNull() & (F.col("p") != F.col("top")), w))
    four = windows.rows(w, 4)
    return df.withColumn("crosses", F.min("e").over(four) != F.max("e").over(four))


@query(
    "session_gap_clusters",
    "contract_id cluster:i opens:t closes:t n:i",
    "SELECT contract_id, cluster, min(ts) AS opens, max(ts) AS closes, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY contract_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS cluster FROM (SELECT *, CASE WHEN floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY contract_id ORDER BY ts))) <= 36000 THEN 0 ELSE 1 END AS new FROM ticks)) GROUP BY ALL",
)
def _(spark, sf_dir):
    return windows.gap_clusters(market.ticks(spark, sf_dir), ["contract_id"], "ts", 36000).groupBy("contract_id", "cluster").agg(F.min("ts").alias("opens"), F.max("ts").alias("closes"), F.count(F.lit(1)).alias("n"))


@query(
    "win_signal_confirm",
    "contract_id ts:t all_up any_recent",
    f"SELECT contract_id, ts, sum(up) {o('ROWS BETWEEN 2 PRECEDING AND CURRENT ROW')} = 3 AS all_up, coalesce(max(up) {o('ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING')}, 0) = 1 AS any_recent FROM (SELECT *, CASE WHEN close > open THEN 1 ELSE 0 END AS up FROM daily)",
)
def _(spark, sf_dir):
    df = market.daily(spark, sf_dir).withColumn("up", (F.col("close") > F.col("open")).cast("int"))
    return df.withColumns({"all_up": F.sum("up").over(windows.rows(series(), 3)) == 3, "any_recent": F.coalesce(F.max("up").over(series().rowsBetween(-3, -1)), F.lit(0)) == 1})


@query(
    "win_edges",
    "contract_id ts:t entry exit",
    f"SELECT contract_id, ts, coalesce(lag(rise) {o()}, false) AS entry, coalesce(lag(fall) {o()}, false) AS exit FROM (SELECT contract_id, ts, s AND NOT coalesce(lag(s) {o()}, false) AS rise, NOT s AND coalesce(lag(s) {o()}, false) AS fall FROM (SELECT *, close > open AS s FROM daily))",
)
def _(spark, sf_dir):
    from barloom.operators.signals import edges

    return edges(market.daily(spark, sf_dir).withColumn("state", F.col("close") > F.col("open")), "state", series(), 1)


@query(
    "win_family_rank",
    "p_partkey:i family_rank:i overall_rank:i",
    "SELECT p_partkey, fr AS family_rank, row_number() OVER (ORDER BY fr, p_retailprice DESC, p_partkey) AS overall_rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS fr FROM part) WHERE fr <= 3",
    "",
)
def _(spark, sf_dir):
    """Ranks within families first; the few that lead are then ranked together."""
    w = Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey")
    lead = table(spark, sf_dir, "part").withColumn("family_rank", F.row_number().over(w)).where("family_rank <= 3")
    return lead.withColumn("overall_rank", F.row_number().over(Window.orderBy("family_rank", F.desc("p_retailprice"), "p_partkey")))


# --- sorts, limits, sets --------------------------------------------------------------------------


@query("sort_global", "o_orderkey:i o_totalprice:d", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey")


@query("topk_global", "o_orderkey:i o_totalprice:d", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("sample_rows", "n:i", "SELECT least(20, count(*)) AS n FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").limit(20).agg(F.count(F.lit(1)).alias("n"))


@query("latest_run", "o_orderkey:i o_orderdate:t", "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(1)


@query("topk_per_group", "c_mktsegment c_custkey:i rn:i", "SELECT c_mktsegment, c_custkey, rn FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) WHERE rn <= 5", "")
def _(spark, sf_dir):
    w = Window.partitionBy("c_mktsegment").orderBy(F.desc("c_acctbal"), "c_custkey")
    return table(spark, sf_dir, "customer").withColumn("rn", F.row_number().over(w)).where("rn <= 5")


@query("set_union_all", "k:i", "SELECT c_custkey AS k FROM customer UNION ALL SELECT o_custkey FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).unionByName(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")))


@query("set_union_distinct", "k:i", "SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).unionByName(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))).distinct()


@query("set_difference", "k:i", "SELECT o_orderkey AS k FROM orders EXCEPT SELECT l_orderkey FROM lineitem", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).subtract(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k")))


@query("set_intersection", "k:i", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")))


@query(
    "set_shard_union",
    "o_orderkey:i n_versions:i conflict",
    "SELECT o_orderkey, count(DISTINCT p) AS n_versions, count(DISTINCT p) > 1 AS conflict FROM (SELECT o_orderkey, o_totalprice AS p FROM orders UNION ALL SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END FROM orders WHERE o_orderkey % 2 = 0) GROUP BY 1",
    "",
)
def _(spark, sf_dir):
    """Shards overlap: equal rows are one, different ones of a key conflict."""
    o_ = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("p"))
    other = o_.where("o_orderkey % 2 = 0").withColumn("p", F.col("p") + F.when(F.col("o_orderkey") % 10 == 0, 1).otherwise(0))
    return o_.unionByName(other).groupBy("o_orderkey").agg(F.countDistinct("p").alias("n_versions")).withColumn("conflict", F.col("n_versions") > 1)

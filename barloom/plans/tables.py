"""Queries of sources, sinks, table changes, projections and filters."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from barloom.functions import scalars
from barloom.operators import bars as B
from barloom.operators import merge
from barloom.plans import market
from barloom.plans.market import table
from barloom.plans.registry import query
from barloom.session import ship_package
from barloom.sources import io

EVENT = "event_id:i ts:t user_id:i event_type value:d"
SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def jsonl(spark, sf_dir) -> str:
    path = io.scratch(spark, "jsonl")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the default writes milliseconds
    table(spark, sf_dir, "events").write.options(timestampFormat=f"{micros}XXX", timestampNTZFormat=micros).json(path)
    return path


@query("src_jsonl_inferred", "event_id:i user_id:i event_type value:d", "SELECT * FROM events", "")
def _(spark, sf_dir):
    return io.read_jsonl(spark, jsonl(spark, sf_dir))


@query("src_jsonl_schema", EVENT, "SELECT * FROM events", "")
def _(spark, sf_dir):
    return io.read_jsonl(spark, jsonl(spark, sf_dir), SCHEMA)


@query("src_rows", "scope_id:i name", "SELECT * FROM (VALUES (1, 'a'), (2, NULL)) v(scope_id, name)", "")
def _(spark, sf_dir):
    return io.from_rows(spark, [(1, "a"), (2, None)], "scope_id int, name string")


@query("src_values", "contract_id step:d margin:d", "SELECT * FROM (VALUES ('click-0', 0.5, NULL), ('it''s', 1.25, 3.0)) v(contract_id, step, margin)", "")
def _(spark, sf_dir):
    return io.from_values(spark, [("click-0", 0.5, None), ("it's", 1.25, 3.0)], ["contract_id", "step", "margin"])


@query("src_scan_pushed", "l_orderkey:i l_quantity:d", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'", "")
def _(spark, sf_dir):
    return io.read_table(spark, f"{sf_dir}/lineitem.parquet", ["l_orderkey", "l_quantity"], [("l_quantity", ">", 45), ("l_returnflag", "=", "R")])


@query("src_dnf_scan", "o_orderkey:i o_orderstatus o_totalprice:d", "SELECT * FROM orders WHERE (o_orderstatus IN ('F', 'O') AND o_totalprice >= 300000) OR (o_orderstatus <> 'F' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') AND o_totalprice < 2000)", "")
def _(spark, sf_dir):
    any_of = [[("o_orderstatus", "in", ["F", "O"]), ("o_totalprice", ">=", 300000)], [("o_orderstatus", "!=", "F"), ("o_orderpriority", "not in", ["1-URGENT", "2-HIGH"]), ("o_totalprice", "<", 2000)]]
    return io.read_table(spark, f"{sf_dir}/orders.parquet", ["o_orderkey", "o_orderstatus", "o_totalprice"], any_of)


@query("src_batch_scan", "event_type n:i total:d", "SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY event_type", "")
def _(spark, sf_dir):
    """Arrow batches, each summed where it is read."""

    def sums(batches):
        for b in batches:
            t = pa.Table.from_batches([b]).group_by("event_type").aggregate([("value", "count"), ("value", "sum")])
            yield from t.rename_columns(["event_type", "n", "total"]).to_batches()

    ship_package(spark)
    parts = table(spark, sf_dir, "events").select("event_type", "value").mapInArrow(sums, "event_type string, n long, total double")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


@query("src_bounded_read", "event_id:i value:d", "SELECT event_id, value FROM events WHERE user_id = 7", "")
def _(spark, sf_dir):
    return io.read_table(spark, f"{sf_dir}/events.parquet", ["event_id", "value"], [("user_id", "=", 7)], require_bound=True)


@query("src_archive_snapshot", "key digest", "SELECT o_orderkey::VARCHAR AS key, sha256(concat_ws('|', o_orderkey::VARCHAR, coalesce(o_orderstatus, chr(0)), coalesce(o_orderpriority, chr(0)))) AS digest FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"), merge.fingerprint("o_orderkey", "o_orderstatus", "o_orderpriority").alias("digest"))


@query(
    "src_calendar_expand",
    "rule d:D opens:i",
    """SELECT rule, d, opens FROM (SELECT rule, opens, days, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM (VALUES
        ('week', DATE '2024-01-01', DATE '2024-01-31', [2,3,4,5,6], 540), ('saturday', DATE '2024-01-10', DATE '2024-02-03', [7], 600)) v(rule, lo, hi, days, opens))
        WHERE list_contains(days, dayofweek(d) + 1)""",
    "",
)
def _(spark, sf_dir):
    rules = spark.sql("""SELECT * FROM VALUES ('week', DATE'2024-01-01', DATE'2024-01-31', array(2,3,4,5,6), 540),
        ('saturday', DATE'2024-01-10', DATE'2024-02-03', array(7), 600) AS v(rule, lo, hi, days, opens)""")
    return rules.withColumn("d", F.explode(F.sequence("lo", "hi"))).where(F.array_contains("days", F.dayofweek("d")))


@query("src_signal_latest", "user_id:i event_id:i event_type", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1", "")
def _(spark, sf_dir):
    return merge.latest(table(spark, sf_dir, "events"), ["user_id"], [F.col("ts"), F.col("event_id")])


@query("sink_overwrite_partitioned", "event_type n:i total:d", "SELECT event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY event_type", "")
def _(spark, sf_dir):
    path = io.scratch(spark, "overwrite")
    io.overwrite(table(spark, sf_dir, "events"), path, ["event_type"], 2)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query("sink_append_merge_schema", "n:i n_extra:i", "SELECT count(*) AS n, count(*) FILTER (WHERE event_id % 2 = 1) AS n_extra FROM events", "")
def _(spark, sf_dir):
    path, e = io.scratch(spark, "append"), table(spark, sf_dir, "events")
    io.append(e.where("event_id % 2 = 0"), path)
    io.append(e.where("event_id % 2 = 1").withColumn("extra", F.lit(1)), path)
    return io.read_merged(spark, path).agg(F.count(F.lit(1)).alias("n"), F.count("extra").alias("n_extra"))


CHANGED = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS o_totalprice FROM orders"
ORDER = "o_orderkey:i o_orderstatus o_totalprice:d"


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")


def updates(spark, sf_dir):
    return orders(spark, sf_dir).where("o_orderkey % 3 = 0").withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})


@query("merge_upsert", ORDER, CHANGED, "")
def _(spark, sf_dir):
    return merge.upsert(orders(spark, sf_dir).where("o_orderkey % 6 <> 0"), updates(spark, sf_dir), ["o_orderkey"])


@query("merge_delete", ORDER, "SELECT * FROM orders WHERE o_orderstatus <> 'F'", "")
def _(spark, sf_dir):
    df = orders(spark, sf_dir)
    return merge.delete(df, df.where("o_orderstatus = 'F'"), ["o_orderkey"])


@query("merge_replace", ORDER, f"SELECT * FROM ({CHANGED}) WHERE o_orderkey % 3 = 0 OR NOT (o_totalprice > 100000)", "")
def _(spark, sf_dir):
    """What isn't changed and costs over 100,000 is stale."""
    return merge.merge_replace(orders(spark, sf_dir), updates(spark, sf_dir), ["o_orderkey"], F.col("o_totalprice") > 100000)


@query("merge_actions", ORDER, f"SELECT * FROM ({CHANGED}) WHERE o_orderkey % 5 <> 0", "")
def _(spark, sf_dir):
    df = orders(spark, sf_dir)
    gone = df.where("o_orderkey % 5 = 0").withColumn("action", F.lit("delete"))
    return merge.apply_actions(df, updates(spark, sf_dir).where("o_orderkey % 5 <> 0").withColumn("action", F.lit("upsert")).unionByName(gone), ["o_orderkey"])


@query("merge_append_new", "o_orderkey:i n:i", "SELECT o_orderkey, 1 AS n FROM orders", "")
def _(spark, sf_dir):
    df = orders(spark, sf_dir)
    return merge.append_new(df.where("o_orderkey % 2 = 0"), df, ["o_orderkey"]).groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("sink_scoped_replace", ORDER, "SELECT o_orderkey, CASE WHEN o_totalprice BETWEEN 1000 AND 100000 THEN 'R' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders", "")
def _(spark, sf_dir):
    df = orders(spark, sf_dir)
    return merge.scoped_replace(df, df.withColumn("o_orderstatus", F.lit("R")), io.dnf([("o_totalprice", ">=", 1000), ("o_totalprice", "<=", 100000)]))


@query("sink_atomic_replace", ORDER, "SELECT * FROM orders WHERE o_orderstatus = 'O'", "")
def _(spark, sf_dir):
    path = io.scratch(spark, "replace")
    io.overwrite(orders(spark, sf_dir), path)
    io.replace_whole(spark.read.parquet(path).where("o_orderstatus = 'O'"), path)
    return spark.read.schema("o_orderkey long, o_orderstatus string, o_totalprice double").parquet(path)


@query("sink_column_counts", "o_orderpriority n:i", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_orderpriority UNION ALL SELECT 'batch', 2", "")
def _(spark, sf_dir):
    """Rows are written, rows of literal batches appended, some deleted by replacing the table; then a column's values are counted."""
    path = io.scratch(spark, "counts")
    io.overwrite(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus"), path)
    io.append(io.from_rows(spark, [("batch", "O"), ("batch", "O"), ("batch", "F")], "o_orderpriority string, o_orderstatus string"), path)
    io.replace_whole(spark.read.parquet(path).where("o_orderstatus <> 'F'"), path)
    return spark.read.schema("o_orderpriority string").parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sink_year_layout",
    "ship_year:i n:i total:d backed_up:i",
    """SELECT year(d) AS ship_year, count(*) AS n, sum(q) AS total, (SELECT count(*) + count(*) FILTER (WHERE l_linenumber = 1) FROM lineitem) AS backed_up
        FROM (SELECT max((l_shipdate, l_quantity))[1] AS d, max((l_shipdate, l_quantity))[2] AS q FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY 1""",
    "",
)
def _(spark, sf_dir):
    """A table with older versions of some rows is laid out by years; the former one is the backup."""
    path = io.scratch(spark, "layout")
    raw = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", F.lit(1).alias("version"))
    io.overwrite(raw.unionByName(raw.where("l_linenumber = 1").withColumns({"version": F.lit(0), "l_quantity": F.lit(-1.0)})), path)
    io.migrate_layout(spark, path, ["l_orderkey", "l_linenumber"], ["version", "l_shipdate", "l_quantity"], {"ship_year": F.year("l_shipdate")}, f"{path}.staged", f"{path}.backup")
    backup = spark.read.parquet(f"{path}.backup").agg(F.count(F.lit(1)).alias("backed_up"))  # one row
    return spark.read.parquet(path).groupBy("ship_year").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("total")).crossJoin(backup)


@query("sink_fingerprint", "same n_rows:i", "SELECT true AS same, count(*) AS n_rows FROM orders", "")
def _(spark, sf_dir):
    a = io.content_fingerprint(orders(spark, sf_dir))
    b = io.content_fingerprint(orders(spark, sf_dir).repartition(5)).select(F.col("n_rows").alias("n"), F.col("hash_sum").alias("h"))
    return a.join(b, (F.col("n_rows") == F.col("n")) & (F.col("hash_sum") == F.col("h")), "left").select(F.col("h").isNotNull().alias("same"), "n_rows")


@query("sink_metric_lines", "line", "SELECT 'events_total{event_type=\"' || event_type || '\",shard=\"' || (user_id % 3) || '\"} ' || count(*) AS line FROM events GROUP BY event_type, user_id % 3", "")
def _(spark, sf_dir):
    df = table(spark, sf_dir, "events").groupBy("event_type", (F.col("user_id") % 3).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    return io.exposition_lines(df, "events_total", "n", ["event_type", "shard"])


@query("sink_json_lines", "line", """SELECT '{"event_type":"' || event_type || '","n":' || count(*) || '}' AS line FROM events GROUP BY event_type""", "")
def _(spark, sf_dir):
    return io.json_lines(table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")))


@query("page_options", "layer column_name value", "SELECT 'events' AS layer, 'event_type' AS column_name, event_type AS value FROM events GROUP BY 3 UNION ALL SELECT 'orders', 'o_orderstatus', o_orderstatus FROM orders GROUP BY 3 UNION ALL SELECT 'orders', 'o_orderpriority', o_orderpriority FROM orders GROUP BY 3", "")
def _(spark, sf_dir):
    """What each layer's page can be filtered by."""
    return io.options({"events": table(spark, sf_dir, "events"), "orders": table(spark, sf_dir, "orders")}, {"events": ["event_type"], "orders": ["o_orderstatus", "o_orderpriority"]})


@query("page_top_n", "event_id:i value:d", "SELECT event_id, value FROM events WHERE event_type <> 'view' ORDER BY event_id DESC LIMIT 50", "")
def _(spark, sf_dir):
    return io.page(table(spark, sf_dir, "events"), "event_id", True, 50, [("event_type", "!=", "view")])


# --- projections and filters ----------------------------------------------------------------------


@query("proj_contract_cast", "event_id:i value:d props missing:d", "SELECT event_id, value, props, NULL::DOUBLE AS missing FROM events", "")
def _(spark, sf_dir):
    from barloom.schemas import cast_to_contract

    return cast_to_contract(table(spark, sf_dir, "events"), {"event_id": "bigint", "value": "double", "props": "json", "missing": "double"})


@query("proj_first_column", "event_id:i amount:d flag", "SELECT event_id, value AS amount, false AS flag FROM events", "")
def _(spark, sf_dir):
    from barloom.schemas import first_of

    df = table(spark, sf_dir, "events")
    return df.select("event_id", first_of(df, ["amount", "value", "price"], "double").alias("amount"), F.coalesce(first_of(df, ["is_test", "test"], "boolean"), F.lit(False)).alias("flag"))


@query("proj_json_fallback", "event_id:i k", "SELECT event_id, coalesce(NULL, json_extract_string(props, '$.missing'), json_extract_string(props, '$.k')) AS k FROM events", "")
def _(spark, sf_dir):
    from barloom.schemas import column_or_json

    df = table(spark, sf_dir, "events")
    return df.select("event_id", column_or_json(df, "k", "props", ["$.missing", "$.k"]).alias("k"))


@query("filter_scope", EVENT, "SELECT * FROM events WHERE event_type IN ('click', 'purchase')", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "purchase"))


@query(
    "filter_refresh_windows",
    "event_id:i",
    """SELECT event_id FROM events WHERE (event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-05') OR (event_type = 'view' AND ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-11')""",
    "",
)
def _(spark, sf_dir):
    windows = spark.sql("SELECT * FROM VALUES ('click', TIMESTAMP'2024-01-03', TIMESTAMP'2024-01-05'), ('view', TIMESTAMP'2024-01-10', TIMESTAMP'2024-01-11') AS w(kind, lo, hi)")
    e = table(spark, sf_dir, "events")
    return e.join(F.broadcast(windows), (F.col("event_type") == F.col("kind")) & F.col("ts").between(F.col("lo"), F.col("hi")), "left_semi").select("event_id")  # a literal table


@query("filter_session_local", "event_id:i minute:i", "SELECT * FROM (SELECT event_id, hour(ts + INTERVAL 3 HOURS) * 60 + minute(ts + INTERVAL 3 HOURS) AS minute FROM events) WHERE minute >= 540 AND minute < 1430", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("minute", scalars.local_minutes(F.col("ts"), "Europe/Moscow")).where("minute >= 540 AND minute < 1430")


@query("filter_valid_ohlcv", "contract_id ts:t ok", "SELECT contract_id, ts, high >= greatest(open, close, low) AND low <= least(open, close) AND volume >= 0 AND open_interest >= 0 AS ok FROM (SELECT * REPLACE (CASE WHEN volume % 5 = 0 THEN high - 5 ELSE high END AS high) FROM daily)")
def _(spark, sf_dir):
    df = market.daily(spark, sf_dir).withColumn("high", F.when(F.col("volume") % 5 == 0, F.col("high") - 5).otherwise(F.col("high")))
    return df.withColumn("ok", B.valid_ohlcv())


@query("filter_bitmask", "event_id:i flags:i", "SELECT * FROM (SELECT event_id, CASE user_id % 5 WHEN 0 THEN 127 WHEN 1 THEN 5 WHEN 2 THEN 5 WHEN 3 THEN 133 ELSE 261 END AS flags FROM events) WHERE flags & 129 = 129 OR flags & 6 = 6", "")
def _(spark, sf_dir):
    values = list(scalars.PROFILES.values())
    flags = F.coalesce(*(F.when(F.col("user_id") % 5 == k, v) for k, v in enumerate(values)))
    df = table(spark, sf_dir, "events").withColumn("flags", flags)
    return df.where(scalars.has_flags(F.col("flags"), 129) | scalars.has_flags(F.col("flags"), 6))


@query(
    "filter_non_session",
    "event_id:i reason",
    """SELECT event_id, reason FROM (SELECT event_id, CASE WHEN dayofweek(d) IN (0, 6) THEN 'weekend' WHEN d BETWEEN lo AND hi AND s.day IS NULL THEN 'no_session' END AS reason
        FROM (SELECT event_id, ts::DATE AS d FROM events) e LEFT JOIN (SELECT DISTINCT ts::DATE AS day FROM events WHERE event_type = 'purchase' AND user_id % 50 = 0) s ON d = day,
        (SELECT min(ts::DATE) AS lo, max(ts::DATE) AS hi FROM events WHERE event_type = 'purchase' AND user_id % 50 = 0)) WHERE reason IS NOT NULL""",
    "",
)
def _(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    days = e.where("event_type = 'purchase' AND user_id % 50 = 0").select(F.col("d").alias("day")).distinct()
    bounds = days.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    reason = F.when(F.dayofweek("d").isin(1, 7), "weekend").when(F.col("d").between(F.col("lo"), F.col("hi")) & F.col("day").isNull(), "no_session")
    return e.join(days, F.col("d") == F.col("day"), "left").crossJoin(F.broadcast(bounds)).withColumn("reason", reason).where("reason IS NOT NULL")  # one row


@query("filter_param_grid", "fast:i slow:i side", "SELECT * FROM (VALUES (5), (10), (20)) a(fast), (VALUES (10), (20), (50)) b(slow), (VALUES ('long'), ('short'), ('flat')) c(side) WHERE fast < slow AND side <> 'flat'", "")
def _(spark, sf_dir):
    from barloom.operators.research import parameter_grid

    return parameter_grid(spark, {"fast": [5, 10, 20], "slow": [10, 20, 50], "side": ["long", "short", "flat"]}, ["fast < slow", "side != 'flat'"])


@query("proj_lag_class", "event_id:i lag_class", "SELECT event_id, CASE WHEN user_id % 900 <= 60 THEN 'low' WHEN user_id % 900 <= 600 THEN 'medium' ELSE 'high' END AS lag_class FROM events", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("lag_class", scalars.lag_class(F.col("user_id") % 900))


@query(
    "fn_maturity_rank",
    "code rank:i",
    "SELECT * FROM (VALUES ('SiH4', 2024*12+3), ('BRZ25', 2025*12+12), ('RTS-6.21', 2021*12+6), ('GDX99', 1999*12+11), ('plain', NULL)) v(code, rank)",
    "",
)
def _(spark, sf_dir):
    df = spark.createDataFrame([("SiH4",), ("BRZ25",), ("RTS-6.21",), ("GDX99",), ("plain",)], "code string")
    return df.withColumn("rank", scalars.maturity_rank(F.col("code")))


@query("fn_math", "p_partkey:i a:d b:d c:d d:d", "SELECT p_partkey, p_retailprice / nullif(p_size - 10, 0) AS a, degrees(atan(p_size / 7.0)) AS b, tanh(p_size / 25.0) AS c, greatest(0, least(1, p_size / 30.0 - 0.3)) AS d FROM part", "")
def _(spark, sf_dir):
    size = F.col("p_size")
    return table(spark, sf_dir, "part").withColumns({"a": scalars.safe_divide(F.col("p_retailprice"), size - 10), "b": F.degrees(F.atan(size / 7.0)), "c": F.tanh(size / 25.0), "d": scalars.clip01(size / 30.0 - 0.3)})


@query("fn_dates", "o_orderkey:i week:D next_month:D days:i", "SELECT o_orderkey, date_trunc('week', o_orderdate) AS week, (o_orderdate::DATE + INTERVAL 1 MONTH) AS next_month, date_diff('day', DATE '1992-01-01', o_orderdate::DATE) AS days FROM orders", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "orders").withColumns({"week": F.date_trunc("week", "o_orderdate"), "next_month": F.add_months(F.to_date("o_orderdate"), 1), "days": F.datediff(F.to_date("o_orderdate"), F.lit("1992-01-01"))})


@query("fn_strings", "p_partkey:i brand_no word padded", "SELECT p_partkey, regexp_extract(p_brand, '([0-9]+)', 1) AS brand_no, split_part(p_name, ' ', 1) AS word, lpad(p_size::VARCHAR, 4, '0') AS padded FROM part", "")
def _(spark, sf_dir):
    return table(spark, sf_dir, "part").withColumns({"brand_no": F.regexp_extract("p_brand", "([0-9]+)", 1), "word": F.split("p_name", " ").getItem(0), "padded": F.format_string("%04d", "p_size")})


@query("fn_map_filter", "event_id:i kept", """SELECT event_id, 'b=' || event_type || ';c=' || user_id AS kept FROM events""", "")
def _(spark, sf_dir):
    """Map entries without blacklisted keys, in key order."""
    m = F.create_map(F.lit("c"), F.col("user_id").cast("string"), F.lit("a"), F.lit("x"), F.lit("b"), F.col("event_type"))
    entries = F.array_sort(F.map_entries(F.map_filter(m, lambda k, v: ~k.isin("a"))))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("kept"))



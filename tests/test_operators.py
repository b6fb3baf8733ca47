"""What the SQL comparison doesn't show: ties, nulls, short histories, and that later rows don't change earlier ones."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barloom import schemas
from barloom.functions import indicators as I
from barloom.functions import recursive
from barloom.operators import bars, joins, ledger, merge, quality, signals, windows
from barloom.sources import io


def at(h, m=0):
    return dt.datetime(2024, 1, 1, h, m)


def series(spark, n):
    rows = [("a", at(0) + dt.timedelta(hours=i), 10 + i % 7, 11.0 + i % 7, 9.0 + i % 5, 10 + (i * 3) % 8 / 2, 100 + i, 50 + i) for i in range(n)]
    return spark.createDataFrame(rows, "k string, ts timestamp, open long, high double, low double, close double, volume long, open_interest long").withColumn("open", F.col("open").cast("double"))


def test_asof_ties_nulls_and_misses(spark):
    left = spark.createDataFrame([(1, "a", at(1)), (2, "a", at(2)), (3, None, at(3)), (4, "b", at(4))], "i int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(1), 1, "x"), ("a", at(1), 2, "y"), ("a", at(2), None, "x"), (None, at(0), 7, "x")], "k string, s timestamp, v int, o string")
    got = {r["i"]: r["v"] for r in joins.asof(left, right, ["k"], "t", "s", ["v"], tie="o").collect()}
    assert got == {1: 2, 2: None, 3: 7, 4: None}
    strict = {r["i"]: r["v"] for r in joins.asof(left, right, ["k"], "t", "s", ["v"], exact=False, tie="o").collect()}
    assert strict == {1: None, 2: 2, 3: 7, 4: None}
    ahead = {r["i"]: r["matched_s"] for r in joins.asof(left, right, ["k"], "t", "s", ["v"], forward=True).collect()}
    assert ahead == {1: at(1), 2: at(2), 3: None, 4: None}


def test_valid_at_is_half_open(spark):
    left = spark.createDataFrame([(1, "a", at(2)), (2, "a", at(3)), (3, "a", at(4))], "i int, k string, t timestamp")
    right = spark.createDataFrame([("a", at(1), at(3), 1.0), ("a", at(4), None, 2.0)], "k string, f timestamp, u timestamp, v double")
    assert {r["i"]: r["v"] for r in joins.valid_at(left, right, ["k"], "t", "f", "u", ["v"]).collect()} == {1: 1.0, 2: None, 3: 2.0}


def test_merges_treat_nulls_as_equal(spark):
    old = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    new = spark.createDataFrame([(None, 9), (3, 9)], "k int, v int")
    assert sorted((r["k"] or 0, r["v"]) for r in merge.upsert(old, new, ["k"]).collect()) == [(0, 9), (1, 1), (2, 1), (3, 9)]
    assert sorted((r["k"] or 0) for r in merge.delete(old, new, ["k"]).collect()) == [1, 2]
    assert merge.upsert(old.where("false"), new, ["k"]).count() == 2
    actions = new.withColumn("action", F.when(F.col("k").isNull(), "delete").otherwise("upsert"))
    assert sorted((r["k"], r["v"]) for r in merge.apply_actions(old, actions, ["k"]).collect()) == [(1, 1), (2, 1), (3, 9)]


@pytest.mark.parametrize("make", [lambda w: I.sma(w, 5), lambda w: I.wma(w, 4, F.col("close")), lambda w: I.williams_r(w, 6), lambda w: I.cci(w, 5), lambda w: I.bollinger(w, 5)["bb_upper"]])
def test_windows_do_not_look_ahead(spark, make):
    w = Window.partitionBy("k").orderBy("ts")
    short = [r["x"] for r in series(spark, 30).withColumn("x", make(w)).orderBy("ts").collect()]
    longer = [r["x"] for r in series(spark, 31).withColumn("x", make(w)).orderBy("ts").collect()]
    assert short == longer[:30] and short[0] is None


def test_recursive_filters_do_not_look_ahead_and_shuffle_does_not_matter(spark):
    def fn(f):
        return f.assign(e=recursive.ema(f["close"].to_numpy(), 5), a=I.atr(f), s=I.supertrend(f)[0])

    out = {"e": "double", "a": "double", "s": "double"}
    run = lambda df: [tuple(r[c] for c in out) for r in recursive.over_series(df, ["k"], "ts", fn, out).orderBy("ts").collect()]
    assert run(series(spark, 40)) == run(series(spark, 41).repartition(7))[:40]


def test_blocks_with_a_halo_equal_whole_series(spark, monkeypatch):
    monkeypatch.setattr(recursive, "BLOCK", 500)
    monkeypatch.setattr(recursive, "HALO", 400)
    fn = lambda f: f.assign(e=recursive.ema(f["close"].to_numpy(), 10))
    a = recursive.over_series(series(spark, 1700), ["k"], "ts", fn, {"e": "double"}).orderBy("ts").toPandas()
    b = recursive.over_series(series(spark, 1700), ["k"], "ts", fn, {"e": "double"}, forgets=False).orderBy("ts").toPandas()
    assert len(a) == 1700 and np.allclose(a["e"], b["e"], rtol=1e-12)


def test_ema_against_its_definition():
    x = np.array([np.nan, 3.0, 5.0, 4.0])
    y = recursive.ema(x, 3)
    assert np.isnan(y[0]) and y[1:].tolist() == [3.0, 4.0, 4.0]


def test_smoothing_takes_the_steps_of_the_sql():
    for a, fn in ((2 / 21, lambda x: recursive.ema(x, 20)), (2 / 101, lambda x: recursive.ema(x, 100)), (1 / 14, lambda x: recursive.wilder(x, 14))):
        for x in ([1.26] * 50, [3.35] * 50, [11.9, np.nan, 122.79, 2.11, np.nan], [np.nan, 1.7, 0.3], [np.nan], []):
            y, want = None, []
            for v in x:
                y = y if v != v else a * v + (1 - a) * (v if y is None else y)
                want.append(np.nan if y is None else y)
            assert np.array_equal(fn(np.array(x, float)), want, equal_nan=True)


def test_value_area_ties_go_left():
    assert I.value_area([1, 2, 3], [5.0, 5.0, 1.0], 0.5) == (1, 1, 2)
    assert I.value_area([1, 2, 3], [1.0, 5.0, 1.0], 0.8) == (2, 1, 2)
    assert I.value_area([4], [2.0]) == (4, 4, 4)


def test_masked_hold_carries_computed_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1.0, True), ("a", 2, None, True), ("a", 3, 5.0, False), ("a", 4, 7.0, True)], "k string, t int, x double, ok boolean")
    got = windows.masked(df, ["k"], "t", F.col("ok"), lambda d: d.withColumn("y", F.col("x")), "y", "hold").orderBy("t").collect()
    assert [r["y"] for r in got] == [1.0, None, None, 7.0]
    nulls = windows.masked(df, ["k"], "t", F.col("ok"), lambda d: d.withColumn("y", F.col("x")), "y", "null").orderBy("t").collect()
    assert [r["y"] for r in nulls] == [1.0, None, None, 7.0]


def test_session_bucket_drops_partial_buckets(spark):
    df = spark.createDataFrame([(at(9, 5),), (at(10, 30),), (at(11, 10),)], "ts timestamp")
    made = df.select(bars.session_bucket(F.col("ts"), F.lit(at(9)), F.lit(at(11, 30)), 60).alias("b")).collect()
    assert [r["b"] for r in made] == [at(9), at(10), None]


def test_empty_tables(spark):
    empty = series(spark, 1).where("false")
    assert bars.base_metrics(empty, ["k"]).count() == 0
    assert bars.rebucket(empty, ["k"], 60).count() == 0
    assert quality.gate(empty, "g", F.lit(True)).first()["status"] == "PASS"
    assert ledger.folded_positions(spark.createDataFrame([], "k string, t int, qty double, price double"), ["k"], ["t"]).count() == 0


def test_positions_average_keep_and_flip(spark):
    fills = spark.createDataFrame([("a", 1, 2.0, 10.0), ("a", 2, 2.0, 20.0), ("a", 3, -1.0, 99.0), ("a", 4, -5.0, 30.0), ("a", 5, 2.0, 1.0)], "k string, t int, qty double, price double")
    got = [(r["position"], r["average_price"]) for r in ledger.folded_positions(fills, ["k"], ["t"]).orderBy("t").collect()]
    assert got == [(2.0, 10.0), (4.0, 15.0), (3.0, 15.0), (-2.0, 30.0), (0.0, 0.0)]


def test_positions_of_many_accounts_and_missing_values(spark, monkeypatch):
    monkeypatch.setattr("pyspark.sql.GroupedData.applyInPandas", None)  # a frame for each account takes milliseconds each
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # accounts run over batches
    try:
        many = spark.range(4000).selectExpr("id % 400 AS k", "id AS t", "1.0D AS qty", "CAST(id DIV 400 AS DOUBLE) AS price")
        got = ledger.folded_positions(many, ["k"], ["t"]).where("position <> t DIV 400 + 1 OR abs(average_price - (t DIV 400) / 2) > 1e-9 OR average_price IS NULL")
        assert got.count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    odd = [(None, 1, 2.0, 10.0), (None, 2, 2.0, 20.0), ("a", None, 3.0, 5.0), ("a", 1, 1.0, 1.0), ("b", 1, None, 7.0), ("b", 2, 1.0, 8.0)]
    made = ledger.folded_positions(spark.createDataFrame(odd, "k string, t int, qty double, price double"), ["k"], ["t"])
    got = {(r["k"], r["t"]): (r["position"], r["average_price"]) for r in made.collect()}
    assert got == {(None, 1): (2.0, 10.0), (None, 2): (4.0, 15.0), ("a", 1): (1.0, 1.0), ("a", None): (4.0, 4.0), ("b", 1): (None, 7.0), ("b", 2): (None, 7.0)}


def test_edges_are_delayed(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate([False, True, True, False, False])], "k string, t int, state boolean")
    got = signals.edges(df, "state", Window.partitionBy("k").orderBy("t"), 1).orderBy("t").collect()
    assert [r["entry"] for r in got] == [False, False, True, False, False] and [r["exit"] for r in got] == [False, False, False, False, True]


def test_reader_guards(spark):
    path = "/root/testdata/sf0.001/orders.parquet"
    with pytest.raises(ValueError):
        io.read_table(spark, path, require_bound=True)
    assert io.read_table(spark, path, limit=3, require_bound=True).count() == 3
    plan = io.read_table(spark, path, ["o_orderkey"], [("o_totalprice", ">", 5.0)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,5.0)]" in plan


def test_contracts(spark):
    df = spark.createDataFrame([(1, {"a": 1})], "k int, m map<string,int>")
    out = schemas.cast_to_contract(df, {"k": "bigint", "m": "json", "x": "date"}).first()
    assert (out["k"], out["m"], out["x"]) == (1, '{"a":1}', None)
    assert schemas.drift(df, {"k": "int", "z": "int"}) == (["z"], ["m"])
    with pytest.raises(ValueError):
        schemas.assert_contract(df, {"k": "int"})


def test_own_indicator():
    I.register_indicator("double_close", lambda w: {"double_close": 2 * F.col("close")})
    assert "double_close" in I.REGISTRY
    assert isinstance(pd.Series(I.rsi(pd.DataFrame({"close": [1.0, 2.0, 1.5]}), 2)).iloc[-1], float)


def test_valid_at_with_overlaps(spark):
    left = spark.createDataFrame([(i, "a", i) for i in range(14)] + [(99, "b", 3)], "i int, k string, t int")
    right = spark.createDataFrame([("a", 1, 10, 1.0), ("a", 3, 5, 2.0), ("a", 3, 4, 3.0), ("a", 12, None, 4.0), ("a", None, 20, 5.0)], "k string, f int, u int, v double")
    got = {r["i"]: r["v"] for r in joins.valid_at(left, right, ["k"], "t", "f", "u", ["v"]).collect()}
    assert got == {0: None, 1: 1.0, 2: 1.0, 3: 2.0, 4: 2.0, **{i: 1.0 for i in range(5, 10)}, 10: None, 11: None, 12: 4.0, 13: 4.0, 99: None}


def test_any_key_keeps_repeated_rows(spark):
    left = spark.createDataFrame([(1, 2), (1, 2), (None, 5)], "a int, b int")
    right = spark.createDataFrame([(1, 2), (9, 2), (None, 5)], "x int, y int")
    got = sorted(tuple(r) for r in joins.any_key(left, right, [("a", "x"), ("b", "y")]).na.fill(0).collect())
    assert got == [(0, 5, 0, 5), (1, 2, 1, 2), (1, 2, 1, 2), (1, 2, 9, 2), (1, 2, 9, 2)]


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("exact", [False, True])
def test_asof_in_buckets_is_the_same(spark, forward, exact):
    rng = np.random.default_rng(3)
    hours = lambda n: [at(0) + dt.timedelta(hours=int(h)) for h in rng.integers(0, 200, n)]
    left = spark.createDataFrame([(i, [None, "a", "b"][i % 3], t) for i, t in enumerate(hours(300))], "i int, k string, t timestamp")
    right = spark.createDataFrame([([None, "a"][i % 2], t, i, f"{i:03d}") for i, t in enumerate(hours(60))], "k string, s timestamp, v int, o string")
    plain, split = (joins.asof(left, right, ["k"], "t", "s", ["v"], exact, forward, "o", bucket=b).orderBy("i").collect() for b in (None, lambda t: F.date_trunc("day", t)))
    assert plain == split


def test_nearest_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    left, right = [(i, i % 3, int(r)) for i, r in enumerate(rng.integers(0, 60, 80))], [(int(r) % 2, int(r), i) for i, r in enumerate(rng.choice(60, 30, replace=False))]
    want = {}
    for i, k, r in left:
        near = sorted((abs(r - q), q, v) for g, q, v in right if g == k)
        if near:
            want[i] = near[0][2]
    got = joins.nearest(spark.createDataFrame(left, "i int, k int, r int"), spark.createDataFrame(right, "k int, q int, v int"), ["k"], "r", "q", ["i"]).collect()
    assert {r["i"]: r["v"] for r in got} == want


def test_replacing_keeps_the_old_table_when_it_fails(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(3).write.parquet(path)
    io.replace_whole(spark.read.parquet(path).where("id > 0"), path)
    assert spark.read.schema("id long").parquet(path).count() == 2 and [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(Exception, match="boom"):
        io.replace_whole(spark.range(3).select(F.raise_error(F.lit("boom")).alias("x")), path)
    assert spark.read.schema("id long").parquet(path).count() == 2


def test_rows_of_a_series_are_numbered_across_days(spark):
    df = series(spark, 100)
    assert [r["_at"] for r in recursive.numbered(df, ["k"], "ts").orderBy("ts").collect()] == list(range(100))


def test_layout_is_promoted_only_if_it_is_whole(spark, tmp_path):
    path = f"file://{tmp_path}/raw"
    spark.createDataFrame([(1, 0, 5.0), (1, 1, 6.0), (2, 0, 7.0), (None, 0, 8.0)], "k int, v int, x double").write.parquet(path)
    got = io.migrate_layout(spark, path, ["k"], ["v"], {"part": F.col("v")}, f"{path}.staged", f"{path}.backup")
    assert got == {"source_rows": 4, "rows": 3, "dropped": 1}
    assert sorted((r["k"] or 0, r["x"]) for r in spark.read.parquet(path).collect()) == [(0, 8.0), (1, 6.0), (2, 7.0)]
    assert spark.read.parquet(f"{path}.backup").count() == 4
    spark.range(1).write.parquet(f"{path}.again")
    with pytest.raises(OSError):
        io.promote(spark, f"{path}.again", path, f"{path}.backup")  # the backup is there
    assert spark.read.parquet(path).count() == 3


def test_a_roll_without_a_gap_is_an_error(spark):
    from barloom.operators import roll

    front = spark.createDataFrame([("a", at(0), 0), ("a", at(0) + dt.timedelta(days=1), 1)], "instrument_id string, ts timestamp, maturity int")
    bars_ = spark.createDataFrame([("a", "a-0", at(1), 5.0), ("a", "a-1", at(1) + dt.timedelta(days=1), 7.0)], "instrument_id string, contract_id string, ts timestamp, close double")
    bars_ = bars_.withColumns({k: F.col("close") for k in ("open", "high", "low")})
    for gap in (2.0, None):
        events = spark.createDataFrame([("a", at(0) + dt.timedelta(days=1), gap, 1)], "instrument_id string, ts timestamp, gap double, seq int")
        if gap is None:
            with pytest.raises(Exception, match="no gap for the roll"):
                roll.input_frame(front, events, bars_).collect()
            assert roll.input_frame(front, events, bars_, missing="keep").count() == 2
        else:
            assert [(r["roll_epoch"], r["close"]) for r in roll.input_frame(front, events, bars_).orderBy("ts").collect()] == [(0, 5.0), (1, 5.0)]

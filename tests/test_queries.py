import duckdb
import pytest
from compare import connect, same

from barloom.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, SF)
    if name in catalogue.SQL:
        same(df, con, catalogue.SQL[name])
    else:
        assert df.count() > 0


def test_crosses_of_averages_that_are_equal_but_for_rounding(spark, tmp_path):
    prices = "[0.26, 0.7, 0.34, 2.35, 10.9, 1.0]"  # each an instrument whose price never changes
    events = f"SELECT row_number() OVER () AS event_id, TIMESTAMP '2024-01-01' + to_hours(h) AS ts, h AS user_id, 'p' || p AS event_type, {prices}[p]::DOUBLE AS value FROM range(40) a(h), range(1, 7) b(p)"
    con = duckdb.connect()
    con.execute(f"CREATE TABLE events AS {events}")
    con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    df = catalogue.QUERIES["sig_ma_cross"](spark, str(tmp_path))
    same(df, con, catalogue.SQL["sig_ma_cross"])
    assert con.execute(f"SELECT bool_or(long_state OR short_state), count(*) FROM ({catalogue.SQL['sig_ma_cross']})").fetchall() == [(True, 240)]

"""Queries that read or write a whole table do so."""

from barloom.plans import tables
from barloom.sources import io

SF = "/root/testdata/sf0.001"


def test_all_events_go_through_json_lines(spark):
    path = tables.jsonl(spark, SF)
    events = tables.table(spark, SF, "events")
    assert io.read_jsonl(spark, path).count() == events.count()
    back = io.read_jsonl(spark, path, tables.SCHEMA).select(events.columns)
    assert back.exceptAll(events).count() == events.exceptAll(back).count() == 0

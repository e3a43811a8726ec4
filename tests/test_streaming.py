"""Streaming CDC: in-order micro-batches take the append path and equal a batch rebuild."""

from pyspark.sql import functions as F

from medallion.operators import cdc, sets
from medallion.plans.streams import EVENT_COLS, EVENTS, land_events
from medallion.sources.tables import FlowSpec
from medallion.streaming.flows import Pipeline


def test_in_order_batches_append_and_equal_batch(spark, tmp):
    sf = "/root/testdata/sf0.001"
    p = Pipeline(spark, tmp)
    land_events(spark, sf, f"{tmp}/landing", phase=2)  # first half of the month, one file per day
    flow = FlowSpec("A", f"{tmp}/landing/entity=A/*")
    p.run([(EVENTS, [flow])], max_files_per_trigger=4)  # several in-order micro-batches
    hist = p.catalog.table("gold_events_history")
    ops = [r["operation"] for r in hist.history().collect()]
    assert "CDC SCD2 APPEND" in ops, ops
    silver = p.catalog.read("silver_events")
    expected = cdc.scd2(silver, ["user_id"], ["ts", "event_id"], ["event_type"])
    got = hist.read()
    cols = EVENT_COLS + [cdc.START_AT, cdc.END_AT]
    assert sets.compare_tables(got.select(*cols), expected.select(*cols)).collect()[0]["identical"]
    # the later half arrives afterwards (in order again), then the whole month is re-checked
    land_events(spark, sf, f"{tmp}/landing", phase=1)
    p.run([(EVENTS, [flow])], max_files_per_trigger=4)
    silver = p.catalog.read("silver_events")
    expected = cdc.scd2(silver, ["user_id"], ["ts", "event_id"], ["event_type"])
    assert sets.compare_tables(hist.read().select(*cols), expected.select(*cols)).collect()[0]["identical"]
    current = p.catalog.read("gold_events_current").select(*EVENT_COLS)
    assert sets.compare_tables(current, cdc.scd1(silver, ["user_id"], ["ts", "event_id"]).select(*EVENT_COLS)
                               ).collect()[0]["identical"]
    assert hist.read().where(F.col(cdc.END_AT).isNull()).count() == current.count()

"""Envelopes of a micro-batch are numbered by narrow rows, however large it is."""

from callscope.operators.envelopes import pack_envelopes
from callscope.options import BuildOptions
from callscope.plans.build_events import build_events
from callscope.streaming import sinks
from workload import views


def test_a_micro_batch_may_be_large(spark, sf, tmp_path):
    events = build_events(views.messages(spark, sf), BuildOptions(hot_rows=None)).localCheckpoint()
    want = pack_envelopes(events, hot_rows=None)
    for number, hot_rows in enumerate((10**9, 50)):
        sinks.envelope_batch(str(tmp_path), hot_rows=hot_rows)(events, number)
        got = spark.read.parquet(str(tmp_path / f"micro_batch={number}"))
        assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == want.count()

"""Events that are costly to make are made once for their envelopes."""

from pyspark.sql import functions as F

from callscope.operators.envelopes import pack_envelopes
from callscope.options import BuildOptions
from callscope.plans.build_events import build_events
from workload import views


def test_events_are_made_once(spark, sf):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(kind):
        made.add(1)
        return kind

    events = build_events(views.messages(spark, sf), BuildOptions(hot_rows=None)).localCheckpoint()
    plain = pack_envelopes(events)
    once = pack_envelopes(events.withColumn("kind", seen.asNondeterministic()("kind")), once=True)
    assert plain.exceptAll(once).isEmpty() and once.exceptAll(plain).isEmpty()
    assert made.value == events.count()

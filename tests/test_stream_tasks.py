"""Decided rows are dealt out by their number before events are built of them, not by the bytes of their files."""

import pytest
from pyspark.sql import functions as F

from callscope.operators import ordered
from callscope.streaming import sinks
from tests.logs import Log, frame_of
from tests.test_streaming import few_partitions, streamed  # noqa: F401


@pytest.mark.usefixtures("few_partitions")
def test_events_are_built_by_tasks_of_equal_rows(spark, monkeypatch):
    log = Log().initialize("client")
    for n in range(200):
        log.call(f"tool{n}")
    taken = streamed(spark, [frame_of(spark, [log])], sessions=True, delay=0)
    monkeypatch.setattr(ordered, "TASK_ROWS", 40)
    calls = taken.events().filter("kind = 'tool_call'")
    sizes = [r["count"] for r in calls.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 200 and len(sizes) >= 5 and max(sizes) <= 80


@pytest.mark.usefixtures("few_partitions")
def test_streamed_calls_are_dealt_out_by_rows(spark, tmp_path):
    log = Log().initialize("client")
    for n in range(200):
        log.call(f"tool{n}")
    taken, sizes = streamed(spark, [frame_of(spark, [log])], delay=0), []

    def seen(calls, number):
        sizes.append([r["count"] for r in calls.groupBy(F.spark_partition_id()).count().collect()])

    sinks.start(taken.call_stream(), str(tmp_path / "state"), batch=seen).awaitTermination()
    assert sum(map(sum, sizes)) == 200 and max(map(max, sizes)) <= 60

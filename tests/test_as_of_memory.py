"""Whole calls are sorted by tool in slices, so that a task does not hold all calls of a tool."""

import pytest
from pyspark.sql import functions as F

from callscope.operators import assemble, ordered
from callscope.operators.catalog import ownership_history
from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from workload import views


@pytest.mark.parametrize("hot_rows", [ordered.HOT_ROWS])
def test_tasks_hold_slices_of_a_tool(spark, sf, monkeypatch, hot_rows):
    columns = ["server_id", "tool_name", "started_at", "started_seq"]
    calls = pair_calls(views.messages(spark, sf), BuildOptions(hot_rows=None)).calls.select(columns).localCheckpoint()
    history = ownership_history(views.registrations(spark, sf), "seq")
    plain = assemble.join_ownership(calls, history, hot_rows)
    for module in (ordered, assemble):
        monkeypatch.setattr(module, "TASK_ROWS", calls.count() // 40)
    joined = assemble.join_ownership(calls, history, hot_rows)
    held = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    print("tasks", len(held), "most rows", max(held), "of", sum(held))
    assert len(held) > 20 and max(held) * 8 < sum(held)
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()

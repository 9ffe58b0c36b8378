"""Tasks that sort whole rows get more as the table grows, so that each keeps its size."""

import pytest
from pyspark.sql import functions as F

from callscope.operators import ordered
from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from workload import views


@pytest.mark.parametrize("hot_rows", [None, 10**9])
def test_tasks_grow_with_the_log(spark, sf, monkeypatch, hot_rows):
    log = views.messages(spark, sf)
    rows = log.count()
    plain = pair_calls(log, BuildOptions(hot_rows=hot_rows)).calls.select("server_id", "source_seq", "tool_name")
    monkeypatch.setattr(ordered, "TASK_ROWS", rows // 40)
    calls = pair_calls(log, BuildOptions(hot_rows=hot_rows)).calls.select("server_id", "source_seq", "tool_name")
    used = calls.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(used) > 20
    assert calls.exceptAll(plain).isEmpty() and plain.exceptAll(calls).isEmpty()

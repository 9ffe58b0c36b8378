"""Envelopes are numbered by narrow rows; whole events stay out of windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callscope.operators.envelopes import with_envelope


@pytest.mark.parametrize("hot_rows", [10**9, 7])
def test_events_stay_out_of_windows(spark, hot_rows):
    events = spark.range(2000).selectExpr(
        "concat('s', IF(id < 1900, 0, id % 3)) AS server_id", "timestamp_seconds(id div 4 * 10) AS recorded_at", "id div 2 % 900 AS source_seq", "repeat('x', 100) AS payload",
    )
    got = with_envelope(events, 20, hot_rows)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window"):]
    assert "payload" not in below and "payload" in plan
    window = Window.partitionBy("server_id").orderBy("recorded_at", "source_seq")
    want = events.withColumn("batch", F.floor((F.dense_rank().over(window) - 1) / 20).cast("bigint"))
    assert got.select(want.columns).exceptAll(want).isEmpty() and got.count() == 2000

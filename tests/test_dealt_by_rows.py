"""Rows that one task should not hold alone are dealt out by their number, not by their compressed size."""

from pyspark.sql import functions as F

from callscope.operators import ordered
from callscope.operators.assemble import with_candidate
from callscope.options import BuildOptions


def test_rows_that_compress_well_keep_their_tasks(spark, monkeypatch):
    rows = spark.range(4000).selectExpr("id % 500 AS key", "repeat('x', 200) AS payload")
    monkeypatch.setattr(ordered, "TASK_ROWS", 1000)
    counted = ordered.dealt(rows, ["key"], 4000).groupBy("key").agg(F.max("payload")).select(F.spark_partition_id().alias("p"))
    assert counted.distinct().count() == 8


def test_rows_cross_into_python_once_for_their_previews(spark):
    shown = with_candidate(spark.range(3).selectExpr(
        "'s' AS session_id", "'t' AS tool_name", "concat('{\"arguments\":{\"a\":', id, '}}') AS params", "concat('[', id, ']') AS result",
        "CAST(NULL AS STRING) AS error", "CAST(NULL AS STRING) AS error_type", "false AS is_tool_error", "false AS owned",
        "CAST(NULL AS struct<user_intent string, agent_thinking string, user_frustration string>) AS telemetry",
        "timestamp'2024-01-01' AS started_at", "timestamp'2024-01-02' AS finished_at",
    ), BuildOptions()).select("candidate.input", "candidate.output")
    assert shown._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted(map(tuple, shown.collect())) == [(f'{{"a":{n}}}', f"[{n}]") for n in range(3)]

"""Long session keys are dealt out by their size, so that a task's memory does not follow the table."""

from pyspark.sql import functions as F

from callscope.operators import runs
from workload import views


def test_tasks_grow_with_the_size_of_the_keys(spark, monkeypatch):
    table = spark.range(40).select(F.concat(F.lit("run-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("run_id"))
    sessions = table.select(F.lit("s").alias("server_id"), F.concat(F.lit("x" * 500 + "/"), "run_id", F.lit("/" + "x" * 500)).alias("session_key"))
    plain = runs.runs_in_keys(sessions, table)
    assert runs.key_rows(sessions.unionByName(sessions)) == 2 * 40 * 1014 * runs.TASK_ROWS // runs.TASK_BYTES
    monkeypatch.setattr(runs, "TASK_BYTES", 1014)
    places = runs.id_places(sessions.unionByName(sessions), table)
    assert len(places.groupBy(F.spark_partition_id().alias("p")).count().collect()) > 20
    found = runs.runs_in_keys(sessions, table)
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() == 40


def test_the_long_keys_are_made_of_what_is_distinct_already(spark, sf):
    """Only narrow rows are told apart in the tasks that read the table."""
    plan = views.long_key_sessions(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("RepartitionByExpression"):]
    assert "repeat(md5" in plan and "repeat(md5" not in below and "Aggregate" in below

"""A sliced log crosses the network a few times, however many read its pairs."""

from pyspark.sql import functions as F

from callscope.operators.ordered import slice_hot, with_previous, written, written_in_slices
from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from workload import views

SETTING = "spark.sql.requireAllClusterKeysForCoPartition"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_a_sliced_log_are_made_once(spark, sf):
    found = pair_calls(views.messages(spark, sf), BuildOptions(hot_rows=5))
    for df in (found.calls, found.sightings, found.starts):
        assert "Exchange" not in plan(df) and "Window" not in plan(df)
    plain = pair_calls(views.messages(spark, sf), BuildOptions())
    columns = ["server_id", "source_seq", "session_id", "tool_name", "started_at"]
    assert found.calls.select(columns).exceptAll(plain.calls.select(columns)).isEmpty() and found.calls.count() == plain.calls.count()
    assert found.starts.count() == plain.starts.count()


def test_carries_join_on_the_layout_of_the_slices(spark, monkeypatch):
    monkeypatch.setattr("callscope.operators.ordered.TASK_ROWS", 100)
    rows = spark.range(3000).selectExpr("concat('k', id % 3) AS k", "id % 5 AS sub", "id AS ts", "id AS seq", "repeat('x', 50) AS payload")
    log = written(rows, "rows")

    def counted(setting):
        sliced = with_previous(slice_hot(log, ["k"], ["ts", "seq"], 500), ["k", "sub"], ["ts", "seq"], ["payload"])
        spark.conf.set(SETTING, setting)
        try:
            return plan(sliced.df).count("hashpartitioning(k#")
        finally:
            spark.conf.set(SETTING, "true")

    seen = {setting: counted(setting) for setting in ("true", "false")}
    assert seen["false"] < seen["true"]
    out = written_in_slices(with_previous(slice_hot(log, ["k"], ["ts", "seq"], 500, once=True), ["k", "sub"], ["ts", "seq"], ["seq"]).df, "out")
    assert spark.conf.get(SETTING) == "true"
    assert out.filter(F.col("prev_row") & (F.col("prev_seq") != F.col("seq") - 15)).isEmpty() and out.filter(~F.col("prev_row")).count() == 15

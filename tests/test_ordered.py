"""Sliced windows give the same rows as plain windows over the whole key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from callscope.operators.ordered import hot_keys, keep_first, slice_hot, with_previous, with_running


@pytest.fixture(scope="module")
def skewed(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    key = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("user_id").cast("string"))
    return events.select(
        "event_id", "ts", "event_type", key.alias("k"),
        F.when(F.col("event_type") == "error", F.col("value")).alias("v"),
    )


@pytest.mark.parametrize("hot_rows", [None, 10**9, 50, 1])
def test_running_values_do_not_depend_on_slicing(skewed, hot_rows):
    order = ["ts", "event_id"]
    sliced = slice_hot(skewed, ["k"], order, hot_rows)
    assert (sliced.hot is not None) == (hot_rows in (50, 1))
    sliced = with_previous(sliced, ["k", "event_type"], order, ["v", "event_id"])
    got = with_running(
        sliced, ["k"], order,
        last={"latest": F.col("v")}, first={"earliest": F.col("v")},
        sums={"seen": F.col("v").isNotNull().cast("long")},
    ).done()

    plain = Window.partitionBy("k", "event_type").orderBy(*order)
    frame = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select(
        "*",
        F.lag(F.lit(True), 1, False).over(plain).alias("prev_row"),
        F.lag("v").over(plain).alias("prev_v"),
        F.lag("event_id").over(plain).alias("prev_event_id"),
        F.last("v", True).over(frame).alias("latest"),
        F.first("v", True).over(frame).alias("earliest"),
        F.sum(F.col("v").isNotNull().cast("long")).over(frame).alias("seen"),
    )
    got = got.select(want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).isEmpty()


def test_hot_keys_are_bounded_and_split(skewed):
    rows = hot_keys(skewed, ["k"], 100).collect()
    assert [r.k for r in rows] == ["hot"]
    slices = slice_hot(skewed, ["k"], ["ts", "event_id"], 80).df.filter("k = 'hot'")
    sizes = [r["count"] for r in slices.groupBy("__slice").count().collect()]
    assert len(sizes) > 4 and max(sizes) <= 80 and sorted(sizes)[1:] == [80] * (len(sizes) - 1)


def test_bursts_are_split(spark):
    """Nearly all rows within one instant, and many rows of one place."""
    rows = spark.range(5000).selectExpr(
        "'k' AS k", "IF(id < 4900, timestamp '2024-01-01', timestampadd(DAY, CAST(id AS INT), timestamp '2024-01-01')) AS ts", "IF(id < 60, 7, id) AS seq"
    )
    sizes = {r["__slice"]: r["count"] for r in slice_hot(rows, ["k"], ["ts", "seq"], 20).df.groupBy("__slice").count().collect()}
    # 250 slices of 20, past one group of starts, but for the rows of one place.
    assert max(n for s, n in sizes.items() if n != max(sizes.values())) <= 40 and sum(sizes.values()) == 5000 and len(sizes) > 240
    number = slice_hot(rows, ["k"], ["ts", "seq"], 20)
    got = with_running(number, ["k"], ["ts", "seq"], sums={"n": F.lit(1)}).done().agg(F.max("n"), F.count_distinct("n")).first()
    assert got[0] == 5000


def test_keep_first_limits_before_the_shuffle(skewed, capsys):
    first = keep_first(skewed, ["k"], ["ts", "event_id"])
    assert first.count() == skewed.select("k").distinct().count()
    first.explain()
    plan = capsys.readouterr().out
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_rows_of_many_slices_carry_no_starts(spark):
    """With many slices a row joins its own place; it is not compared with the starts of its whole key."""
    rows = spark.range(3000).selectExpr("'k' AS k", "IF(id % 7 = 0, NULL, id) AS ts", "id AS seq")
    sliced = slice_hot(rows, ["k"], ["ts", "seq"], 10)
    assert "starts" not in sliced.df._jdf.queryExecution().optimizedPlan().toString()
    sizes = [r["count"] for r in sliced.df.groupBy("__slice").count().collect()]
    assert sizes == [10] * 300

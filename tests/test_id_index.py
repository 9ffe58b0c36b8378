"""The index of event ids by day."""

import datetime

from pyspark.sql import functions as F

from callscope.operators import id_index

DAYS = "id DIV 4000"


def days_of(spark, start, end):
    return spark.range(start, end).selectExpr("concat('e', id) AS event_id", f"date_add(DATE'2025-01-01', CAST({DAYS} AS INT)) AS day")


def test_late_redeliveries_meet_only_their_parts(spark, tmp_path):
    path = str(tmp_path / "index")
    batch = spark.createDataFrame(
        [("e5", 2), ("e5", 1), ("e39999", 1), ("new", 2), ("new", 1), ("e40001", 1), (None, 1)], "event_id string, at int")
    # No index yet: everything is new.
    assert {(r.event_id, r.at) for r in id_index.dedup_late(batch, path, ["at"]).collect()} == {("e5", 1), ("e39999", 1), ("new", 1), ("e40001", 1), (None, 1)}
    id_index.append_ids(days_of(spark, 0, 20000), path)
    id_index.append_ids(days_of(spark, 20000, 40000).unionByName(spark.createDataFrame([(None, None), ("x", None)], "event_id string, day date")), path)
    id_index.append_ids(days_of(spark, 0, 100), path)  # a job that started again, with smaller filters
    id_index.append_ids(days_of(spark, 0, 0), path)
    got = {(r.event_id, r.at) for r in id_index.dedup_late(batch, path, ["at"]).collect()}
    assert got == {("new", 1), ("e40001", 1), (None, 1)}
    known = {r.id: r.day for r in id_index.known_ids(batch.select(F.col("event_id").alias("id")), path).collect()}
    assert known == {"e5": datetime.date(2025, 1, 1), "e39999": datetime.date(2025, 1, 10)}


def test_filters_miss_nothing_and_point_to_few_days(spark, tmp_path):
    path = str(tmp_path / "index")
    id_index.append_ids(days_of(spark, 0, 40000), path)
    asked = spark.range(0, 80000).selectExpr("concat('e', id) AS id", "id < 40000 AS held", f"date_add(DATE'2025-01-01', CAST({DAYS} AS INT)) AS own")
    found = id_index.candidate_days(asked, path).join(asked, "id")
    assert found.filter("held AND day = own").count() == 40000
    # 80,000 ids asked of ten days: about one wrong pair in 1,000.
    assert found.filter("NOT held OR day <> own").count() < 0.005 * 80000 * 10
    assert id_index.known_ids(asked.limit(0), path).count() == 0

"""The log stream against the batch job, on logs cut at every place."""

import pytest
from pyspark.sql import functions as F

from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from callscope.plans.build_events import build_events
from callscope.session import scratch_dir
from callscope.schemas import MESSAGE_SCHEMA
from callscope.sources.readers import read_messages
from callscope.streaming.log import LogTables, end_of_log
from tests.logs import Log, frame_of


def tricky():
    """Reused ids, a replaced request, changes of client while a call is open."""
    log = Log().initialize("one", headers={"Authorization": "seed"})
    log.call("a").call("b")
    log.begin("c").begin("d").end()
    log.end()
    log.begin("open").initialize("two").add("close", None).end()
    log.call("after", identifier="someone")
    log.initialize("three").initialize("four").call("e", identifier="someone")
    log.begin("lost", request_id="9")
    other = Log("other").call("x").initialize("late").call("y")
    return [log, other]


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each partition of a store costs a fixed time a micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def streamed(spark, batches, ends=True, sessions=False, **given):
    """Tables of a log that comes in these batches, one a trigger."""
    taken = LogTables(spark, scratch_dir(spark, "test-stream"), **given)
    path = scratch_dir(spark, "test-messages")
    whole = batches[0]
    for batch in batches:
        batch.select(MESSAGE_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(path)
        whole = whole.unionByName(batch)
    if ends:
        end_of_log(spark, whole, taken.options, taken.delay).coalesce(1).write.mode("append").parquet(path)
    query = taken.start(read_messages(spark, path, streaming=True, files_per_trigger=1))
    query.awaitTermination()
    taken.progress = query.recentProgress
    if sessions:
        taken.start_sessions().awaitTermination()
    return taken


def in_batches(spark, frame, parts, **given):
    cuts = F.floor((F.unix_micros("ts") - frame.agg(F.min(F.unix_micros("ts"))).first()[0]) / 1_000_000 / parts)
    last = frame.agg(F.max(cuts)).first()[0]
    return streamed(spark, [frame.filter(cuts == number) for number in range(last + 1)], **given)


def rows(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.mark.parametrize("adapter", ["hooks", "middleware"])
def test_stream_gives_the_events_of_the_batch(spark, adapter):
    frame, options = frame_of(spark, tricky()), BuildOptions(adapter=adapter)
    taken = in_batches(spark, frame, 8, options=options, delay=2, sessions=True)
    columns = ["kind", "event_id", "actor_id", "session_id_hint", "started_at", "finished_at", "metadata", "ok", "error"]
    assert rows(taken.events(), *columns) == rows(build_events(frame, options), *columns)
    assert taken.late().isEmpty()


def test_pairing_takes_each_request_once(spark):
    taken = in_batches(spark, frame_of(spark, tricky()[:1]), 4, delay=0)
    names = [r.tool_name for r in taken.calls().orderBy("source_seq").collect()]
    assert names == ["a", "b", "d", "open", "after", "e"]


def test_unanswered_requests_end_after_their_time(spark):
    options = BuildOptions(abandon_after=5, as_of="2024-05-02")
    frame = frame_of(spark, [Log().begin("lost", request_id="9").call("a").call("b").call("c").call("d")])
    taken = in_batches(spark, frame, 3, options=options, delay=0)
    columns = ["tool_name", "source_seq", "started_at", "finished_at", "error"]
    assert rows(taken.calls(), *columns) == rows(pair_calls(frame, options).calls, *columns)


def test_late_rows_are_kept_apart(spark):
    frame = frame_of(spark, [Log().call("a").call("b").call("c")])
    none = frame.filter("seq = 1").withColumn("ts", F.lit(None).cast("timestamp")).withColumn("seq", F.lit(99).cast("long"))
    taken = streamed(spark, [frame.filter("seq NOT IN (1)"), frame.filter("seq = 1").unionByName(none)], delay=1)
    assert sorted(r.seq for r in taken.late().collect()) == [1, 99]
    assert rows(taken.calls(), "tool_name") == ["Row(tool_name='b')", "Row(tool_name='c')"]


def test_empty_log(spark):
    taken = streamed(spark, [frame_of(spark, [Log()])], sessions=True)
    assert taken.events().isEmpty() and taken.calls().isEmpty()


def test_an_abandoned_request_is_reported_once(spark):
    """The timer ends it; the answer that still comes pairs with nothing."""
    log = Log().begin("slow", request_id="9").call("a").call("b").call("c").call("d").end(request_id="9").call("e").call("f")
    options = BuildOptions(abandon_after=3, as_of="2024-05-02")
    taken = in_batches(spark, frame_of(spark, [log]), 1, options=options, delay=0)
    calls = [(r.tool_name, r.error) for r in taken.calls().collect()]
    assert calls.count(("slow", "context canceled")) == 1 and [c[0] for c in calls].count("slow") == 1
    assert sorted(c[0] for c in calls) == ["a", "b", "c", "d", "e", "f", "slow"]


def test_a_query_resumes_where_it_stopped(spark):
    """Requests and clients of a first run are known to a second one."""
    frame = frame_of(spark, tricky())
    middle = frame.agg(F.expr("percentile(unix_micros(ts), 0.5)")).first()[0]
    first, second = frame.filter(F.unix_micros("ts") <= middle), frame.filter(F.unix_micros("ts") > middle)
    taken, path = LogTables(spark, scratch_dir(spark, "test-stream"), delay=0), scratch_dir(spark, "test-messages")
    for part in (first, second, end_of_log(spark, frame, taken.options, 0)):
        part.select(MESSAGE_SCHEMA.fieldNames()).coalesce(1).write.mode("append").parquet(path)
        taken.start(read_messages(spark, path, streaming=True, files_per_trigger=1)).awaitTermination()
        taken.start_sessions().awaitTermination()
    columns = ["kind", "event_id", "started_at", "finished_at", "metadata"]
    assert rows(taken.events(), *columns) == rows(build_events(frame, taken.options), *columns)


def test_state_follows_what_is_open(spark):
    """Connections come and go; the state keeps none of those that were forgotten."""
    frame = frame_of(spark, [Log(f"s{i}").initialize("client").call("a").call("b") for i in range(12)])
    shifted = F.expr("timestampadd(SECOND, 40 * CAST(substr(server_id, 2) AS INT), ts)")
    taken = in_batches(spark, frame.withColumn("ts", shifted), 40, delay=0, forget_after=60)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in taken.progress if p["numInputRows"]]
    # A connection has two rows at most: what waits or is remembered, and its timer.
    assert len(held) == 13 and max(held) <= 12 and held[-1] <= held[4] + 2
    assert taken.calls().count() == 24


@pytest.mark.parametrize("adapter", ["hooks", "middleware"])
def test_lone_requests_pair_by_their_uid(spark, adapter):
    none = {"connection_id": None, "transport_session_id": None}
    log = Log().begin("a", request_uid="u1", **none).begin("b", request_uid="u2", **none)
    log.end(request_uid="u1", **none).end(request_uid="u2", **none)
    calls = pair_calls(log.frame(spark), BuildOptions(adapter=adapter)).calls
    want = ["a", "b"] if adapter == "middleware" else ["b"]
    assert sorted(r.tool_name for r in calls.collect()) == want

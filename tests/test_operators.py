"""Ids, sessions, envelopes, delivery, runs, catalog and sinks on small tables."""

import json
import os
import re

from pyspark.sql import functions as F

from callscope.functions import clients, ids
from callscope.operators import catalog, delivery, envelopes, quality, runs, sessions, usage
from callscope.options import BuildOptions
from callscope.plans.build_events import build_events
from callscope.plans.jobs import ingest, resolve_sessions
from callscope.schemas import CATALOG_SCHEMA, EVENT_FIELDS
from callscope.sources import readers, sinks
from tests.logs import Log


def test_slugs(column):
    given = ["  My App!! 2 ", "--a--", "é\u00a0", "a_/-b", "x" * 60, "a b" * 20, "", "1.0"]
    want = ["My-App-2", "a", "fb", "a--b", "x" * 48, ("a-b" * 20)[:48], "fb", "1.0"]
    assert column(ids.slug("v", "fb"), given) == want


def test_session_ids_round_trip(column):
    seed = "6F9619FF-8B86-4011-B42D-00C04FC964FF"
    built = column(ids.session_id(F.lit("my app"), F.lit("1"), F.col("v"), F.lit("minted")), [seed, "bad"])
    assert built == [f"mcp_my-app_v_1_{seed.lower()}", "mcp_my-app_v_1_minted"]
    parsed = column(ids.client_from_session_id("v"), [built[0], built[1], f"mcp_unknown_v__{seed.lower()}", built[0] + "\n"])
    assert parsed[0].name == "my-app" and parsed[1:] == [None, None, None]


def test_minted_ids_are_stable_version_4(column):
    once, twice = (column(ids.mint_uuid("v"), ["a", "b"]) for _ in range(2))
    assert once == twice and len(set(once)) == 2
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}", u) for u in once)


def test_time_stamps_and_durations(column):
    given = ["2024-01-01 00:00:00", "2024-01-01 00:00:10.100", "2024-01-01 00:00:00.000001"]
    assert column(ids.rfc3339(F.col("v").cast("timestamp")), given) == [
        "2024-01-01T00:00:00Z", "2024-01-01T00:00:10.1Z", "2024-01-01T00:00:00.000001Z",
    ]
    start = F.lit("2024-01-01 00:00:00.0015").cast("timestamp")
    assert column(ids.duration_ms(start, F.col("v").cast("timestamp")), given) == [-1, 10098, -1]


def test_stateless_requests(spark):
    init = {"method": "initialize", "params": {"clientInfo": {"name": "cli", "version": 3}}}
    seed = "1c52e0aa-93d7-4b18-9f60-2be7715c04d9"
    rows = [
        ("a", json.dumps(init), {"X-Session-Seed": seed}), ("b", json.dumps([{"method": "x"}, init]), {}),
        ("c", "{}", {"MCP-session-id": f" mcp_cli_v_3_{seed} "}), ("d", "[]", None), ("e", json.dumps({"method": ["initialize"]}), {}),
        ("f", json.dumps({"method": "initialize"}), {}),
    ]
    df = spark.createDataFrame(rows, "request_uid string, body string, headers map<string,string>")
    got = {r.request_uid: r for r in resolve_sessions(df).collect()}
    assert got["a"].session_id == f"mcp_cli_v__{seed}" and got["a"].is_initialize and got["a"].client is None
    assert got["b"].is_initialize and got["b"].session_id.startswith("mcp_cli_v__")
    assert not got["c"].is_initialize and got["c"].client.name == "cli"
    assert len(got["d"].session_id) == 36 and not got["e"].is_initialize
    assert got["f"].session_id.startswith("mcp_unknown_v__")


def test_client_families(column):
    given = ["Claude-Code 1", "claudecode", "my CODEX", "Proxy ", "", None, "vim"]
    assert column(clients.client_family("v", {"proxy": "claude_code"}), given) == [
        "claude_code", "claude_code", "codex", "claude_code", "unexpected:unknown", "unexpected:unknown", "unexpected:vim",
    ]


def _events(spark, tmp_path):
    log = Log().initialize("cli").call("t", {"password": "x", "n": "a\"b"}, identifier="me")
    for i in range(25):
        log.call(f"t{i}", request_id=str(i), error="bad" if i % 5 == 0 else None)
    path = str(tmp_path / "events")
    sinks.write_events(build_events(log.frame(spark), BuildOptions(hot_rows=None)), path)
    assert "day=2024-05-01" in os.listdir(path)
    return spark.read.parquet(path).drop("day")


def test_envelopes_sinks_and_ingest(spark, tmp_path):
    events = _events(spark, tmp_path)
    out = str(tmp_path / "envelopes")
    sinks.write_envelopes(events, out)
    bodies = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(len(b["events"]) for b in bodies) == [7, 22]  # 20 candidates, one of them with three events
    assert {b["schema_version"] for b in bodies} == {1}
    by_kind = {e["kind"]: e for b in bodies for e in b["events"]}
    assert set(by_kind["session_init"]["metadata"]) == {"client_name", "client_version", "protocol_version", "capabilities"}
    assert set(by_kind["actor_identity"]["metadata"]) == {"identifier"}
    call = by_kind["tool_call"]
    assert "capabilities" not in call["metadata"] and call["metadata"]["user_intent"] is None
    assert "is_workflow" not in call and call["calls"] == []

    back = readers.read_envelopes(spark, out)
    twice = back.unionByName(back.withColumn("position", F.col("position") + 100))
    clean = ingest(twice, ["position"])
    assert clean.count() == events.count() == 29
    plain = [c for c in EVENT_FIELDS if c not in ("calls", "logs", "search_calls")]
    assert quality.table_difference(clean.select(plain), events.select(plain)).isEmpty()
    report = envelopes.ingest_report(twice, "document", ["position"]).agg(
        F.sum("accepted"), F.sum("rejected"), F.sum("duplicate_count")).first()
    assert tuple(report) == (58, 0, 29)


def test_emit_returns_what_failed(spark, tmp_path):
    events = _events(spark, tmp_path)

    def emit(body):
        if "t24" in body:
            raise ConnectionError("down")

    failed = sinks.emit_to(events, emit).collect()
    assert [(r.batch, r.error) for r in failed] == [(1, "ConnectionError: down")]


def test_trace_paths_hold_whole_sessions(spark, tmp_path):
    calls = sessions.calls_of(_events(spark, tmp_path))
    pieces = sessions.session_paths(sessions.session_trace(calls, hot_rows=4), piece=10).collect()
    pieces.sort(key=lambda r: (r.session_key, r.piece))
    tools = [t for r in pieces for t in r.path.split(" → ")]
    assert tools == ["t", *[f"t{i}" for i in range(25)]]
    roll = sessions.session_rollup(calls).collect()
    assert sum(r.event_count for r in roll) == 26 and sum(r.error_count for r in roll) == 5


def test_response_codes(spark):
    bodies = [
        '{"error":{"code":"quota_1"}}', '{"errorCode":"a:b-c"}', '{"errorCode":"-bad"}', "", None,
        '{"error":"text","errorCode":"ok"}', '{"errorCode":7}', '{"errorCode":"' + "x" * 101 + '"}', '{"errorCode":"x\\n"}',
    ]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, body string").withColumn("status", F.lit(500))
    got = [r.c for r in df.select("i", clients.response_code("body", "status").alias("c")).orderBy("i").collect()]
    assert got == ["quota_1", "a:b-c", *["ingest_http_500"] * 7]


def test_verdicts_and_attempts(spark):
    rows = [
        ("a", 1, 503, None, "", 2), ("a", 2, 200, None, '{"accepted":0}', 2), ("b", 1, 200, None, '{"accepted":0}', 0),
        ("c", 1, 200, None, "{}", 2), ("d", 1, 200, None, '{"accepted":1,"rejected":[{"reason":"b"},{"reason":"a"}]}', 2),
        ("e", 2, None, "timeout", None, 2), ("f", 1, None, "cancelled", None, 2), ("g", 2, 429, None, "", 2),
        ("h", 1, 404, None, "", 2), ("i", 1, 204, None, None, 2),
    ]
    df = spark.createDataFrame(rows, "batch_id string, attempt int, status int, failure string, body string, event_count int")
    got = {r.batch_id: r for r in delivery.classify_deliveries(df).collect()}
    assert [got[k].verdict for k in "abcdefghi"] == [
        "rejected", "accepted", "accepted", "rejected", "failed", "failed", "failed", "failed", "accepted",
    ]
    assert got["a"].attempts == 2 and got["a"].message == "ingest rejected 0 event(s)"
    assert got["d"].message == "ingest rejected 2 event(s) (a, b)"
    assert [got[k].retryable for k in "efgh"] == [True, False, True, False]


def test_run_ids_inside_keys_need_no_pairs_of_all(spark):
    keys = spark.createDataFrame([("s", "xx-run1234-run9999"), ("s", "run123"), ("s", "")], "server_id string, session_key string")
    table = spark.createDataFrame([("run1234",), ("run9999",), ("zz9",)], "run_id string")
    found = runs.runs_in_keys(keys, table)
    assert sorted((r.session_key, r.run_id) for r in found.collect()) == [
        ("xx-run1234-run9999", "run1234"), ("xx-run1234-run9999", "run9999"),
    ]
    assert "CartesianProduct" not in found._jdf.queryExecution().executedPlan().toString()


def test_catalog_ownership(spark):
    own = '{"properties":{"telemetry":{"type":"string"}}}'
    rows = [("s", 1, "a", own), ("s", 2, "a", "{}"), ("s", 1, "b", "{}"), ("s", 2, "b", own), ("s", 3, "b", "broken"), ("s", 1, "c", "[1]")]
    df = spark.createDataFrame(rows, "server_id string, at int, tool_name string, input_schema string").selectExpr(
        "server_id", "timestamp_seconds(at) AS registered_at", "tool_name", "'x' AS description", "input_schema"
    ).select(CATALOG_SCHEMA.fieldNames())
    assert [r.tool_name for r in catalog.owned_tools(df).collect()] == ["b"]
    hints = spark.createDataFrame([(h + " more",) for h in catalog.HINTS] + [("none",)], "description string")
    assert [r.h for r in hints.select(catalog.has_hint().alias("h")).collect()] == [True] * 4 + [False]


def test_settling_needs_quiet_and_enough_sessions(spark):
    rows = []
    for step, counts in enumerate([[1] * 4, [1] * 3 + [2], [1] * 3 + [2], [1] * 3 + [2], [1] * 3 + [2], [1] * 3 + [2]]):
        rows += [("w", step * 10, f"s{i}", n, 0) for i, n in enumerate(counts)]
        rows += [("few", step * 10, "only", 1, 0)]
    polls = spark.createDataFrame(rows, "watch_id string, t long, session_id string, event_count long, error_count long")
    got = runs.settled_at(polls.withColumn("polled_at", F.timestamp_seconds("t")).drop("t")).collect()
    assert [(r.watch_id, r.stable_since.second, r.settled_at.second) for r in got] == [("w", 10, 40)]


def test_latency_quantiles_are_exact(spark):
    rows = [("t", ms) for ms in range(1, 101)] + [("u", 5)]
    got = {r.tool: r for r in usage.tool_latency(spark.createDataFrame(rows, "tool string, duration_ms long")).collect()}
    assert (got["t"].p50_ms, got["t"].p90_ms, got["t"].p99_ms, got["u"].p50_ms) == (50, 90, 99, 5)


def test_leaks_are_found(spark):
    rows = [("a", "password=[redacted:sensitive-kv]"), ("b", "token=live"), ("c", "x://u:[redacted:connection-string]@h")]
    df = spark.createDataFrame(rows, "event_id string, error string")
    assert [(r.event_id, r.label) for r in quality.leaked_secrets(df, ["error"]).collect()] == [("b", "sensitive-kv")]


def test_watches_settle_in_gaps_of_their_own_calls(spark):
    rows = [("w", s, t) for t, s in [(5, "a"), (12, "b"), (13, "a"), (41, "c"), (95, "a")]] + [("x", "a", 0), ("x", "b", 3)]
    calls = spark.createDataFrame(rows, "watch string, session_key string, t long").withColumn("at", F.timestamp_seconds("t"))
    settled = lambda n: [(r.watch_id, r.stable_since.second, r.settled_at.minute * 60 + r.settled_at.second, r.sessions) for r in runs.settled_windows(calls, "watch", "at", "10 seconds", "30 seconds", n).orderBy("watch_id").collect()]
    assert settled(3) == [("w", 50, 80, 3)]
    assert settled(2) == [("w", 50, 80, 3), ("x", 10, 40, 2)]
    assert settled(4) == []


def test_run_ids_are_found_wherever_they_begin(spark):
    ids = ["a", "aa", "ab", "ba.b", "ba.b?", "\U0001f600x", "?x", "", None, "run-000017-long", "z" * 70, "z" * 71]
    texts = ["aaab", "xba.b?", "baxb", "\U0001f600x", "", None, "..run-000017-longer..", "z" * 72, "\n\ud7ff a"]
    table = spark.createDataFrame([(i,) for i in ids], "run_id string")
    keys = spark.createDataFrame([("s", t) for t in texts], "server_id string, session_key string")
    found = {(r.session_key, r.run_id) for r in runs.runs_in_keys(keys, table).collect()}
    assert found == {(t, i) for t in texts for i in ids if t and i and i in t}
    assert runs.runs_in_keys(keys, table.limit(0)).count() == 0


def test_long_keys_give_few_places(spark):
    uuid = "{:08x}-1111-4111-8111-{:012x}".format
    table = spark.range(500).rdd.map(lambda r: (uuid(r.id * 7919, r.id * 104729),)).toDF("run_id string")
    noise = "0123456789abcdef-" * 60
    keys = spark.createDataFrame([("s", noise + uuid(i * 7919, i * 104729 + i % 2) + noise) for i in range(40)], "server_id string, session_key string")
    assert runs.id_places(keys, table).count() == 40
    assert runs.runs_in_keys(keys, table).count() == 20


def test_sketches_merge_to_any_span(spark):
    calls = spark.range(6000).selectExpr(
        "concat('t', id % 2) AS tool", "CASE WHEN id % 1000 < 990 THEN timestamp_seconds(1700000000 + id * 60) END AS started", "id % 5 > 0 AS ok",
        "concat('s', id % 3) AS server_id", "CASE WHEN id % 4 = 0 THEN '' ELSE concat('k', id % 300) END AS session_key",
        "concat('a', id % 50) AS actor_id", "CASE WHEN id % 2 = 0 THEN id DIV 2 END AS duration_ms",
    )
    sketches = usage.usage_sketches(calls)
    got = {r.tool: r for r in usage.merge_usage(sketches, "tool").collect()}
    assert [(got[t].calls, got[t].failed) for t in ("t0", "t1")] == [(3000, 600), (3000, 600)]
    assert abs(got["t0"].sessions - 75) <= 4 and abs(got["t1"].sessions - 150) <= 8 and abs(got["t0"].actors - 25) <= 2
    assert abs(got["t0"].p50_ms - 1500) <= 45 and abs(got["t0"].p99_ms - 2970) <= 45 and got["t1"].p50_ms is None
    assert sketches.filter("span_start IS NULL").agg(F.sum("calls")).first()[0] == 60
    assert usage.merge_usage(usage.usage_sketches(calls.limit(0)), "tool").count() == 0

"""Message logs to events: pairing, sessions, identity, telemetry, previews.

Every scenario is one server of a shared log, so one build per option set serves
all tests.
"""

import hashlib
import json

import pytest
from pyspark.sql import functions as F
from tests.logs import Log, frame_of

from callscope.options import BuildOptions
from callscope.plans.build_events import build_events


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def calls_of(rows):
    return [r for r in rows if r.kind == "tool_call"]


LOGS = {}
OWNED = [("owned", "form")]


def scenario(name):
    LOGS[name] = Log(name)
    return LOGS[name]


scenario("basic").begin(
    "lookup",
    {"q": "a<b", "telemetry": {"intent": "find it", "user_frustration": "none", "frustration_level": "high"}},
    identifier="ann", headers={"authorization": "key"},
).end({"content": [{"type": "text", "text": "ok"}]}, after_ms=150)

log = scenario("outcomes").call(error="boom password=hunter2 x", request_id="1")
log.call(result={"isError": True, "content": []}, request_id="2")
log.begin(request_id="3").add("end", request_id="3", error="raw", error_type="quota_spent")

log = scenario("pairing")
log.begin("a").end().end()  # the second answer has no request
log.begin("b").begin("c").end()  # c replaces b
log.begin("d").add("cancel").end()  # cancelled, the late answer is dropped
log.begin("e")  # never answered

log = scenario("blank")
for conn in ("x", "y"):
    log.begin(conn, transport_session_id="", connection_id=conn)
for conn in ("y", "x"):
    log.end(transport_session_id="", connection_id=conn)

log = scenario("clients").initialize("one").call("a").begin("b").add("close", None).end().call("c")
log.initialize("two").initialize("three").call("d")

scenario("capabilities").initialize(extra={"capabilities": {"roots": {}}})
scenario("large").initialize(extra={"capabilities": {"x": "y" * 5000}})
NO_SESSION = {"transport_session_id": ""}
scenario("blank starts").initialize(**NO_SESSION).initialize(**NO_SESSION).initialize(
    connection_id="c2", **NO_SESSION
)

log = scenario("identity")
for i, who in enumerate(["a", "b", "a"]):
    log.call(identifier=who, request_id=str(i))
log.call(identifier="z" * 9000, request_id="9")

log = scenario("two processes")
for phase, tool, process in (("begin", "a", "p1"), ("begin", "b", "p2"), ("end", None, "p1"), ("end", None, "p2")):
    values = {"transport_session_id": "stdio", "connection_id": "", "process_id": process}
    log.begin(tool, **values) if tool else log.end(**values)

scenario("late start").call().initialize()

scenario("stdio").call(transport_session_id="stdio", request_id="1")
log = scenario("headers").call(headers={"Mcp-Session-Id": " h1 "}, connection_id=None, **NO_SESSION)
log.call(connection_id="k", headers=None, request_id="2", **NO_SESSION)
log.call(connection_id="m", headers={"A": "b"}, request_id="3", **NO_SESSION)

scenario("stateless").call(transport_session_id="mcp_cursor_v_2.1_6f9619ff-8b86-4011-b42d-00c04fc964ff")

BLOCK = {"telemetry": {"user_intent": "mine"}, "purpose": "why"}
scenario("owned").call("form", BLOCK, request_id="1").call("open", BLOCK, request_id="2")

RUN = "6F9619FF-8b86-8011-b42d-00c04fc964ff"
log = scenario("marks").call(headers={"x-workflow-run-id": f" {RUN} "}, request_id="1")
MARKED = {"content": [], "_meta": {"request-capability": True, "k": 1}}
log.call("request_capability", {"capability": "x"}, MARKED, request_id="2")
log.call("request_capability", {"capability": "x"}, request_id="3")
log.begin(request_id="4").end(request_id="4", capability_provenance=True)

scenario("arrays").add("begin", params='{"name":"t","arguments":[1.50,"x"]}').end()

AUTH = {"Authorization": "key"}
log = scenario("seeds").call(headers=AUTH, request_id="1").call(headers=AUTH, actor_seed="given", request_id="2")
log.call(headers=AUTH, identifier="id", actor_seed="given", request_id="3").call(request_id="4")

log = scenario("long")
for i in range(60):
    if i % 20 == 0:
        log.initialize(f"client-{i}")
    if i % 25 == 24:
        log.add("close", None)
    log.begin(f"t{i}", request_id=str(i % 3))
    if i % 4:
        log.end(request_id=str(i % 3))

log = scenario("value hook").call("t", {"a": 1.50, "telemetry": {"user_intent": "x"}}, request_id="1")
log.call("t", {"secret_note": "n"}, error="bad", request_id="2")

log = scenario("event hook")
for i, tool in enumerate(["drop", "fail", "keep"]):
    log.call(tool, {"a": i, "telemetry": {"user_intent": "u"}}, request_id=str(i))


def hide(value):
    if isinstance(value, dict) and "secret_note" in value:
        raise RuntimeError("no")
    if isinstance(value, dict) and "user_intent" in value:
        return value | {"user_intent": "hidden"}
    if isinstance(value, str):
        return {"e": value}
    return {"seen": value}


def hook(call):
    if call["tool_name"] == "drop":
        return None
    if call["tool_name"] == "fail":
        raise ValueError("no")
    if call["tool_name"] != "keep":
        return call
    return call | {"tool_name": "renamed", "session_id": "other", "input": {"k": call["input"]["a"]}}


OPTIONS = {
    "hooks": {"hot_rows": None},
    "middleware": {"hot_rows": None, "adapter": "middleware"},
    "abandon": {"hot_rows": None, "abandon_after": 5, "as_of": "2024-05-01 11:00:00"},
    "mapped": {"hot_rows": None, "telemetry_fields": {"user_intent": "purpose"}},
    "scrubbed": {"hot_rows": None, "telemetry_fields": {"user_intent": "purpose"}, "capture_telemetry": False},
    "seeded": {"hot_rows": None, "actor_seed": "conf"},
    "redactor": {"hot_rows": None, "redactor": hide},
    "hook": {"hot_rows": None, "event_hook": hook},
    "sliced": {"hot_rows": 9},
    "repartitioned": {},
    "disabled": {"disabled": True},
}


@pytest.fixture(scope="module")
def built(spark):
    """Rows in emit order by option set and scenario; each set is built once."""
    done = {}
    owned = spark.createDataFrame(OWNED, "server_id string, tool_name string")

    def get(option, name):
        if option not in done:
            values = dict(OPTIONS[option])
            if "actor_seed" in values:
                values["actor_seed"] = F.lit(values["actor_seed"])
            frame = frame_of(spark, LOGS.values())
            if option == "repartitioned":
                frame = frame.repartition(5, "seq")
            events = build_events(frame, BuildOptions(**values), owned)
            done[option] = sorted(
                events.collect(),
                key=lambda r: (r.server_id, r.recorded_at, r.source_seq, r.emit_pos),
            )
        return [r for r in done[option] if r.server_id == name]

    return get


def test_call_becomes_identity_init_and_call(built):
    identity, init, call = built("hooks", "basic")
    assert [identity.kind, init.kind, call.kind] == ["actor_identity", "session_init", "tool_call"]
    actor = sha("ann")
    assert {identity.actor_id, init.actor_id, call.actor_id} == {actor}
    assert identity.event_id == sha(f"{actor} actor_identity ann")
    assert identity.metadata.identifier == "ann" and identity.session_id_hint is None
    assert init.event_id == sha(f"{actor} session_init {actor}:session_init:s1")
    assert call.ok and call.duration_ms == 150 and call.error is None
    assert call.started_at == "2024-05-01T10:00:00Z"
    assert call.finished_at == "2024-05-01T10:00:00.15Z"
    meta = call.metadata
    assert (meta.user_intent, meta.intent) == ("find it", "find it")
    assert (meta.user_frustration, meta.frustration_level) == ("high", "high")
    assert meta.agent_thinking is None
    assert meta.input_preview == '{"q":"a\\u003cb"}'
    assert call.script_source == "MCP tool call: lookup\n\nInput:\n" + meta.input_preview
    assert call.result_preview == '{"content":[{"text":"ok","type":"text"}]}'
    assert call.calls == [] and not call.is_workflow and call.workflow_run_id is None


def test_outcomes(built):
    assert [(c.ok, c.error) for c in calls_of(built("hooks", "outcomes"))] == [
        (False, "boom password=[redacted:sensitive-kv] x"), (False, "tool_error"), (False, "quota_spent"),
    ]


def test_pairing_takes_each_request_once(built):
    got = [(c.metadata.tool_name, c.ok, c.error) for c in calls_of(built("hooks", "pairing"))]
    assert got == [("a", True, None), ("c", True, None), ("d", False, "context canceled")]
    late = calls_of(built("abandon", "pairing"))
    assert [c.metadata.tool_name for c in late] == ["a", "c", "d", "e"]
    assert late[-1].error == "context canceled" and late[-1].duration_ms == 5000


def test_blank_sessions_pair_by_connection(built):
    rows = built("hooks", "blank")
    assert [r.kind for r in rows] == ["tool_call", "tool_call"]  # no start without a session
    assert [c.metadata.tool_name for c in rows] == ["y", "x"]
    assert len({c.event_id for c in rows}) == 2


def test_client_in_force_when_the_call_began(built):
    rows = built("hooks", "clients")
    clients = {c.metadata.tool_name: c.metadata.client_name for c in calls_of(rows)}
    assert clients == {"a": "one", "b": "one", "c": None, "d": "three"}
    # Same actor and session: one start, whatever happened on the connection.
    assert [r.metadata.client_name for r in rows if r.kind == "session_init"] == ["one"]
    kept = calls_of(built("middleware", "clients"))
    assert [c.metadata.client_name for c in kept] == ["one", "one", None, "two"]


def test_capabilities_only_with_middleware(built):
    assert built("hooks", "capabilities")[0].metadata.capabilities is None
    middleware = built("middleware", "capabilities")[0]
    assert json.loads(middleware.metadata.capabilities) == {"roots": {}}
    assert middleware.metadata.protocol_version == "2025-06-18"
    assert json.loads(built("middleware", "large")[0].metadata.capabilities) == {"x": "y" * 5000}


def test_blank_session_starts_are_always_sent(built):
    assert [r.kind for r in built("hooks", "blank starts")] == ["session_init", "session_init"]


def test_identity_is_sent_once_per_identifier(built):
    rows = built("hooks", "identity")
    assert [r.metadata.identifier for r in rows if r.kind == "actor_identity"] == ["a", "b", "z" * 9000]
    assert calls_of(rows)[-1].actor_id != sha("anonymous")


@pytest.mark.parametrize("adapter", ["hooks", "middleware"])
def test_processes_share_no_request_ids(built, adapter):
    got = calls_of(built(adapter, "two processes"))
    assert sorted((c.metadata.tool_name, c.duration_ms) for c in got) == [("a", 2000), ("b", 2000)]
    if adapter == "hooks":
        assert {c.session_id_hint for c in got} == {"p1", "p2"}


def test_call_before_explicit_start_shares_it(built):
    assert [r.kind for r in built("hooks", "late start")] == ["session_init", "tool_call"]


def test_session_ids_by_adapter(built):
    assert built("hooks", "stdio")[-1].session_id_hint == "proc"
    got = calls_of(built("middleware", "headers"))
    assert [c.session_id_hint for c in got] == ["h1", "proc", None]


def test_stateless_session_id_carries_the_client(built):
    call = calls_of(built("hooks", "stateless"))[0]
    assert (call.metadata.client_name, call.metadata.client_version) == ("cursor", "2.1")


def test_owned_and_scrubbed_telemetry(built):
    form, opened = calls_of(built("hooks", "owned"))
    assert form.metadata.user_intent is None and '"telemetry"' in form.metadata.input_preview
    assert opened.metadata.user_intent == "mine" and "telemetry" not in opened.metadata.input_preview
    assert [c.metadata.user_intent for c in calls_of(built("mapped", "owned"))] == ["why", "mine"]
    form, opened = calls_of(built("scrubbed", "owned"))
    assert form.metadata.user_intent is None and opened.metadata.user_intent is None
    assert "telemetry" not in opened.metadata.input_preview


def test_workflow_and_capability_marks(built):
    got = calls_of(built("hooks", "marks"))
    assert [c.workflow_run_id for c in got] == [RUN, None, None, None]
    assert [c.is_workflow for c in got] == [True, False, False, False]
    assert [c.metadata.capability_request for c in got] == [None, True, None, True]
    assert got[1].result_preview == '{"_meta":{"k":1},"content":[]}'


def test_non_object_arguments(built):
    assert calls_of(built("hooks", "arrays"))[0].metadata.input_preview == "undefined"
    assert calls_of(built("middleware", "arrays"))[0].metadata.input_preview == '[1.50,"x"]'


def test_actor_seed_precedence(built):
    actors = [c.actor_id for c in calls_of(built("hooks", "seeds"))]
    assert actors == [sha("key"), sha("given"), sha("id"), sha("anonymous")]
    configured = [c.actor_id for c in calls_of(built("seeded", "seeds"))]
    assert configured == [sha("conf"), sha("given"), sha("id"), sha("conf")]


@pytest.mark.parametrize("option", ["sliced", "repartitioned"])
def test_events_do_not_depend_on_slicing_or_partitioning(built, option):
    assert len(built("hooks", "long")) == 46
    for name in LOGS:
        assert built(option, name) == built("hooks", name), name


def test_value_hook(built):
    first, second = calls_of(built("redactor", "value hook"))
    assert first.metadata.input_preview == '{"seen":{"a":1.5}}'
    assert first.metadata.user_intent == "hidden" and first.result_preview == '{"seen":{"content":[]}}'
    assert second.metadata.input_preview == '"[redaction failed]"'
    assert second.error == '{"e":"bad"}' and second.result_preview is None


def test_event_hook(built):
    failed, kept = calls_of(built("hook", "event hook"))
    assert failed.ok and failed.error == "[redaction failed]"
    assert failed.metadata.input_preview == failed.result_preview == '"[redaction failed]"'
    assert failed.metadata.user_intent is None
    assert kept.metadata.tool_name == "renamed" and kept.session_id_hint == "other"
    assert kept.metadata.input_preview == '{"k":2}' and kept.metadata.user_intent == "u"
    plain = {c.source_seq: c.event_id for c in calls_of(built("hooks", "event hook"))}
    assert kept.event_id == plain[kept.source_seq]


def test_disabled_emits_nothing(built):
    assert built("disabled", "basic") == []


@pytest.mark.parametrize("bad", [{"adapter": "other"}, {"abandon_after": 5}])
def test_bad_options(bad):
    with pytest.raises(ValueError):
        BuildOptions(**bad)

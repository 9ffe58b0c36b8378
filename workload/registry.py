"""Every registered query, with the SQL that must give the same rows."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.functions import clients, ids, payload, telemetry
from callscope.operators import catalog, delivery, envelopes, id_index, quality, runs, sessions, usage
from callscope.operators.assemble import build_tool_calls, join_ownership
from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from callscope.plans.build_events import build_events
from callscope.plans.jobs import clean_payloads, ingest, resolve_sessions
from callscope.session import scratch_dir, ship_package
from workload import sql as Q
from workload import views as V

QUERIES = {}
SQL = {}


def register(name: str, sql: str | None = None):
    def add(build):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            ship_package(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return build(spark, sf)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


# --- messages to events ------------------------------------------------------------

OWNED_SQL = "('srv-0', 'click'), ('srv-1', 'view')"


def owned_tools(spark, sf):
    """Tools that own their telemetry field, out of the data."""
    return V.events(spark, sf).filter(
        "(server = 'srv-0' AND event_type = 'click') OR (server = 'srv-1' AND event_type = 'view')"
    ).selectExpr("server AS server_id", "event_type AS tool_name").distinct()


FLAT = [
    "event_id", "kind", "actor_id", "session_id_hint", "started_at", "finished_at", "duration_ms", "ok",
    "error", "metadata.tool_name AS tool_name", "metadata.user_intent AS user_intent",
    "metadata.agent_thinking AS agent_thinking", "metadata.frustration_level AS frustration_level",
    "metadata.input_preview AS input_preview", "metadata.client_name AS client_name",
    "metadata.client_version AS client_version", "metadata.protocol_version AS protocol_version",
    "metadata.identifier AS identifier", "script_source", "result_preview", "is_workflow",
    "workflow_run_id", "server_id", "emit_pos",
]

_OWNED = "((server = 'srv-0' AND b_tool = 'click') OR (server = 'srv-1' AND b_tool = 'view'))"
EVENTS_SQL = f"""WITH {Q.LOG}, tool AS (
  SELECT *, CASE WHEN {_OWNED} AND b_thinking IS NOT NULL THEN left(b_args, length(b_args) - 1) || ',"telemetry":{{"agent_thinking":"' || b_thinking || '"'
      || CASE WHEN b_level IS NOT NULL THEN ',"frustration_level":"high"' ELSE '' END
      || CASE WHEN b_intent IS NOT NULL THEN ',"user_intent":"' || b_intent || '"' ELSE '' END || '}}}}' ELSE b_args END AS input,
    phase = 'end' AND failure IS NULL AS answered FROM paired)
SELECT sha256(actor || ' tool_call ' || {Q.uuid_of('server', 'epoch_us(t)', 'seq')}) AS event_id, 'tool_call' AS kind, actor AS actor_id,
  session AS session_id_hint, {Q.stamp('b_at')} AS started_at, {Q.stamp('t')} AS finished_at,
  CAST(epoch_us(t) - epoch_us(b_at) AS BIGINT) // 1000 AS duration_ms,
  answered AND NOT tool_error AS ok,
  CASE WHEN phase = 'cancel' THEN 'context canceled' WHEN failure IS NOT NULL THEN failure WHEN tool_error THEN 'tool_error' END AS error,
  b_tool AS tool_name, CASE WHEN NOT {_OWNED} THEN b_intent END AS user_intent, CASE WHEN NOT {_OWNED} THEN b_thinking END AS agent_thinking,
  CASE WHEN NOT {_OWNED} THEN b_level END AS frustration_level, input AS input_preview, b_client AS client_name, b_version AS client_version,
  CASE WHEN b_client IS NOT NULL THEN '2025-06-18' END AS protocol_version, CAST(NULL AS VARCHAR) AS identifier,
  'MCP tool call: ' || b_tool || chr(10) || chr(10) || 'Input:' || chr(10) || input AS script_source,
  CASE WHEN answered THEN '{{"content":[{{"text":"done ' || event_id || '","type":"text"}}],"isError":' || tool_error || '}}' END AS result_preview,
  run IS NOT NULL AS is_workflow, run AS workflow_run_id, server AS server_id, 2 AS emit_pos FROM tool
UNION ALL
SELECT sha256(actor || ' session_init ' || actor || ':session_init:' || session), 'session_init', actor, session, {Q.stamp('began')}, {Q.stamp('began')}, 0, true,
  NULL, NULL, NULL, NULL, NULL, NULL, client, version, CASE WHEN client IS NOT NULL THEN '2025-06-18' END, NULL, NULL, NULL,
  run IS NOT NULL, run, server, 1
FROM (SELECT * FROM sightings QUALIFY row_number() OVER (PARTITION BY server, actor, session ORDER BY t, seq) = 1)
UNION ALL
SELECT sha256(actor || ' actor_identity ' || who), 'actor_identity', actor, NULL, {Q.stamp('began')}, {Q.stamp('began')}, 0, true,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, who, NULL, NULL, false, NULL, server, 0
FROM (SELECT * FROM sightings WHERE who IS NOT NULL QUALIFY row_number() OVER (PARTITION BY server, actor ORDER BY t, seq) = 1)"""


@register("message_log_events", EVENTS_SQL)
def message_log_events(spark, sf):
    return build_events(V.messages(spark, sf), BuildOptions(), owned_tools(spark, sf)).selectExpr(*FLAT)


@register("message_log_events_sliced", EVENTS_SQL)
def message_log_events_sliced(spark, sf):
    """The same with a limit so low that every session counts as hot."""
    return build_events(V.messages(spark, sf), BuildOptions(hot_rows=5), owned_tools(spark, sf)).selectExpr(*FLAT)


# The registration in force when a call began: the last one by time and number.
_REGISTERED = """registered AS (SELECT server AS at_server, event_type AS at_tool, epoch_us(ts)::HUGEINT * 1099511627776 + event_id * 4 + event_id % 3 AS place,
    event_id // 11 % 5 IN (0, 3) AS owned_then FROM ev WHERE event_id % 11 = 0 AND event_id // 11 % 5 <> 1),
  owned_calls AS (SELECT p.*, coalesce(owned_then, false) AS owned_now FROM paired p ASOF LEFT JOIN registered r
    ON server = at_server AND b_tool = at_tool AND epoch_us(b_at)::HUGEINT * 1099511627776 + b_seq >= place)"""
_AS_OF_EVENTS_SQL = EVENTS_SQL.replace(f"WITH {Q.LOG}, tool AS", f"WITH {Q.LOG}, {_REGISTERED}, tool AS").replace("answered FROM paired)", "answered FROM owned_calls)").replace(_OWNED, "owned_now")


def ownership_history(spark, sf):
    return catalog.ownership_history(V.registrations(spark, sf), "seq")


@register("message_log_events_as_of", _AS_OF_EVENTS_SQL)
def message_log_events_as_of(spark, sf):
    """The whole event table where tools change hands in mid-log: each call has the ownership of its time."""
    return build_events(V.messages(spark, sf), BuildOptions(), ownership_history(spark, sf)).selectExpr(*FLAT)


_OWNED_AS_OF_SQL = f"""WITH {Q.LOG}, {_REGISTERED} SELECT server AS server_id, b_tool AS tool_name, b_seq AS started_seq, owned_now AS owned FROM owned_calls"""


@register("ownership_as_of", _OWNED_AS_OF_SQL)
def ownership_as_of(spark, sf):
    calls = pair_calls(V.messages(spark, sf), BuildOptions()).calls
    return join_ownership(calls, ownership_history(spark, sf)).select("server_id", "tool_name", "started_seq", "owned")


@register("ownership_as_of_sliced", _OWNED_AS_OF_SQL)
def ownership_as_of_sliced(spark, sf):
    """The same with every tool cut into slices."""
    calls = pair_calls(V.messages(spark, sf), BuildOptions()).calls
    return join_ownership(calls, ownership_history(spark, sf), hot_rows=50).select("server_id", "tool_name", "started_seq", "owned")


@register("paired_calls", f"""WITH {Q.LOG}
SELECT server AS server_id, session AS session_id, b_tool AS tool_name, b_seq + seq - b_seq AS source_seq,
  {Q.stamp('b_at')} AS started_at, {Q.stamp('t')} AS finished_at, phase = 'cancel' AS cancelled FROM paired""")
def paired_calls(spark, sf):
    calls = pair_calls(V.messages(spark, sf), BuildOptions()).calls
    return calls.select(
        "server_id", "session_id", "tool_name", "source_seq",
        ids.rfc3339("started_at").alias("started_at"), ids.rfc3339("finished_at").alias("finished_at"),
        F.coalesce(F.col("error") == "context canceled", F.lit(False)).alias("cancelled"),
    )


@register("abandoned_calls", f"""WITH {Q.LOG}, after AS (
  SELECT *, lead(phase) OVER (PARTITION BY server, session, event_id % 5 ORDER BY t, seq) AS next_phase FROM known WHERE phase IN ('begin', 'end', 'cancel'))
SELECT server AS server_id, session AS session_id, event_type AS tool_name, 60000 AS duration_ms, 'context canceled' AS error, count(*) AS calls
FROM after WHERE phase = 'begin' AND next_phase IS NULL AND t + INTERVAL 60 SECOND <= TIMESTAMP '2024-03-01' GROUP BY ALL""")
def abandoned_calls(spark, sf):
    options = BuildOptions(abandon_after=60, as_of="2024-03-01")
    calls = pair_calls(V.messages(spark, sf), options).calls
    lost = calls.withColumn("duration_ms", ids.duration_ms("started_at", "finished_at")).filter(
        (F.col("duration_ms") == 60000) & (F.col("error") == "context canceled")
    )
    return lost.groupBy("server_id", "session_id", "tool_name", "duration_ms", "error").agg(
        F.count("*").alias("calls")
    )


@register("client_in_force", f"""WITH {Q.LOG}
SELECT server AS server_id, b_client AS client_name, b_version AS client_version, count(*) AS calls FROM paired GROUP BY ALL""")
def client_in_force(spark, sf):
    calls = pair_calls(V.messages(spark, sf), BuildOptions()).calls
    return calls.groupBy(
        "server_id", F.col("client.name").alias("client_name"), F.col("client.version").alias("client_version")
    ).agg(F.count("*").alias("calls"))


@register("tool_ownership", f"""WITH {Q.EV} SELECT server AS server_id, event_type AS tool_name,
  (server, event_type) IN ({OWNED_SQL}) AS owned, count(*) AS calls FROM ev GROUP BY ALL""")
def tool_ownership(spark, sf):
    rows = V.events(spark, sf).selectExpr("server AS server_id", "event_type AS tool_name")
    joined = join_ownership(rows, owned_tools(spark, sf))
    return joined.groupBy("server_id", "tool_name", "owned").agg(F.count("*").alias("calls"))


_BLOCKS = """CASE event_id % 8
  WHEN 0 THEN '{"user_intent":"now","intent":"old","user_frustration":"low"}'
  WHEN 1 THEN '{"user_intent":"","intent":"old","context":"why"}'
  WHEN 2 THEN '{"user_intent":5,"intent":"old","user_turn":3}'
  WHEN 3 THEN '{"user_frustration":"angry","frustration_level":"high"}'
  WHEN 4 THEN '"{\\\\"agent_thinking\\\\":\\\\"inside\\\\"}"'
  WHEN 5 THEN '[1]' WHEN 6 THEN 'null' ELSE '"text"' END"""


@register("telemetry_extraction", f"""WITH {Q.EV} SELECT event_id, event_type = 'click' AS owned,
  CASE WHEN event_type = 'click' THEN NULL WHEN event_id % 8 = 0 THEN 'now' WHEN event_id % 8 = 2 THEN 'old' END AS user_intent,
  CASE WHEN event_type = 'click' THEN 'p' || user_id WHEN event_id % 8 = 1 THEN 'why' WHEN event_id % 8 = 4 THEN 'inside' ELSE 'p' || user_id END AS agent_thinking,
  CASE WHEN event_type = 'click' THEN NULL WHEN event_id % 8 = 0 THEN 'low' WHEN event_id % 8 = 3 THEN 'high' END AS user_frustration FROM ev""")
def telemetry_extraction(spark, sf):
    """All shapes of the telemetry block, with a field map and owned tools."""
    rows = V.events(spark, sf).selectExpr(
        "event_id", "event_type = 'click' AS owned",
        f"concat('{{\"purpose\":\"p', user_id, '\",\"n\":1.50,\"telemetry\":', {_BLOCKS}, '}}') AS args",
    )
    found = telemetry.capture("args", owned="owned", fields={"agent_thinking": "purpose"})
    return rows.withColumn("t", found).select("event_id", "owned", "t.*")


@register("value_redactor", f"""WITH {Q.EV} SELECT event_id,
  CASE WHEN event_type = 'error' THEN '"[redaction failed]"' ELSE '{{"seen":["k"]}}' END AS input_preview FROM ev""")
def value_redactor(spark, sf):
    """User function on values; it fails on error calls, which must not leak."""
    from callscope.functions.payload import with_preview

    def keys_only(value):
        if value.get("k") is None:
            raise ValueError("no k")
        return {"seen": sorted(value)}

    rows = V.events(spark, sf).selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN '{\"other\":1}' ELSE props END AS args"
    )
    out = with_preview(rows, "input_preview", "args", redactor=keys_only)
    return out.select("event_id", "input_preview")


def _event_hook(call):
    if call["tool_name"] == "view":
        return None
    if call["tool_name"] == "error":
        raise ValueError("closed")
    return call | {"tool_name": "t-" + call["tool_name"], "input": {"keys": sorted(call["input"])}}


@register("event_hook", f"""WITH {Q.LOG} SELECT seq AS source_seq,
  CASE WHEN b_tool = 'error' THEN 'error' ELSE 't-' || b_tool END AS tool_name,
  CASE WHEN b_tool = 'error' THEN '"[redaction failed]"' ELSE '{{"keys":["k","page"]}}' END AS input_preview,
  CASE WHEN b_tool = 'error' THEN '[redaction failed]' WHEN phase = 'cancel' THEN 'context canceled' WHEN failure IS NOT NULL THEN failure WHEN tool_error THEN 'tool_error' END AS error
  FROM paired WHERE b_tool <> 'view'""")
def event_hook(spark, sf):
    options = BuildOptions(event_hook=_event_hook)
    calls = build_tool_calls(pair_calls(V.messages(spark, sf), options).calls, options)
    return calls.selectExpr(
        "source_seq", "metadata.tool_name AS tool_name", "metadata.input_preview AS input_preview", "error"
    )


_STAMPED = f"""{Q.stamp('b_at')} AS started_at, {Q.stamp('t')} AS finished_at, phase = 'cancel' AS cancelled FROM paired"""


def _call_columns(calls):
    return calls.select(
        "server_id", "session_id", "tool_name", "source_seq", F.col("client.name").alias("client_name"),
        ids.rfc3339("started_at").alias("started_at"), ids.rfc3339("finished_at").alias("finished_at"),
        F.coalesce(F.col("error") == "context canceled", F.lit(False)).alias("cancelled"),
    )


@register("stdio_calls", f"""WITH {Q.LOG} SELECT server AS server_id, session AS session_id, b_tool AS tool_name, seq AS source_seq,
  b_client AS client_name, {_STAMPED}""")
def stdio_calls(spark, sf):
    """Many processes of a server, all with the session `stdio` and equal request ids."""
    log = V.messages(spark, sf).withColumns({
        "process_id": F.col("transport_session_id"), "transport_session_id": F.lit("stdio"), "connection_id": F.lit(None).cast("string"),
    })
    return _call_columns(pair_calls(log, BuildOptions()).calls)


@register("middleware_calls", f"""WITH {Q.LOG.replace("last_value(client IGNORE NULLS)", "first_value(client IGNORE NULLS)")}
SELECT server AS server_id, session AS session_id, b_tool AS tool_name, seq AS source_seq, b_client AS client_name, {_STAMPED}""")
def middleware_calls(spark, sf):
    """As a middleware sees the log: the first client since the last close stays."""
    return _call_columns(pair_calls(V.messages(spark, sf), BuildOptions(adapter="middleware")).calls)


@register("lone_requests", f"""WITH {Q.LOG}, lone AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY t, seq) AS k FROM log WHERE phase IN ('end', 'cancel'))
SELECT server AS server_id, event_type AS tool_name, seq AS source_seq, {Q.stamp('ts')} AS started_at FROM lone WHERE k = 1""")
def lone_requests(spark, sf):
    """Requests without session or connection, all with one request id, told apart by their uid."""
    nothing = F.lit(None).cast("string")
    log = V.messages(spark, sf).withColumns({
        "request_uid": F.concat(F.lit("u"), F.floor(F.col("seq") / 4)), "request_id": F.lit("1"),
        "transport_session_id": nothing, "connection_id": nothing,
    })
    calls = pair_calls(log, BuildOptions(adapter="middleware")).calls
    return calls.select("server_id", "tool_name", "source_seq", ids.rfc3339("started_at").alias("started_at"))


# --- from the log to reports ---------------------------------------------------------

_LOGGED = f"""WITH events_ AS ({EVENTS_SQL}), calls AS (SELECT server_id, session_id_hint AS session_key, event_id AS call_id, actor_id, tool_name AS tool,
  started_at AS started, duration_ms, ok, error, user_intent, frustration_level AS user_frustration, client_name, input_preview AS input,
  workflow_run_id FROM events_ WHERE kind = 'tool_call')"""


def logged_calls(spark, sf):
    """Flat calls out of the events of the message log."""
    return sessions.calls_of(build_events(V.messages(spark, sf), BuildOptions(), owned_tools(spark, sf)))


@register("log_session_rollup", f"""{_LOGGED} SELECT server_id, session_key, count(*) AS event_count, count(*) FILTER (WHERE ok) AS ok_count,
  count(*) FILTER (WHERE NOT ok) AS error_count, min(actor_id) AS actor_id FROM calls GROUP BY ALL""")
def log_session_rollup(spark, sf):
    rolled = sessions.session_rollup(logged_calls(spark, sf))
    return rolled.select("server_id", "session_key", "event_count", "ok_count", "error_count", "actor_id")


@register("log_tool_usage", f"""{_LOGGED} SELECT tool, count(*) AS calls, count(DISTINCT (server_id, session_key)) AS sessions,
  count(DISTINCT actor_id) AS actors FROM calls GROUP BY ALL""")
def log_tool_usage(spark, sf):
    return usage.tool_usage(logged_calls(spark, sf))


@register("log_errors", f"{_LOGGED} SELECT tool, error, count(*) AS failed FROM calls WHERE NOT ok GROUP BY ALL")
def log_errors(spark, sf):
    return usage.error_breakdown(logged_calls(spark, sf))


@register("log_latency", f"""{_LOGGED} SELECT tool, count(*) AS calls, quantile_disc(duration_ms, 0.5) AS p50_ms, quantile_disc(duration_ms, 0.9) AS p90_ms,
  quantile_disc(duration_ms, 0.99) AS p99_ms, max(duration_ms) AS max_ms FROM calls GROUP BY ALL""")
def log_latency(spark, sf):
    return usage.tool_latency(logged_calls(spark, sf))


@register("log_user_traffic", f"{_LOGGED} SELECT tool, count(*) AS calls FROM calls WHERE workflow_run_id IS NULL GROUP BY ALL")
def log_user_traffic(spark, sf):
    """Calls of the log that no workflow run made."""
    events = build_events(V.messages(spark, sf), BuildOptions(), owned_tools(spark, sf))
    return sessions.calls_of(events, include_workflow=False).groupBy("tool").agg(F.count("*").alias("calls"))


@register("log_unmet_demand", f"""WITH {Q.LOG} SELECT 'need ' || b_tool || ' <x>' AS capability, count(*) AS requests, count(DISTINCT actor) AS actors
  FROM paired WHERE b_tool IN ('signup', 'error') GROUP BY ALL""")
def log_unmet_demand(spark, sf):
    """Capability requests of the log, by the text in their arguments."""
    log = V.messages(spark, sf).withColumn(
        "params", F.expr("""CASE WHEN get_json_object(params, '$.name') IN ('signup', 'error') AND phase = 'begin' THEN concat('{"name":"',
            get_json_object(params, '$.name'), '","arguments":{"capability":" Need ', get_json_object(params, '$.name'), ' <x> "}}') ELSE params END""")
    ).withColumn("capability_provenance", F.col("phase").isin("end", "cancel") & (F.col("method") == "tools/call"))
    calls = sessions.calls_of(build_events(log, BuildOptions()))
    return usage.unmet_demand(calls.filter("tool IN ('signup', 'error')"))


# --- ids and sessions --------------------------------------------------------------


@register("stateless_sessions", f"""WITH {Q.EV}, r AS (SELECT *, CAST(event_id AS VARCHAR) AS uid, {Q.uuid_of('event_id')} AS minted,
    CASE WHEN event_id % 2 = 0 THEN run_uuid END AS seed,
    CASE WHEN event_id % 2 = 0 THEN 'mcp_' || event_type || '_v_1.' || (user_id % 5) || '_' || run_uuid
         WHEN event_id % 3 <> 0 THEN 'plain-' || user_id END AS echo FROM ev)
SELECT uid AS request_uid, event_id % 5 < 2 AS is_initialize,
  CASE event_id % 5 WHEN 0 THEN 'mcp_My-' || event_type || '-app-' || user_id || '_v_v' || (user_id % 4) || '.0-beta_' || coalesce(seed, minted)
    WHEN 1 THEN 'mcp_unknown_v_2_' || coalesce(seed, minted) ELSE coalesce(echo, minted) END AS session_id,
  CASE WHEN event_id % 5 >= 2 AND event_id % 2 = 0 THEN event_type END AS client_name,
  CASE WHEN event_id % 5 >= 2 AND event_id % 2 = 0 THEN '1.' || (user_id % 5) END AS client_version FROM r""")
def stateless_sessions(spark, sf):
    out = resolve_sessions(V.http_requests(spark, sf))
    return out.select(
        "request_uid", "is_initialize", "session_id",
        F.col("client.name").alias("client_name"), F.col("client.version").alias("client_version"),
    )


@register("hash_ids", f"""WITH {Q.EV} SELECT event_id, sha256(CASE WHEN user_id % 4 = 0 THEN 'anonymous' ELSE 'u' || user_id END) AS actor_id,
  sha256(sha256(CASE WHEN user_id % 4 = 0 THEN 'anonymous' ELSE 'u' || user_id END) || ' tool_call ' ||
    CASE WHEN event_id % 3 = 0 THEN CAST(event_id AS VARCHAR) WHEN event_id % 3 = 1 THEN session || '#' || event_id ELSE {Q.uuid_of('event_id')} END) AS hashed,
  {Q.stamp('ts')} AS stamp FROM ev""")
def hash_ids(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        "event_id", "ts", "CASE WHEN user_id % 4 = 0 THEN '' ELSE concat('u', user_id) END AS seed",
        "CASE WHEN event_id % 3 = 0 THEN '' ELSE session END AS session_id",
        "CASE WHEN event_id % 3 = 2 THEN '' ELSE CAST(event_id AS STRING) END AS request",
    )
    actor = ids.actor_id("seed")
    request = ids.scoped_request_id("session_id", "request", ids.mint_uuid("event_id"))
    return rows.select(
        "event_id", actor.alias("actor_id"), ids.event_id(actor, "tool_call", request).alias("hashed"),
        ids.rfc3339("ts").alias("stamp"),
    )


@register("workflow_marks", f"""WITH {Q.EV} SELECT CASE event_id % 4 WHEN 0 THEN run_uuid WHEN 1 THEN upper(run_uuid) END AS workflow_run_id,
  count(*) AS calls FROM ev GROUP BY ALL""")
def workflow_marks(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        """map('x-WORKFLOW-run-id', CASE event_id % 4 WHEN 0 THEN concat(' ', run_uuid) WHEN 1 THEN upper(run_uuid)
             WHEN 2 THEN concat(run_uuid, '0') ELSE '' END) AS headers"""
    )
    mark = ids.workflow_run_id("headers", "X-Workflow-Run-Id")
    return rows.groupBy(mark.alias("workflow_run_id")).agg(F.count("*").alias("calls"))


@register("client_families", f"""WITH {Q.EV} SELECT CASE event_id % 6 WHEN 0 THEN 'claude_code' WHEN 1 THEN 'codex' WHEN 2 THEN 'claude_code'
  WHEN 3 THEN 'unexpected:unknown' WHEN 4 THEN 'unexpected:' || event_type ELSE 'claude_code' END AS family, count(*) AS sessions FROM ev GROUP BY ALL""")
def client_families(spark, sf):
    rows = V.events(spark, sf).selectExpr(
        """CASE event_id % 6 WHEN 0 THEN ' Claude-Code/1.0 ' WHEN 1 THEN 'OpenAI Codex' WHEN 2 THEN 'my-proxy'
             WHEN 3 THEN ' ' WHEN 4 THEN upper(event_type) ELSE 'claude  code' END AS client_name"""
    )
    return quality.family_counts(rows, {"my-proxy": "claude_code"})


# --- payloads ------------------------------------------------------------------------

_CLEAN = f"""WITH {Q.PLANTED}, s AS (SELECT *, {Q.strip_base64('body')} AS bare FROM planted),
  r AS (SELECT *, {Q.redact('bare')} AS clean FROM s)"""


@register("clean_documents", f"{_CLEAN} SELECT doc_id, clean AS body FROM r")
def clean_documents(spark, sf):
    return clean_payloads(V.planted_documents(spark, sf), text=["body"]).select("doc_id", "body")


_JSON_ESCAPED = (
    r"replace(replace(replace(replace(replace(to_json(clean), '<', '\u003c'), '>', '\u003e'), '&', '\u0026'),"
    r" chr(8232), '\u2028'), chr(8233), '\u2029')"
)


@register("clean_json", f"""{_CLEAN}
SELECT doc_id, '{{"blob":"[binary removed]","body":' || {_JSON_ESCAPED} || ',"id":' || doc_id || ',"password":"[redacted:sensitive-field]"}}' AS payload FROM r""")
def clean_json(spark, sf):
    return clean_payloads(V.json_payloads(spark, sf), json=["payload"]).select("doc_id", "payload")


_RULES_LEFT = ",".join(f'"{left}"' for _, left in V.RULE_VALUES)
_KEYS_LEFT = ",".join(
    f'"{name}":' + (value if value == "null" or name == "token_count" else '"[redacted:sensitive-field]"') for name, value in V.KEY_VALUES.items() if name != "zero_password"
)
_ROUGH_LEFT = f',"keys":{{{_KEYS_LEFT},"zero_password":null}},"n":'
_ROUGH_TAIL = ',"quote":"\\"é\\"\\nü /","rules":[' + _RULES_LEFT.replace("&", "\\u0026") + "]}"
_ROUGH_BODY = _JSON_ESCAPED.replace("to_json(clean)", "to_json(CASE WHEN doc_id % 10 = 4 THEN clean ELSE clean || chr(10) END)")


@register("clean_rough_json", f"""{_CLEAN}
SELECT doc_id, '{{"body":' || {_ROUGH_BODY} || ',"content":[{{"data":"[binary removed]","type":"image"}},{{"data":' || {_ROUGH_BODY} || ',"type":"text"}},{{"blob":"[binary removed]","data":1.50}}]'
  || '{_ROUGH_LEFT}' || (doc_id % 100) || '.50' || '{_ROUGH_TAIL}' AS payload FROM r""")
def clean_rough_json(spark, sf):
    """Every rule, key and binary member in nested JSON with escapes, accents and fractions."""
    return clean_payloads(V.rough_payloads(spark, sf), json=["payload"]).select("doc_id", "payload")


@register("json_in_python", "SELECT source, count(*) AS payloads, true AS few FROM documents GROUP BY source")
def json_in_python(spark, sf):
    """Payloads by source, and whether at most one in twenty leaves the built-in functions."""
    sources = V.table(spark, sf, "documents").select("doc_id", "source")
    flagged = payload.with_recursion_flag(V.rough_payloads(spark, sf), "slow", "payload").select("doc_id", "slow")
    return sources.join(flagged, "doc_id").groupBy("source").agg(
        F.count("*").alias("payloads"), (F.count_if("slow") * 20 <= F.count("*")).alias("few")
    )


@register("clean_pages", f"""WITH s AS (SELECT *, {Q.strip_base64('html')} AS bare FROM pages)
SELECT page_id, {Q.redact('bare')} AS html FROM s""")
def clean_pages(spark, sf):
    pages = V.spread(V.table(spark, sf, "pages"))
    return clean_payloads(pages, text=["html"]).select("page_id", "html")


_HITS = " UNION ALL ".join(
    f"SELECT source, '{name}' AS label, len(regexp_extract_all({Q.redact('body', i)}, '{pattern}')) AS hits FROM planted"
    for i, (name, pattern, _, _) in enumerate(Q.RULES)
)


@register("secret_audit", f"""WITH {Q.PLANTED}, h AS ({_HITS})
SELECT source, label, CAST(sum(hits) AS BIGINT) AS hits, count(*) AS texts FROM h WHERE hits > 0 GROUP BY ALL""")
def secret_audit(spark, sf):
    return usage.secret_audit(V.planted_documents(spark, sf), ["source"], "body")


_LEAKS = {
    "error": "'cannot reach postgres://u:pw' || event_id || '@db'", "result_preview": "'api_key=k' || event_id || ' then'",
    "metadata.input_preview": "'AKIA' || 'ABCDEFGHIJKLMNOP'", "metadata.agent_thinking": "'use Bearer q7Zk20mWx91LtB44Rvne'",
}
_LEAK_RULES = {"error": "connection-string", "result_preview": "sensitive-kv", "metadata.input_preview": "aws-access-key-id", "metadata.agent_thinking": "bearer"}


@register("secrets_before_and_after", " UNION ALL ".join(
    f"SELECT '{column}' AS \"column\", '{_LEAK_RULES[column]}' AS label, count(*) AS before, 0 AS after FROM events WHERE event_type <> 'signup' AND event_id % 4 = {i}"
    + (" AND event_id % 17 <> 0" if column in ("error", "result_preview") else " AND (event_id % 17 <> 0 OR event_id % 34 = 0)")
    for i, column in enumerate(_LEAKS)
))
def secrets_before_and_after(spark, sf):
    """Secrets planted in errors, results, arguments and telemetry of the log: what an export holds without and with redaction."""
    log = V.leaky_messages(spark, sf)
    found = []
    for name, secrets in (("before", False), ("after", True)):
        events = build_events(log, BuildOptions(hot_rows=None, redact_secrets=secrets))
        rows = quality.leaked_secrets(events.filter("metadata.tool_name <> 'signup'"), list(_LEAKS))
        found.append(rows.groupBy("column", "label").agg(F.sum("hits").alias(name)))
    return found[0].join(found[1], ["column", "label"], "left").select("column", "label", "before", F.coalesce("after", F.lit(0)).alias("after"))


@register("no_secret_survives", "SELECT '' AS event_id, '' AS \"column\", '' AS label, 0 AS hits WHERE false")
def no_secret_survives(spark, sf):
    """The redacted documents, searched again as an exported column."""
    clean = clean_payloads(V.planted_documents(spark, sf), text=["body"])
    rows = clean.selectExpr("CAST(doc_id AS STRING) AS event_id", "body AS result_preview")
    return quality.leaked_secrets(rows, ["result_preview"])


# --- envelopes and ingest --------------------------------------------------------------


def _event_table(spark, sf):
    return build_events(V.messages(spark, sf), BuildOptions(hot_rows=None))


_ENVELOPES_SQL = f"""WITH {Q.LOG}, e AS (
  SELECT server, t, seq FROM paired
  UNION ALL SELECT server, t, seq FROM (SELECT * FROM sightings QUALIFY row_number() OVER (PARTITION BY server, actor, session ORDER BY t, seq) = 1)
  UNION ALL SELECT server, t, seq FROM (SELECT * FROM sightings WHERE who IS NOT NULL QUALIFY row_number() OVER (PARTITION BY server, actor ORDER BY t, seq) = 1)),
b AS (SELECT *, (dense_rank() OVER (PARTITION BY server ORDER BY t, seq) - 1) // 20 AS batch FROM e)
SELECT server AS server_id, batch, count(*) AS event_count, strftime(min(t), '%Y-%m-%d %H:%M:%S.%f') AS first_at FROM b GROUP BY ALL"""


def _packed_envelopes(spark, sf, **given):
    packed = envelopes.pack_envelopes(_event_table(spark, sf), **given)
    return packed.select(
        "server_id", "batch", "event_count",
        F.date_format("first_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("first_at"),
    )


@register("envelopes", _ENVELOPES_SQL)
def envelopes_packed(spark, sf):
    return _packed_envelopes(spark, sf)


@register("envelopes_sliced", _ENVELOPES_SQL)
def envelopes_sliced(spark, sf):
    """The same envelopes with every server cut into slices."""
    return _packed_envelopes(spark, sf, hot_rows=50)


@register("envelope_round_trip", EVENTS_SQL.replace(_OWNED, "false"))
def envelope_round_trip(spark, sf):
    """Packed, written as JSON, read back: nothing may change."""
    packed = envelopes.pack_envelopes(_event_table(spark, sf), once=True).select("server_id", "body")
    back = envelopes.unpack_envelopes(packed)
    kinds = "CASE kind WHEN 'tool_call' THEN 2 WHEN 'session_init' THEN 1 ELSE 0 END AS emit_pos"
    return back.selectExpr(*[c if c != "emit_pos" else kinds for c in FLAT])


def _received(spark, sf):
    """Line items as received events: part keys repeat, so ids do."""
    return V.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS batch", "l_linenumber AS position", "l_orderkey AS arrival",
        "CASE WHEN l_quantity = 7 THEN NULL ELSE concat('e', l_partkey) END AS event_id",
        "CASE WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'other' ELSE 'tool_call' END AS kind",
        "CASE WHEN l_discount = 0.05 THEN 2 ELSE 1 END AS schema_version",
        "l_extendedprice AS body",
    )


_RECEIVED = """r AS (SELECT CAST(l_orderkey AS VARCHAR) AS batch, l_linenumber AS position, l_orderkey AS arrival,
    CASE WHEN l_quantity = 7 THEN NULL ELSE 'e' || l_partkey END AS event_id, l_extendedprice AS body,
    CASE WHEN l_discount = 0.05 THEN 'schema_version_mismatch' WHEN l_quantity = 7 THEN 'missing_event_id'
         WHEN l_returnflag = 'R' AND l_linenumber = 2 THEN 'unknown_kind' END AS reason FROM lineitem)"""


@register("ingest_report", f"""WITH {_RECEIVED}, d AS (SELECT *, reason IS NULL AND row_number() OVER (
    PARTITION BY event_id, reason IS NULL ORDER BY arrival, position, batch) > 1 AS duplicate FROM r)
SELECT batch, count(*) FILTER (WHERE reason IS NULL) AS accepted, count(*) FILTER (WHERE reason IS NOT NULL) AS rejected,
  count(*) FILTER (WHERE duplicate) AS duplicate_count FROM d GROUP BY ALL""")
def ingest_report(spark, sf):
    return envelopes.ingest_report(_received(spark, sf), "batch", ["arrival", "position"])


@register("deduplicated_events", f"""WITH {_RECEIVED} SELECT event_id, arrival, body FROM r WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY arrival, position, body) = 1""")
def deduplicated_events(spark, sf):
    return ingest(_received(spark, sf), ["arrival", "position", "body"]).select("event_id", "arrival", "body")


@register("late_redeliveries", f"""WITH {Q.EV}, again AS (SELECT CASE WHEN event_id % 17 = 0 THEN 'e' || event_id ELSE 'n' || (event_id - event_id % 3) END AS event_id, event_id AS arrival FROM ev)
  SELECT event_id, min(arrival) AS arrival FROM again WHERE event_id NOT IN (SELECT 'e' || event_id FROM ev) GROUP BY ALL""")
def late_redeliveries(spark, sf):
    """A batch that comes weeks after its events were indexed by day: what is new in it, once."""
    seen = V.events(spark, sf)
    path = scratch_dir(spark, "event-index")
    id_index.append_ids(seen.selectExpr("concat('e', event_id) AS event_id", "ts AS day"), path)
    again = seen.selectExpr("CASE WHEN event_id % 17 = 0 THEN concat('e', event_id) ELSE concat('n', event_id - event_id % 3) END AS event_id", "event_id AS arrival")
    return id_index.dedup_late(again, path, ["arrival"])


@register("refused_events", f"WITH {_RECEIVED} SELECT reason, count(*) AS events, count(DISTINCT batch) AS batches FROM r WHERE reason IS NOT NULL GROUP BY ALL")
def refused_events(spark, sf):
    rows = envelopes.rejected_events(_received(spark, sf), "batch")
    return rows.groupBy("reason").agg(F.count("*").alias("events"), F.countDistinct("batch").alias("batches"))


@register("delivery_report", f"""WITH {Q.ATTEMPTS} SELECT batch_id, attempts, status, verdict,
  CASE WHEN failure = 'cancelled' THEN 'ingest_cancelled' WHEN failure = 'timeout' THEN 'ingest_timeout' WHEN failure = 'network' THEN 'ingest_connection_failed'
       WHEN status < 300 THEN NULL WHEN kind = 4 THEN 'rate_limited' ELSE 'ingest_http_' || status END AS code,
  CASE WHEN failure IS NOT NULL THEN failure <> 'cancelled' ELSE status = 429 OR status >= 500 END AS retryable,
  CASE WHEN verdict = 'rejected' THEN CASE WHEN kind = 2 THEN 'ingest rejected 4 event(s) (quota, schema_version_mismatch)' ELSE 'ingest rejected 0 event(s)' END END AS message
FROM verdicts""")
def delivery_report(spark, sf):
    return delivery.classify_deliveries(V.attempts(spark, sf)).drop("response")


@register("refusals_with_events", f"""WITH {Q.ATTEMPTS}, known AS (SELECT DISTINCT 'e' || c_custkey AS event_id, c_mktsegment AS kind FROM customer),
  x AS (SELECT batch_id, unnest([{{'event_id': 'e' || o_custkey, 'reason': 'quota'}}, {{'event_id': NULL, 'reason': 'schema_version_mismatch'}}, {{'event_id': NULL, 'reason': 'quota'}}, {{'event_id': 'x', 'reason': ''}}]) AS r
    FROM verdicts WHERE kind = 2 AND failure IS NULL AND status < 300)
SELECT x.r.event_id AS event_id, batch_id, x.r.reason AS reason, known.kind AS kind FROM x LEFT JOIN known ON x.r.event_id = known.event_id""")
def refusals_with_events(spark, sf):
    known = V.table(spark, sf, "customer").selectExpr(
        "concat('e', c_custkey) AS event_id", "c_mktsegment AS kind", "'' AS actor_id", "'' AS session_id_hint"
    )
    done = delivery.classify_deliveries(V.attempts(spark, sf)).filter("status BETWEEN 200 AND 299")
    return delivery.rejected_by_ingest(done, known).select("event_id", "batch_id", "reason", "kind")


@register("refusal_reasons", f"""WITH {Q.ATTEMPTS}, x AS (SELECT batch_id, unnest(['quota', 'schema_version_mismatch', 'quota']) AS reason FROM verdicts WHERE kind = 2 AND failure IS NULL)
SELECT reason, count(*) AS events, count(DISTINCT batch_id) AS batches FROM x GROUP BY ALL""")
def refusal_reasons(spark, sf):
    return delivery.reason_totals(delivery.classify_deliveries(V.attempts(spark, sf)))


# --- sessions and usage ------------------------------------------------------------------

_ROLLUP = """SELECT server_id, session_key, count(*) AS event_count, count(*) FILTER (WHERE ok) AS ok_count,
  count(*) FILTER (WHERE NOT ok) AS error_count, min(actor_id) AS actor_id,
  arg_min(client_name, struct_pack(a := started, b := call_id)) AS client_name,
  arg_min(user_intent, struct_pack(a := started, b := call_id)) FILTER (WHERE user_intent IS NOT NULL) AS raw_intent,
  min(started) AS first_at, max(started) AS last_at FROM calls GROUP BY server_id, session_key"""
_TIMES = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f') AS {0}"


def _text_times(df, *names):
    return df.withColumns({n: F.date_format(n, "yyyy-MM-dd HH:mm:ss.SSSSSS") for n in names})


@register("session_rollup", f"WITH {Q.CALLS}, s AS ({_ROLLUP}) SELECT * REPLACE ({_TIMES.format('first_at')}, {_TIMES.format('last_at')}) FROM s")
def session_rollup(spark, sf):
    return _text_times(sessions.session_rollup(V.calls(spark, sf)), "first_at", "last_at")


@register("session_listing", f"""WITH {Q.CALLS}, s AS ({_ROLLUP}) SELECT server_id, session_key, event_count FROM s
  WHERE last_at >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 24 HOUR AND raw_intent = 'look at view'
  ORDER BY last_at DESC, server_id, session_key LIMIT 100""")
def session_listing(spark, sf):
    found = sessions.list_sessions(
        sessions.session_rollup(V.calls(spark, sf)), "2024-01-30 12:00:00", intent="look at view"
    )
    return found.select("server_id", "session_key", "event_count")


@register("user_traffic", f"WITH {Q.CALLS} SELECT tool, count(*) AS calls FROM calls WHERE workflow_run_id IS NULL GROUP BY ALL")
def user_traffic(spark, sf):
    """Calls without synthetic traffic."""
    rows = V.calls(spark, sf).withColumn("is_workflow", F.col("workflow_run_id").isNotNull())
    return sessions.exclude_workflow(rows).groupBy("tool").agg(F.count("*").alias("calls"))


_TRACE = f"""WITH {Q.CALLS}, t AS (SELECT *, row_number() OVER (PARTITION BY server_id, session_key ORDER BY started, call_id) AS position FROM calls)"""


@register("session_traces", f"{_TRACE} SELECT server_id, session_key, call_id, tool, position FROM t")
def session_traces(spark, sf):
    trace = sessions.session_trace(V.calls(spark, sf))
    return trace.select("server_id", "session_key", "call_id", "tool", "position")


@register("session_paths", f"""{_TRACE} SELECT server_id, session_key, (position - 1) // 3 AS piece, string_agg(tool, ' → ' ORDER BY position) AS path,
  count(*) AS calls FROM t GROUP BY ALL""")
def session_paths(spark, sf):
    return sessions.session_paths(sessions.session_trace(V.calls(spark, sf), hot_rows=4), piece=3)


@register("chat_turns", """WITH c AS (SELECT CAST(conv_id AS VARCHAR) AS conv, turn AS line, CASE WHEN role = 'user' THEN text END AS user_intent,
    CASE WHEN role = 'user' AND length(text) % 3 = 0 THEN 'high' END AS level FROM conversations),
  n AS (SELECT *, sum(CASE WHEN user_intent IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY line, user_intent ROWS UNBOUNDED PRECEDING) AS turn FROM c)
SELECT conv, line, CAST(turn AS BIGINT) AS turn, max(user_intent) OVER (PARTITION BY conv, turn) AS turn_intent, max(level) OVER (PARTITION BY conv, turn) AS turn_frustration FROM n""")
def chat_turns(spark, sf):
    turns = sessions.with_turns(V.chat(spark, sf), ["conv"], ["line"])
    return turns.select("conv", "line", "turn", "turn_intent", "turn_frustration")


_TURNS = f"""WITH {Q.CALLS}, n AS (SELECT *, sum(CASE WHEN user_intent IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY server_id, session_key ORDER BY started, call_id ROWS UNBOUNDED PRECEDING) AS turn FROM calls),
  t AS (SELECT server_id, session_key, turn, max(user_intent) AS intent, max(CASE WHEN user_intent IS NOT NULL THEN user_frustration END) AS level,
    count(*) AS calls, count(*) FILTER (WHERE NOT ok) AS failed FROM n GROUP BY ALL)"""


@register("intent_breakdown", f"""{_TURNS} SELECT intent, coalesce(level, 'none') AS frustration, count(*) AS turns, CAST(sum(calls) AS BIGINT) AS calls,
  CAST(sum(failed) AS BIGINT) AS failed FROM t WHERE intent IS NOT NULL GROUP BY ALL""")
def intent_breakdown(spark, sf):
    return usage.intent_breakdown(sessions.turn_summary(sessions.with_turns(V.calls(spark, sf))))


@register("retries", f"""WITH {Q.CALLS}, p AS (SELECT *, lag(ok) OVER w AS p_ok, lag(input) OVER w AS p_input, lag(call_id) OVER w AS retry_of FROM calls
  WINDOW w AS (PARTITION BY server_id, session_key, tool ORDER BY started, call_id))
SELECT server_id, session_key, tool, call_id, retry_of, p_input = input AS same_input, ok FROM p WHERE NOT p_ok""")
def retries(spark, sf):
    return sessions.find_retries(V.calls(spark, sf))


@register("tool_usage", f"WITH {Q.CALLS} SELECT tool, count(*) AS calls, count(DISTINCT (server_id, session_key)) AS sessions, count(DISTINCT actor_id) AS actors FROM calls GROUP BY ALL")
def tool_usage(spark, sf):
    return usage.tool_usage(V.calls(spark, sf))


@register("tool_failures", f"""WITH {Q.CALLS} SELECT tool, count(*) AS calls, count(*) FILTER (WHERE NOT ok) AS failed,
  count(*) FILTER (WHERE NOT ok AND error = 'deadline exceeded') AS timed_out, avg(CASE WHEN ok THEN 0.0::DOUBLE ELSE 1.0 END) AS failure_rate FROM calls GROUP BY ALL""")
def tool_failures(spark, sf):
    return usage.tool_failures(V.calls(spark, sf))


@register("error_breakdown", f"WITH {Q.CALLS} SELECT tool, error, count(*) AS failed FROM calls WHERE NOT ok GROUP BY ALL")
def error_breakdown(spark, sf):
    return usage.error_breakdown(V.calls(spark, sf))


@register("tool_latency", f"""WITH {Q.CALLS} SELECT tool, count(*) AS calls, quantile_disc(duration_ms, 0.5) AS p50_ms, quantile_disc(duration_ms, 0.9) AS p90_ms,
  quantile_disc(duration_ms, 0.99) AS p99_ms, max(duration_ms) AS max_ms FROM calls GROUP BY ALL""")
def tool_latency(spark, sf):
    return usage.tool_latency(V.calls(spark, sf))


_DAYS_SQL = f"""WITH {Q.CALLS} SELECT tool, CAST(epoch(date_trunc('day', started)) AS BIGINT) AS day, count(*) AS calls, count(*) FILTER (WHERE NOT ok) AS failed,
  count(DISTINCT (server_id, session_key)) AS sessions, count(DISTINCT actor_id) AS actors, true AS sessions_near, true AS actors_near,
  true AS p50_near, true AS p90_near, true AS p99_near FROM calls GROUP BY ALL"""


@register("sketched_usage", _DAYS_SQL)
def sketched_usage(spark, sf):
    """Usage by tool and day merged from hourly sketches, beside the exact counts.

    `_near`: a distinct count within 5 % (four standard errors) and one; the place of a quantile among all
    durations within 1.5 % of the calls (the stated rank error is 0.4 %) and one call.
    """
    calls = V.calls(spark, sf)
    day = F.date_trunc("day", "span_start").alias("day")
    merged = usage.merge_usage(usage.usage_sketches(calls), "tool", day).withColumnsRenamed({"sessions": "sessions_about", "actors": "actors_about"})
    dated = calls.withColumn("day", F.date_trunc("day", "started"))
    exact = usage.tool_usage(dated, by=("tool", "day"))
    places = dated.select("tool", "day", "duration_ms").join(merged, ["tool", "day"]).groupBy("tool", "day").agg(*[
        F.struct(F.count_if(F.col("duration_ms") < F.col(f"p{q}_ms")).alias("below"), F.count_if(F.col("duration_ms") <= F.col(f"p{q}_ms")).alias("upto"), F.count("duration_ms").alias("n")).alias(f"p{q}")
        for q in (50, 90, 99)
    ])
    near = lambda kind: F.abs(F.col(f"{kind}_about") - F.col(kind)) <= F.col(kind) * 0.05 + 1
    held = lambda q: ((F.col(f"p{q}.below") <= F.col(f"p{q}.n") * (q / 100 + 0.015) + 1) & (F.col(f"p{q}.upto") >= F.col(f"p{q}.n") * (q / 100 - 0.015) - 1)).alias(f"p{q}_near")
    return merged.drop("calls").join(exact, ["tool", "day"]).join(places, ["tool", "day"]).select(
        "tool", F.unix_seconds("day").alias("day"), "calls", "failed", "sessions", "actors",
        near("sessions").alias("sessions_near"), near("actors").alias("actors_near"), held(50), held(90), held(99),
    )


@register("unmet_demand", f"""WITH {Q.CALLS} SELECT lower(trim(capability)) AS capability, count(*) AS requests, count(DISTINCT actor_id) AS actors
  FROM calls WHERE capability_request AND strlen(capability) <= 1000 GROUP BY ALL""")
def unmet_demand(spark, sf):
    return usage.unmet_demand(V.calls(spark, sf))


@register("invalid_capabilities", f"WITH {Q.CALLS} SELECT 'too_long' AS problem, count(*) AS requests FROM calls WHERE capability_request AND strlen(capability) > 1000 HAVING count(*) > 0")
def invalid_capabilities(spark, sf):
    return usage.invalid_requests(V.calls(spark, sf))


@register("actor_activity", f"""WITH {Q.CALLS}, x AS (SELECT DISTINCT sha256(tool || (hour(started))) AS actor_id, server_id, count(*) OVER (PARTITION BY tool, hour(started)) AS calls FROM calls)
SELECT actor_id, count(*) AS servers, CAST(max(calls) AS BIGINT) AS calls FROM x GROUP BY actor_id HAVING count(*) >= 2""")
def actor_activity(spark, sf):
    rows = V.calls(spark, sf).withColumn("actor_id", F.expr("sha2(concat(tool, hour(started)), 256)"))
    return sessions.actor_activity(rows)


# --- catalog ---------------------------------------------------------------------------------


@register("catalog_audit", f"WITH {Q.CATALOG} SELECT server_id, status, has_hint, count(*) AS tools FROM catalog GROUP BY ALL")
def catalog_audit(spark, sf):
    audited = catalog.audit_catalog(V.catalog(spark, sf))
    return audited.groupBy("server_id", "status", "has_hint").agg(F.count("*").alias("tools"))


@register("catalog_owned", f"""WITH {Q.CATALOG}, l AS (SELECT * FROM catalog WHERE status <> 'unextendable' QUALIFY row_number() OVER (PARTITION BY server_id, tool_name ORDER BY at_ DESC) = 1)
SELECT server_id, tool_name FROM l WHERE status = 'owned'""")
def catalog_owned(spark, sf):
    return catalog.owned_tools(V.catalog(spark, sf))


@register("catalog_coverage", f"""WITH {Q.CATALOG}, l AS (SELECT *, status = 'decorated' AND has_hint AS carries FROM catalog QUALIFY row_number() OVER (PARTITION BY server_id, tool_name ORDER BY at_ DESC) = 1)
SELECT server_id, count(*) AS tools, count(*) FILTER (WHERE carries) AS covered, avg(CASE WHEN carries THEN 1.0::DOUBLE ELSE 0.0 END) AS coverage FROM l GROUP BY ALL""")
def catalog_coverage(spark, sf):
    return catalog.catalog_coverage(V.catalog(spark, sf))


@register("catalog_difference", """WITH served AS (SELECT DISTINCT 'srv-' || (p_partkey % 3) AS server_id, p_name || p_size || p_brand AS tool_name FROM part WHERE p_size > 10),
  wanted AS (SELECT DISTINCT 'srv-' || (p_partkey % 3) AS server_id, p_name || p_size || p_brand AS tool_name FROM part WHERE p_retailprice < 1000)
SELECT *, 'missing' AS difference FROM (SELECT * FROM wanted EXCEPT SELECT * FROM served)
UNION ALL SELECT *, 'unexpected' FROM (SELECT * FROM served EXCEPT SELECT * FROM wanted)""")
def catalog_difference(spark, sf):
    part = V.table(spark, sf, "part").selectExpr(
        "concat('srv-', p_partkey % 3) AS server_id", "concat(p_name, p_size, p_brand) AS tool_name", "p_size", "p_retailprice"
    )
    return catalog.catalog_diff(part.filter("p_size > 10"), part.filter("p_retailprice < 1000"))


# --- runs --------------------------------------------------------------------------------------


def _run_sessions(spark, sf):
    rows = V.run_sessions(spark, sf)
    listed = rows.groupBy("server_id", "session_key", "client_name").agg(F.count("*").alias("event_count"))
    return listed, rows


@register("labelled_runs", f"WITH {Q.RUNS} SELECT dispatch_id, pos, run_id, model_id, wave, harness, models, labelled, family FROM labelled")
def labelled_runs(spark, sf):
    return runs.label_runs(V.runs(spark, sf))


@register("runs_in_long_keys", f"""WITH {Q.EV}, {Q.RUNS}, keys AS (SELECT DISTINCT server AS server_id,
    event_type || '/' || repeat(md5(user_id::VARCHAR), 30) || '/' || CASE WHEN user_id % 3 = 0 THEN reverse(run_uuid) ELSE run_uuid END || '/' || repeat(md5(user_id::VARCHAR), 30) AS session_key FROM ev)
  SELECT server_id, md5(session_key) AS session_md5, run_id FROM keys JOIN (SELECT DISTINCT run_id FROM runs) ON contains(session_key, run_id)""")
def runs_in_long_keys(spark, sf):
    found = runs.runs_in_keys(V.long_key_sessions(spark, sf), V.runs(spark, sf))
    return found.select("server_id", F.md5("session_key").alias("session_md5"), "run_id")


@register("correlated_sessions", f"WITH {Q.SESSION_RUNS} SELECT * FROM corr")
def correlated_sessions(spark, sf):
    listed, rows = _run_sessions(spark, sf)
    return runs.correlate_runs(listed, rows, V.runs(spark, sf))


@register("expected_sessions", f"""WITH {Q.SESSION_RUNS}, f AS (SELECT *, CASE client_name WHEN 'Claude Code' THEN 'claude_code' WHEN ' codex-cli ' THEN 'codex' ELSE 'unexpected:other' END AS fam FROM corr),
  w AS (SELECT run_id, fam, count(*) AS n, min(session_key) AS one FROM f WHERE run_id IS NOT NULL GROUP BY ALL)
SELECT l.run_id, l.family, coalesce(n, 0) AS candidates, CASE WHEN n = 1 THEN one END AS session_key, coalesce(n = 1, false) AS selected
FROM labelled l LEFT JOIN w ON w.run_id = l.run_id AND w.fam = l.family""")
def expected_sessions(spark, sf):
    listed, rows = _run_sessions(spark, sf)
    table = V.runs(spark, sf)
    out = runs.select_expected(runs.correlate_runs(listed, rows, table), runs.label_runs(table))
    return out.select("run_id", "family", "candidates", "session_key", "selected")


@register("run_balance", f"WITH {Q.RUNS} SELECT dispatch_id, model_id, count(*) AS runs, count(DISTINCT run_id) AS run_ids, count(*) = 2 AND count(DISTINCT run_id) = count(*) AS balanced FROM runs GROUP BY ALL")
def run_balance(spark, sf):
    return runs.run_balance(V.runs(spark, sf))


_SPAN = 6 * 3600


@register("settled_watches", f"""WITH {Q.EV}, w AS (SELECT 'w' || user_id AS watch_id, session AS session_id, epoch_us(ts) // 1000000 // {_SPAN} AS span, count(*) AS n,
    count(*) FILTER (WHERE event_type = 'error') AS bad FROM ev GROUP BY ALL),
  added AS (SELECT DISTINCT watch_id, span FROM w),
  quiet AS (SELECT watch_id, span, lead(span) OVER (PARTITION BY watch_id ORDER BY span) AS next_span FROM added),
  seen AS (SELECT watch_id, session_id, min(span) AS first_span FROM w GROUP BY ALL),
  known AS (SELECT q.watch_id, q.span, q.next_span, (SELECT count(*) FROM seen s WHERE s.watch_id = q.watch_id AND s.first_span <= q.span) AS sessions FROM quiet q),
  last AS (SELECT max(span) AS end_span FROM w)
SELECT watch_id, (span + 1) * {_SPAN} AS stable_since, (span + 1) * {_SPAN} + 86400 AS settled_at, sessions FROM known, last
WHERE sessions >= 4 AND (coalesce(next_span, end_span + 1) - span - 1) * {_SPAN} >= 86400
QUALIFY row_number() OVER (PARTITION BY watch_id ORDER BY span) = 1""")
def settled_watches(spark, sf):
    """Users whose set of sessions stayed as it was for a day, out of windows of six hours."""
    calls = V.calls(spark, sf).withColumn("watch_id", F.concat(F.lit("w"), F.split("session_key", "-")[0]))
    done = runs.settled_windows(calls, "watch_id", "started", span="6 hours", quiet="1 day", min_sessions=4)
    return done.select("watch_id", F.unix_seconds("stable_since").alias("stable_since"), F.unix_seconds("settled_at").alias("settled_at"), "sessions")


# --- quality -------------------------------------------------------------------------------------


@register("session_isolation", f"""WITH {Q.CALLS}, s AS ({_ROLLUP}) SELECT raw_intent, count(*) AS sessions, count(DISTINCT session_key) AS session_keys,
  count(DISTINCT actor_id) AS actors, count(*) = count(DISTINCT session_key) AND count(DISTINCT actor_id) = 1 AS isolated FROM s GROUP BY ALL""")
def session_isolation(spark, sf):
    return quality.session_isolation(sessions.session_rollup(V.calls(spark, sf)), ["raw_intent"])


@register("foreign_markers", f"""WITH {Q.CALLS} SELECT server_id, session_key, call_id, regexp_extract(input, '(mk[0-9])', 1) AS marker FROM calls
  WHERE regexp_extract(input, '(mk[0-9])', 1) <> 'mk' || (CAST(split_part(session_key, '-', 1) AS INT) % 7)""")
def foreign_markers(spark, sf):
    rows = V.calls(spark, sf).selectExpr(
        "server_id", "call_id", "input",
        "concat(session_key, '#mk', CAST(split_part(session_key, '-', 1) AS INT) % 7) AS session_key",
    )
    found = quality.foreign_markers(rows, "(mk[0-9])", "#(mk[0-9])")
    return found.withColumn("session_key", F.substring_index("session_key", "#", 1))


@register("unhealthy_sessions", f"WITH {Q.CALLS}, s AS ({_ROLLUP}) SELECT server_id, session_key, event_count, error_count FROM s WHERE error_count > 0")
def unhealthy_sessions(spark, sf):
    found = quality.unhealthy_sessions(sessions.session_rollup(V.calls(spark, sf)))
    return found.select("server_id", "session_key", "event_count", "error_count")


@register("family_mismatches", f"""WITH {Q.CALLS}, c AS (SELECT 'unexpected:' || client_name AS family, count(*) AS sessions FROM calls GROUP BY ALL),
  e AS (SELECT * FROM (VALUES ('codex', 2), ('unexpected:client-0', 1)) v(family, expected))
SELECT family, coalesce(sessions, 0) AS sessions, coalesce(expected, 0) AS expected FROM c FULL JOIN e USING (family) WHERE coalesce(sessions, 0) <> coalesce(expected, 0)""")
def family_mismatches(spark, sf):
    return quality.family_mismatches(V.calls(spark, sf), {"codex": 2, "unexpected:client-0": 1})

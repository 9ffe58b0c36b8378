"""Fixed schemas, limits and placeholder values of the event model."""

from pyspark.sql import types as T

SCHEMA_VERSION = 1

TOOL_CALL = "tool_call"
SESSION_INIT = "session_init"
ACTOR_IDENTITY = "actor_identity"

# Fixed sizes, in UTF-8 bytes unless stated otherwise.
MAX_CAPABILITY_BYTES = 1000
ENVELOPE_CANDIDATES = 20

# Fixed placeholder texts.
BINARY_REMOVED = "[binary removed]"
BASE64_REMOVED = "[base64 removed]"
REDACTION_FAILED = "[redaction failed]"
SENSITIVE_FIELD = "[redacted:sensitive-field]"
UNSERIALISABLE = "[unserialisable]"

_S, _L, _B, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# One row per thing a server saw: a request, its answer, a cancel, a session close.
MESSAGE_SCHEMA = _struct(
    seq=_L,
    ts=_TS,
    server_id=_S,
    connection_id=_S,
    transport_session_id=_S,
    process_id=_S,
    request_id=_S,
    phase=_S,  # begin | end | cancel | close
    method=_S,  # tools/call | initialize
    headers=T.MapType(_S, _S),
    params=_S,
    result=_S,
    error=_S,
    error_type=_S,
    actor_seed=_S,
    identifier=_S,
    context_telemetry=_struct(user_intent=_S, agent_thinking=_S, user_frustration=_S),
    capability_provenance=_B,
    request_uid=_S,  # the same on a request and its answer, unique among lone requests
)

TELEMETRY_SCHEMA = _struct(user_intent=_S, agent_thinking=_S, user_frustration=_S)

CLIENT_SCHEMA = _struct(name=_S, version=_S, protocol_version=_S, capabilities=_S)

# One finished call, whichever way it was observed.
CALL_SCHEMA = _struct(
    server_id=_S,
    source_seq=_L,
    recorded_at=_TS,
    tool_name=_S,
    request_id=_S,
    params=_S,
    result=_S,
    error=_S,
    error_type=_S,
    is_tool_error=_B,
    session_id=_S,
    actor_seed=_S,
    identifier=_S,
    started_at=_TS,
    finished_at=_TS,
    client=CLIENT_SCHEMA,
    telemetry=TELEMETRY_SCHEMA,
    workflow_run_id=_S,
    capability_request=_B,
    started_seq=_L,  # place of the request among the rows of its log, where that is known
)

METADATA_SCHEMA = _struct(
    tool_name=_S,
    user_intent=_S,
    agent_thinking=_S,
    user_frustration=_S,
    intent=_S,
    context=_S,
    frustration_level=_S,
    input_preview=_S,
    capability_request=_B,
    client_name=_S,
    client_version=_S,
    protocol_version=_S,
    capabilities=_S,
    identifier=_S,
)

_EMPTY_LIST = T.ArrayType(_S)

EVENT_SCHEMA = _struct(
    event_id=_S,
    kind=_S,
    actor_id=_S,
    session_id_hint=_S,
    started_at=_S,
    finished_at=_S,
    duration_ms=_L,
    ok=_B,
    error=_S,
    metadata=METADATA_SCHEMA,
    script_source=_S,
    script_source_truncated=_B,
    result_preview=_S,
    result_truncated=_B,
    calls=_EMPTY_LIST,
    logs=_EMPTY_LIST,
    search_calls=_EMPTY_LIST,
    is_workflow=_B,
    workflow_run_id=_S,
)

# Columns that travel beside the wire fields in an event table.
EVENT_KEYS = ["server_id", "recorded_at", "source_seq", "emit_pos"]
EVENT_FIELDS = EVENT_SCHEMA.fieldNames()

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("events", T.ArrayType(EVENT_SCHEMA)),
    ]
)

# What a whole-event hook sees and may change.
CANDIDATE_SCHEMA = _struct(
    kind=_S,
    tool_name=_S,
    status=_S,
    duration_ms=_L,
    session_id=_S,
    input=_S,
    output=_S,
    error_message=_S,
    telemetry=TELEMETRY_SCHEMA,
)

HTTP_REQUEST_SCHEMA = _struct(request_uid=_S, body=_S, headers=T.MapType(_S, _S))

REJECTION_SCHEMA = T.ArrayType(_struct(event_id=_S, reason=_S))

RESPONSE_SCHEMA = T.StructType(
    [
        T.StructField("accepted", T.IntegerType()),
        T.StructField("rejected", REJECTION_SCHEMA),
        T.StructField("duplicate_count", T.IntegerType()),
        T.StructField("_corrupt_record", _S),
    ]
)

ATTEMPT_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", _S),
        T.StructField("attempt", T.IntegerType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("failure", _S),  # network | timeout | cancelled
        T.StructField("body", _S),
        T.StructField("event_count", T.IntegerType()),
    ]
)

CATALOG_SCHEMA = _struct(
    server_id=_S, registered_at=_TS, tool_name=_S, description=_S, input_schema=_S
)

RUN_SCHEMA = _struct(
    dispatch_id=_S, pos=_L, run_id=_S, model_id=_S, wave=_S, harness=_S
)

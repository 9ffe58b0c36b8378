"""Event rows from calls, session starts and identities."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions import clients, ids, payload, telemetry
from callscope.functions.text import (
    is_truncated,
    redact_secrets,
    script_source,
    truncate_utf8,
)
from callscope.operators import hooks
from callscope.operators.as_of import as_of_join
from callscope.operators.ordered import HOT_ROWS, TASK_ROWS, keep_first
from callscope.options import HOOKS, BuildOptions




def _null(kind) -> str:
    return f"CAST(NULL AS {kind.simpleString()})"


def _metadata(**known: str) -> str:
    """SQL of the metadata struct; keys that are not given are NULL."""
    fields = [f"{known.get(f.name, _null(f.dataType))} AS {f.name}" for f in S.METADATA_SCHEMA]
    return f"struct({', '.join(fields)})"


_CLIENT_KEYS = {
    "client_name": "nullif(client.name, '')",
    "client_version": "nullif(client.version, '')",
    "protocol_version": "nullif(client.protocol_version, '')",
    "capabilities": clients.sql_capabilities("client.capabilities"),
}

_EMPTY = {
    "duration_ms": "0L", "ok": "true", "script_source_truncated": "false",
    "result_truncated": "false", "is_workflow": "false",
    "calls": "array()", "logs": "array()", "search_calls": "array()",
}


def _sized(name: str, limit: int | None) -> Column:
    return F.col(name) if limit is None else truncate_utf8(name, limit)


def _is_cut(name: str, limit: int | None) -> Column:
    return F.lit(False) if limit is None else is_truncated(name, limit)


def _event(df: DataFrame, emit_pos: int | str, metadata: str, **values: str | Column) -> DataFrame:
    """Select the wire fields in order; anything not given has its empty value."""
    values = {"metadata": metadata, **values}
    fields = []
    for field in S.EVENT_SCHEMA:
        value = values.get(field.name, _EMPTY.get(field.name, _null(field.dataType)))
        if isinstance(value, str):
            kind = field.dataType.simpleString()
            value = F.expr(f"CAST({value} AS {kind})" if "array" in kind else value)
        fields.append(value.alias(field.name))
    return df.select(*fields, "server_id", "recorded_at", "source_seq", F.expr(str(emit_pos)).alias("emit_pos"))


def join_ownership(calls: DataFrame, owned: DataFrame | None, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Add `owned`: whether the tool of a call owns its telemetry field.

    `owned` is either a table of the (server_id, tool_name) that do, whose size decides
    between broadcast and shuffle, or a history of registrations (`ownership_history`), of which
    each call sees the last one before it began. A tool that was not registered yet owns nothing. There are
    few tools and whole calls are sorted by them, so tools are cut into slices of three quarters of `TASK_ROWS` at most:
    tasks get a slice or several each, and about equal numbers of rows.
    """
    if owned is None:
        return calls.withColumn("owned", F.lit(False))
    if "registered_at" in owned.columns:
        slices = None if hot_rows is None else min(hot_rows, TASK_ROWS * 3 // 4)
        joined = as_of_join(
            calls, owned, ["server_id", "tool_name"], ("started_at", "started_seq"), ("registered_at", "registered_seq"), ["owned"], slices
        )
    else:
        marks = owned.select("server_id", "tool_name").distinct().withColumn("owned", F.lit(True))
        joined = calls.join(marks, ["server_id", "tool_name"], "left")
    return joined.withColumn("owned", F.coalesce("owned", F.lit(False)))


def with_candidate(calls: DataFrame, options: BuildOptions) -> DataFrame:
    """Add the prepared `candidate`: sanitized, secrets redacted, value hook applied.

    Input and output are JSON texts, not yet cut to preview size.
    """
    secrets, redactor = options.redact_secrets, options.redactor
    block = telemetry.capture(
        "params", owned="owned", context="telemetry", pick="arguments",
        enabled=options.capture_telemetry, fields=options.telemetry_fields,
    )
    df = calls.withColumn("__block", block)
    df = df.withColumn("__block", telemetry.clean("__block", secrets))
    # An output that is no object counts as well, an input of hooks does not.
    df = payload.with_previews(
        df,
        {
            "__input": {"value": "params", "pick": "arguments", "strip": ~F.col("owned"), "objects_only": options.adapter == HOOKS},
            "__output": {"value": "result", "drop_marker": options.capability_marker},
        },
        secrets=secrets, redactor=redactor,
    )
    df = df.withColumn("__error", clients.error_text("error", "is_tool_error", "error_type"))
    if secrets:
        # Errors are redacted only: no binary removal, no size limit.
        df = df.withColumn("__error", redact_secrets("__error"))
    if redactor is not None:
        df = df.withColumns({
            "__error": hooks.redact_error(F.col("__error"), redactor),
            "__block": hooks.redact_telemetry(F.col("__block"), redactor),
        })
    has_output = F.col("result").isNotNull() & (F.col("__output") != payload.UNDEFINED)
    candidate = F.struct(
        F.lit(S.TOOL_CALL).alias("kind"),
        F.col("tool_name"),
        F.when(clients.ok("error", "is_tool_error"), "ok").otherwise("error").alias("status"),
        ids.duration_ms("started_at", "finished_at").alias("duration_ms"),
        F.col("session_id"),
        F.col("__input").alias("input"),
        F.when(has_output, F.col("__output")).alias("output"),
        F.col("__error").alias("error_message"),
        F.expr(f"CASE WHEN NOT {telemetry.sql_is_empty('__block')} THEN __block END").alias("telemetry"),
    )
    df = df.withColumn("candidate", candidate)
    return df.drop("__input", "__output", "__error", "__block")


def build_tool_calls(
    calls: DataFrame, options: BuildOptions, owned: DataFrame | None = None
) -> DataFrame:
    """`tool_call` events of finished calls."""
    df = with_candidate(join_ownership(calls, owned, options.hot_rows), options)
    if options.event_hook is not None:
        df = hooks.with_event_hook(df, options.event_hook)
    actor = ids.actor_id("actor_seed")
    moment = F.unix_micros("recorded_at")
    minted = ids.mint_uuid("server_id", moment, "source_seq", random=options.random_ids)
    df = df.withColumns({
        "actor_id": actor,
        "minted": minted,
        "source": script_source("candidate.tool_name", "candidate.input"),
    })
    request = ids.scoped_request_id("session_id", "request_id", "minted")
    values = {name: f"nullif(candidate.telemetry.{name}, '')" for name in telemetry.FIELDS}
    df = df.withColumn("preview", _sized("candidate.input", options.preview_bytes))
    return _event(
        df, 2,
        _metadata(
            tool_name="candidate.tool_name",
            **values,
            **{telemetry.LEGACY[name]: value for name, value in values.items()},
            input_preview="preview",
            capability_request="CASE WHEN capability_request THEN true END",
            **_CLIENT_KEYS,
        ),
        event_id=ids.event_id("actor_id", S.TOOL_CALL, request),
        kind=f"'{S.TOOL_CALL}'",
        actor_id="actor_id",
        session_id_hint="nullif(candidate.session_id, '')",
        started_at=ids.rfc3339("started_at"),
        finished_at=ids.rfc3339("finished_at"),
        duration_ms="candidate.duration_ms",
        ok="candidate.status = 'ok'",
        error="candidate.error_message",
        script_source=_sized("source", options.source_bytes),
        script_source_truncated=_is_cut("source", options.source_bytes),
        result_preview=_sized("candidate.output", options.preview_bytes),
        result_truncated=_is_cut("candidate.output", options.preview_bytes),
        is_workflow="workflow_run_id IS NOT NULL",
        workflow_run_id="workflow_run_id",
    )


START_COLUMNS = [
    "server_id", "source_seq", "recorded_at", "session_id", "actor_seed", "identifier",
    "started_at", "client", "workflow_run_id",
]


def first_sightings(calls: DataFrame, starts: DataFrame) -> DataFrame:
    """Everything that may start a session: explicit starts and the calls themselves."""
    explicit = starts.select(*START_COLUMNS, F.lit(True).alias("explicit"))
    implied = calls.select(*START_COLUMNS, F.lit(False).alias("explicit"))
    return explicit.unionByName(implied).withColumn("actor_id", ids.actor_id("actor_seed"))


RECORD_ORDER = ["recorded_at", "source_seq"]


def build_session_inits(inits: DataFrame) -> DataFrame:
    """`session_init` events; their id depends on actor and session alone."""
    df = inits.withColumns({
        "actor_id": ids.actor_id("actor_seed"), "stamp": ids.rfc3339("started_at"),
    })
    return _event(
        df, 1,
        _metadata(**_CLIENT_KEYS),
        event_id=ids.event_id("actor_id", S.SESSION_INIT, ids.init_request_id("actor_id", "session_id")),
        kind=f"'{S.SESSION_INIT}'",
        actor_id="actor_id",
        session_id_hint="nullif(session_id, '')",
        started_at="stamp",
        finished_at="stamp",
        is_workflow="workflow_run_id IS NOT NULL",
        workflow_run_id="workflow_run_id",
    )


def build_identities(identities: DataFrame) -> DataFrame:
    """`actor_identity` events, addressed by the identifier they carry."""
    df = identities.withColumns({
        "actor_id": ids.actor_id("identifier"), "stamp": ids.rfc3339("started_at"),
    })
    return _event(
        df, 0,
        _metadata(identifier="identifier"),
        event_id=ids.event_id("actor_id", S.ACTOR_IDENTITY, F.col("identifier")),
        kind=f"'{S.ACTOR_IDENTITY}'",
        actor_id="actor_id",
        started_at="stamp",
        finished_at="stamp",
    )


def session_roles(sightings: DataFrame) -> DataFrame:
    """Each sighting once for its session and, if identified, once for its actor.

    `role` is `init` or `identity`, `about` what it is the first of. Blank sessions start
    only explicitly, and then every time.
    """
    roles = F.expr(
        """filter(array(
          CASE WHEN session_id != '' THEN named_struct('role', 'init', 'about', session_id)
               WHEN explicit THEN named_struct('role', 'init', 'about', concat('#', source_seq)) END,
          CASE WHEN identifier IS NOT NULL THEN named_struct('role', 'identity', 'about', '') END
        ), r -> r IS NOT NULL)"""
    )
    return sightings.withColumn("actor_id", ids.actor_id("actor_seed")).select(
        "*", F.explode(roles).alias("__role")
    ).select("*", "__role.role", "__role.about").drop("__role")


def first_of_each(sightings: DataFrame) -> DataFrame:
    """The sightings that become events: the first of each session and identity, in one shuffle."""
    return keep_first(session_roles(sightings), ["server_id", "actor_id", "role", "about"], RECORD_ORDER)


def build_session_events(firsts: DataFrame) -> DataFrame:
    """`session_init` and `actor_identity` events of `first_of_each`."""
    df = firsts.withColumns({
        "kind": F.expr(f"CASE role WHEN 'init' THEN '{S.SESSION_INIT}' ELSE '{S.ACTOR_IDENTITY}' END"),
        "stamp": ids.rfc3339("started_at"),
        "request": F.when(
            F.col("role") == "init", ids.init_request_id("actor_id", "session_id")
        ).otherwise(F.col("identifier")),
        "workflow_run_id": F.expr("CASE WHEN role = 'init' THEN workflow_run_id END"),
        "client": F.expr("CASE WHEN role = 'init' THEN client END"),
    })
    return _event(
        df, "CASE role WHEN 'init' THEN 1 ELSE 0 END",
        _metadata(identifier="CASE WHEN role = 'identity' THEN identifier END", **_CLIENT_KEYS),
        event_id=ids.event_id("actor_id", F.col("kind"), "request"),
        kind="kind",
        actor_id="actor_id",
        session_id_hint="CASE WHEN role = 'init' THEN nullif(session_id, '') END",
        started_at="stamp",
        finished_at="stamp",
        is_workflow="workflow_run_id IS NOT NULL",
        workflow_run_id="workflow_run_id",
    )

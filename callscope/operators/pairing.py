"""From a message log to finished calls and session starts.

One hash layout on the connection serves everything here: the client in force,
the session id remembered from the initialize request, and the pairing of each
request with its answer.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions import ids
from callscope.functions.text import blank_to_null, trim_space
from callscope.operators.ordered import (
    Sliced,
    dealt,
    keep_first,
    slice_hot,
    with_previous,
    with_running,
    written_in_slices,
)
from callscope.options import HOOKS, MIDDLEWARE, BuildOptions

TOOLS_CALL = "tools/call"
INITIALIZE = "initialize"
STDIO = "stdio"
CANCELLED = "context canceled"

ORDER = ["ts", "seq"]
CONNECTION = ["server_id", "connection"]

# What a finished call takes over from its request.
REQUEST_COLUMNS = [
    "ts", "params", "headers", "client", "session_id", "actor_seed", "identifier",
    "context_telemetry", "seq",
]


def relevant_messages(messages: DataFrame) -> DataFrame:
    """Tool calls, successful initializes and session closes; the rest is not recorded."""
    call = (F.col("method") == TOOLS_CALL) & F.col("phase").isin("begin", "end", "cancel")
    start = (F.col("method") == INITIALIZE) & (F.col("phase") == "end") & F.col("error").isNull()
    return messages.filter(call | start | (F.col("phase") == "close"))


def connection_key(adapter: str, session_header: str) -> Column:
    """Session id, or the connection where that is blank, so blank sessions never meet.

    Every process has a `stdio` session of its own. Middleware sees requests without
    any session: those go by their header, and otherwise stand alone, under the log's
    `request_uid`. A log without uids falls back to process and request id, which tells
    lone requests apart only while their ids differ.
    """
    session, connection = blank_to_null("transport_session_id"), blank_to_null("connection_id")
    process = F.concat(F.lit("stdio:"), F.coalesce(blank_to_null("process_id"), connection, F.lit("")))
    session = F.when(session == STDIO, process).otherwise(session)
    if adapter == HOOKS:
        return F.coalesce(session, connection, F.lit(""))
    header = blank_to_null(trim_space(ids.header("headers", session_header)))
    by_id = F.concat_ws(":", "process_id", F.coalesce("request_id", F.col("seq").cast("string")))
    alone = F.concat(F.lit("request:"), F.coalesce(blank_to_null("request_uid"), by_id))
    return F.coalesce(session, connection, header, alone)


def client_info(params: Column, adapter: str) -> Column:
    """Client struct of an initialize request."""
    parsed = F.from_json(
        params,
        "clientInfo struct<name: string, version: string>, protocolVersion string",
    )
    caps = F.lit(None).cast("string")
    if adapter == MIDDLEWARE:
        caps = F.get_json_object(params, "$.capabilities")
    return F.struct(
        blank_to_null(parsed["clientInfo"]["name"]).alias("name"),
        blank_to_null(parsed["clientInfo"]["version"]).alias("version"),
        blank_to_null(parsed["protocolVersion"]).alias("protocol_version"),
        caps.alias("capabilities"),
    )


def analytics_session_id(adapter: str, session_header: str, remembered: Column) -> Column:
    """Session id an event carries; blank when there is none to carry."""
    session = blank_to_null("transport_session_id")
    if adapter == HOOKS:
        return F.when(session == STDIO, F.col("process_id")).otherwise(F.coalesce(session, F.lit("")))
    header = blank_to_null(trim_space(ids.header("headers", session_header)))
    without = F.when(F.col("headers").isNotNull(), F.lit("")).otherwise(F.col("process_id"))
    return F.coalesce(session, remembered, header, without)


def with_client(sliced: Sliced, options: BuildOptions) -> Sliced:
    """Add `client`, `session_id` and `opens_session` to every message.

    The client is the one in force when the message came; a close forgets it. With
    hooks the latest initialize counts, with middleware the first one since the
    last close. `opens_session` marks that first initialize, which alone may start
    a session. Messages without any session have no memory.
    """
    hooks = options.adapter == HOOKS
    is_start = F.col("method").eqNullSafe(INITIALIZE) & (F.col("phase") == "end")
    lone = blank_to_null("transport_session_id").isNull() & blank_to_null("connection_id").isNull()
    closed = (F.col("phase") == "close").cast("long")
    epochs = with_running(sliced, CONNECTION, ORDER, sums={"epoch": closed})

    info = F.when(is_start & ~lone, client_info(F.col("params"), options.adapter))
    no_memory = F.lit(None).cast("string")
    own_id = analytics_session_id(options.adapter, options.session_header, no_memory)
    known = {"first_start": F.when(is_start, F.col("seq"))}
    if hooks:
        known_client = {"last": {"client": info}}
    else:
        known["remembered"] = F.when(is_start & ~lone, blank_to_null(own_id))
        known_client = {"first": {"client": info}}
    known_client["first"] = known_client.get("first", {}) | known
    out = with_running(epochs, [*CONNECTION, "epoch"], ORDER, **known_client)

    opens = is_start & (F.col("seq") == F.col("first_start"))
    if not hooks:
        opens = opens | (is_start & lone)
    remembered = no_memory if hooks else F.col("remembered")
    session = analytics_session_id(options.adapter, options.session_header, remembered)
    df = out.df.withColumn("opens_session", F.coalesce(opens, F.lit(False)))
    df = df.withColumn("session_id", F.coalesce(session, F.lit("")))
    return out.replace(df.drop("epoch", "first_start", "remembered"))


@dataclass
class Observed:
    """Finished calls (`CALL_SCHEMA`) and session starts of a message log.

    `sightings` holds the key columns of both, from one pass over the log.
    """

    calls: DataFrame
    starts: DataFrame
    sightings: DataFrame | None = None


def actor_seed(headers: str = "headers") -> Column:
    return F.coalesce(blank_to_null("actor_seed"), ids.header(headers, "Authorization"))


def call_actor_seed() -> Column:
    return F.coalesce(
        F.col("prev_identifier"),
        blank_to_null("prev_actor_seed"),
        ids.header("prev_headers", "Authorization"),
    )


def prepare_messages(messages: DataFrame, options: BuildOptions) -> DataFrame:
    """Recorded messages with their connection key, given seed and identifier."""
    seed = F.col("actor_seed")
    if options.actor_seed is not None:
        seed = F.coalesce(blank_to_null("actor_seed"), options.actor_seed)
    identifier = F.col("identifier")
    if options.actor_identifier is not None:
        identifier = options.actor_identifier
    if "request_uid" not in messages.columns:
        messages = messages.withColumn("request_uid", F.lit(None).cast("string"))
    return relevant_messages(messages).withColumns({
        "actor_seed": seed,
        "identifier": ids.actor_identifier(identifier),
        "server_id": F.coalesce("server_id", F.lit("")),
        "request_id": F.coalesce("request_id", F.lit("")),
        "connection": connection_key(options.adapter, options.session_header),
    })


def finish_call(pairs: DataFrame, options: BuildOptions) -> DataFrame:
    """`CALL_SCHEMA` rows of paired messages: answer columns plus `prev_` request columns."""
    error = F.when(
        F.col("phase") == "cancel", F.coalesce(blank_to_null("error"), F.lit(CANCELLED))
    ).otherwise(F.col("error"))
    # A result only counts when no error came with it.
    result = F.when(error.isNull(), F.col("result"))
    flag = F.from_json(F.when(result.contains("isError"), result), "isError boolean")["isError"]
    marked = F.get_json_object(result, f"$._meta['{options.capability_marker}']").isNotNull()
    marked = F.when(result.contains(options.capability_marker), marked)
    session = F.col("prev_session_id")
    return pairs.select(
        "server_id",
        F.col("seq").alias("source_seq"),
        F.col("ts").alias("recorded_at"),
        F.get_json_object("prev_params", "$.name").alias("tool_name"),
        F.lit(None).cast("string").alias("request_id"),
        F.col("prev_params").alias("params"),
        result.alias("result"),
        error.alias("error"),
        F.col("error_type"),
        F.coalesce(flag, F.lit(False)).alias("is_tool_error"),
        session.alias("session_id"),
        call_actor_seed().alias("actor_seed"),
        F.col("prev_identifier").alias("identifier"),
        F.col("prev_ts").alias("started_at"),
        F.col("ts").alias("finished_at"),
        F.coalesce("prev_client", ids.client_from_session_id(session)).alias("client"),
        F.col("prev_context_telemetry").alias("telemetry"),
        ids.workflow_run_id("prev_headers", options.workflow_header).alias("workflow_run_id"),
        F.coalesce("capability_provenance", marked, F.lit(False)).alias("capability_request"),
        F.col("prev_seq").alias("started_seq"),
    )


def pending_requests(calls: DataFrame) -> DataFrame:
    """Requests without any later row of their id."""
    newest_first = [F.col(c).desc() for c in ORDER]
    return keep_first(calls, [*CONNECTION, "request_id"], newest_first).filter(F.col("phase") == "begin")


def expired(ts: Column, now: Column, options: BuildOptions) -> Column:
    return ts + F.expr(f"interval {int(options.abandon_after)} seconds") <= now


def as_cancelled(pending: DataFrame, options: BuildOptions) -> DataFrame:
    """Requests as pairs with a cancel of their own, `abandon_after` seconds later."""
    horizon = F.expr(f"interval {int(options.abandon_after)} seconds")
    request = {f"prev_{name}": F.col(name) for name in REQUEST_COLUMNS}
    return pending.withColumns(request).withColumns({
        "ts": F.col("ts") + horizon,
        "phase": F.lit("cancel"),
        "prev_phase": F.lit("begin"),
        "error": F.lit(None).cast("string"),
        "result": F.lit(None).cast("string"),
    })


def abandoned(calls: DataFrame, options: BuildOptions) -> DataFrame:
    """Requests without any later row of their id, older than the horizon, as cancels."""
    now = F.lit(options.as_of).cast("timestamp")
    pending = pending_requests(calls).filter(expired(F.col("ts"), now, options))
    return as_cancelled(pending, options)


def pair_calls(messages: DataFrame, options: BuildOptions) -> Observed:
    """Pair each request with the next answer or cancel of its id on its connection.

    An answer without a request is dropped, a second request under the same id
    replaces the first, and an id may be used again after its answer: so an answer
    pairs exactly when the row before it is a request. Payload columns cross the
    network once, on the connection; client look-up and pairing share that layout.
    Where connections are sliced, every carry reads the log anew: it is written with its slices before, and the pairs
    are written for all who read them.
    """
    prepared = prepare_messages(messages, options)
    if options.hot_rows is None:
        prepared = dealt(prepared, CONNECTION, prepared.count())
    sliced = slice_hot(prepared, CONNECTION, ORDER, options.hot_rows, once=True)
    seen = with_client(sliced, options)

    # Starts ride along the pairing window under keys of their own, so that one pass
    # yields everything that may open a session.
    is_call = F.col("method").eqNullSafe(TOOLS_CALL)
    own_key = F.concat(F.lit("start "), F.col("seq").cast("string"))
    rows = seen.df.filter(is_call | F.col("opens_session")).withColumn(
        "exchange", F.when(is_call, F.concat(F.lit("call "), F.col("request_id"))).otherwise(own_key)
    )
    keys = [*CONNECTION, "exchange"]
    paired = with_previous(seen.replace(rows), keys, ORDER, ["phase", *REQUEST_COLUMNS]).df
    is_pair = is_call & F.col("phase").isin("end", "cancel") & (F.col("prev_phase") == "begin")
    paired = paired.drop("prev_row")
    starts = seen.df.filter("opens_session")
    if sliced.hot is not None:
        paired = written_in_slices(paired.filter(F.col("opens_session") | is_pair), "paired")
        starts = paired.filter("opens_session")
    pairs = paired.filter(is_pair)
    sightings = sighting_rows(paired.filter(F.col("opens_session") | is_pair), options)
    if options.abandon_after is not None:
        lost = abandoned(seen.df.filter(is_call), options)
        lost = lost.withColumn("exchange", F.lit(None).cast("string"))
        pairs = pairs.unionByName(lost.select(pairs.columns))
        sightings = sightings.unionByName(sighting_rows(lost, options))
    return Observed(finish_call(pairs, options), sighting_rows(starts, options, only_starts=True), sightings)


def sighting_rows(rows: DataFrame, options: BuildOptions, only_starts: bool = False) -> DataFrame:
    """Who was seen in which session: `START_COLUMNS` of starts and of paired calls."""
    opens = F.col("opens_session")
    own = {
        "session_id": F.col("session_id"),
        "actor_seed": F.coalesce("identifier", actor_seed()),
        "identifier": F.col("identifier"),
        "started_at": F.col("ts"),
        "client": client_info(F.col("params"), options.adapter),
        "workflow_run_id": ids.workflow_run_id("headers", options.workflow_header),
    }
    of_call = {} if only_starts else {
        "session_id": F.col("prev_session_id"),
        "actor_seed": call_actor_seed(),
        "identifier": F.col("prev_identifier"),
        "started_at": F.col("prev_ts"),
        "client": F.col("prev_client"),
        "workflow_run_id": ids.workflow_run_id("prev_headers", options.workflow_header),
    }
    values = {n: F.when(opens, v).otherwise(of_call[n]) if of_call else v for n, v in own.items()}
    values["client"] = F.coalesce(values["client"], ids.client_from_session_id(values["session_id"]))
    return rows.select(
        "server_id",
        F.col("seq").alias("source_seq"),
        F.col("ts").alias("recorded_at"),
        *[value.alias(name) for name, value in values.items()],
        opens.alias("explicit"),
    )

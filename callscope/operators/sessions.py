"""Sessions, traces, turns and retries of an event table.

Works on `tool_call` events in the flat form of `calls_of`. Sessions are keyed,
never cut by gaps. Turns and retries are named by the public documentation of the
event model but defined here; see each function.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.operators.ordered import HOT_ROWS, slice_hot, with_previous, with_running

SESSION = ["server_id", "session_key"]
TIME_ORDER = ["started", "call_id"]
PATH_PIECE = 100


def calls_of(events: DataFrame, include_workflow: bool = True, capability: str = "capability") -> DataFrame:
    """Flat `tool_call` rows: session, actor, tool, times, outcome, telemetry.

    Without `include_workflow`, synthetic traffic stays out. The text of a capability
    request is its argument `capability`.
    """
    m = F.col("metadata")
    rows = events.filter(F.col("kind") == S.TOOL_CALL)
    if not include_workflow:
        rows = exclude_workflow(rows)
    return rows.select(
        "server_id",
        F.coalesce("session_id_hint", F.lit("")).alias("session_key"),
        F.col("event_id").alias("call_id"),
        "actor_id",
        m["tool_name"].alias("tool"),
        F.to_timestamp("started_at").alias("started"),
        "duration_ms",
        "ok",
        "error",
        m["user_intent"].alias("user_intent"),
        m["agent_thinking"].alias("agent_thinking"),
        m["user_frustration"].alias("user_frustration"),
        m["client_name"].alias("client_name"),
        m["input_preview"].alias("input"),
        F.coalesce(m["capability_request"], F.lit(False)).alias("capability_request"),
        F.when(m["capability_request"], F.get_json_object(m["input_preview"], f"$.{capability}")).alias("capability"),
        "workflow_run_id",
    )


def exclude_workflow(events: DataFrame) -> DataFrame:
    """Events of real users only."""
    return events.filter(~F.coalesce("is_workflow", F.lit(False)))


def session_rollup(calls: DataFrame) -> DataFrame:
    """One row per session: calls, outcomes, actor, client, first intent, time span.

    Only tool calls count as events. All measures merge before the shuffle.
    """
    place = F.struct(*TIME_ORDER)
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), place))
    return calls.filter(F.col("session_key") != "").groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if("ok").alias("ok_count"),
        F.count_if(~F.col("ok")).alias("error_count"),
        first("actor_id").alias("actor_id"),
        first("client_name").alias("client_name"),
        first("user_intent").alias("raw_intent"),
        F.min("started").alias("first_at"),
        F.max("started").alias("last_at"),
    )


def list_sessions(
    sessions: DataFrame, as_of: str, hours: int = 24, intent: str | None = None, limit: int = 100
) -> DataFrame:
    """Latest sessions of a time range, optionally of one exact intent.

    Newest first, then by key; the order is ours.
    """
    since = F.lit(as_of).cast("timestamp") - F.expr(f"interval {int(hours)} hours")
    found = sessions.filter(F.col("last_at") >= since)
    if intent is not None:
        found = found.filter(F.col("raw_intent") == intent)
    return found.orderBy(F.col("last_at").desc(), *SESSION).limit(limit)


def session_trace(calls: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Calls of each session with their position in time order, from 1."""
    sliced = slice_hot(calls.filter(F.col("session_key") != ""), SESSION, TIME_ORDER, hot_rows)
    return with_running(sliced, SESSION, TIME_ORDER, sums={"position": F.lit(1)}).done()


def session_paths(trace: DataFrame, piece: int = PATH_PIECE) -> DataFrame:
    """Tool path `a -> b -> c` of each session, in pieces of at most `piece` calls.

    Joining the pieces of a session in order gives its whole path; no task ever holds
    more than one piece of a session.
    """
    number = F.floor((F.col("position") - 1) / piece).alias("piece")
    in_order = F.array_sort(F.collect_list(F.struct("position", "tool")))
    return trace.groupBy(*SESSION, number).agg(
        F.array_join(F.transform(in_order, lambda e: e["tool"]), " → ").alias("path"),
        F.count(F.lit(1)).alias("calls"),
    )


def with_turns(
    rows: DataFrame,
    keys: list[str] | None = None,
    order: list[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add `turn`, `turn_intent` and `turn_frustration`.

    A call with a user intent opens a turn, calls without one continue it; frustration
    is taken from the opening call. Calls before the first intent are turn 0.
    """
    keys, order = keys or SESSION, order or TIME_ORDER
    opens = F.col("user_intent").isNotNull()
    opening = F.when(opens, F.struct("user_intent", "user_frustration"))
    sliced = slice_hot(rows, keys, order, hot_rows)
    out = with_running(
        sliced, keys, order, sums={"turn": opens.cast("bigint")}, last={"__opening": opening}
    ).done()
    return out.withColumns({
        "turn_intent": F.col("__opening.user_intent"),
        "turn_frustration": F.col("__opening.user_frustration"),
    }).drop("__opening")


def turn_summary(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per turn: its intent, frustration, calls and failures."""
    return rows.groupBy(*(keys or SESSION), "turn").agg(
        F.max("turn_intent").alias("turn_intent"),
        F.max("turn_frustration").alias("turn_frustration"),
        F.count(F.lit(1)).alias("calls"),
        F.count_if(~F.col("ok")).alias("failed"),
    )


def find_retries(calls: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Calls that repeat a failed call: same session and tool, the one before failed.

    `same_input` tells whether the input preview was the same as well.
    """
    named = calls.filter(F.col("session_key") != "").withColumn("input_hash", F.xxhash64("input"))
    sliced = slice_hot(named, SESSION, TIME_ORDER, hot_rows)
    seen = with_previous(sliced, [*SESSION, "tool"], TIME_ORDER, ["ok", "input_hash", "call_id"]).done()
    return seen.filter(F.col("prev_row") & ~F.col("prev_ok")).select(
        *SESSION, "tool", "call_id",
        F.col("prev_call_id").alias("retry_of"),
        (F.col("prev_input_hash") == F.col("input_hash")).alias("same_input"),
        "ok",
    )


def actor_activity(calls: DataFrame, min_servers: int = 2) -> DataFrame:
    """Actors seen on several servers.

    Reduced to distinct (actor, server) pairs first; actor ids only agree between
    servers that hash the same seed.
    """
    pairs = calls.groupBy("actor_id", "server_id").agg(F.count(F.lit(1)).alias("calls"))
    return pairs.groupBy("actor_id").agg(
        F.count(F.lit(1)).alias("servers"), F.sum("calls").alias("calls")
    ).filter(F.col("servers") >= min_servers)


def timed_out(error: str = "error") -> Column:
    return F.coalesce(F.lower(error).rlike("deadline|time[d]?[ -]?out"), F.lit(False))

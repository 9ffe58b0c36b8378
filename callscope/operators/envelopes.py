"""Envelopes: packing events, reading them back, de-duplication, accounting."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope import schemas as S
from callscope.functions.text import sql_text
from callscope.operators.ordered import HOT_ROWS, SLICE, dealt, keep_first, slice_hot, written

_CALL_KEYS = [
    "tool_name", "user_intent", "agent_thinking", "user_frustration", "intent", "context",
    "frustration_level", "input_preview",
]
_CLIENT_KEYS = ["client_name", "client_version", "protocol_version"]


def _sql_json(value: str) -> str:
    """JSON text of a string, `null` for NULL."""
    return f"coalesce(substring(to_json(struct({value} AS v)), 6, length(to_json(struct({value} AS v))) - 6), 'null')"


def _sql_member(key: str, value: str, optional: bool = False) -> str:
    name = sql_text(f'"{key}":')
    if optional:
        return f"CASE WHEN {value} IS NOT NULL THEN concat({name}, {_sql_json(value)}) END"
    return f"concat({name}, CASE WHEN {value} IS NULL THEN 'null' ELSE {_sql_json(value)} END)"


def _sql_raw_member(key: str, json_text: str, optional: bool) -> str:
    name = sql_text(f'"{key}":')
    if optional:
        return f"CASE WHEN {json_text} IS NOT NULL THEN concat({name}, {json_text}) END"
    return f"concat({name}, coalesce({json_text}, 'null'))"


def _metadata_json() -> str:
    """Metadata of one event. Which keys are written as null and which are left out
    depends on the kind: calls leave out unknown client keys, starts name all four."""
    m = "metadata"
    call = [_sql_member(k, f"{m}.{k}") for k in _CALL_KEYS]
    call += [f"CASE WHEN {m}.capability_request THEN '\"capability_request\":true' END"]
    call += [_sql_member(k, f"{m}.{k}", optional=True) for k in _CLIENT_KEYS]
    call += [_sql_raw_member("capabilities", f"{m}.capabilities", optional=True)]
    start = [_sql_member(k, f"{m}.{k}") for k in _CLIENT_KEYS]
    start += [_sql_raw_member("capabilities", f"{m}.capabilities", optional=False)]
    who = [_sql_member("identifier", f"{m}.identifier")]

    def members(parts: list[str]) -> str:
        return "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"

    return (
        f"CASE kind WHEN '{S.TOOL_CALL}' THEN {members(call)}"
        f" WHEN '{S.SESSION_INIT}' THEN {members(start)} ELSE {members(who)} END"
    )


def event_json() -> Column:
    """Wire form of one event row."""
    parts = []
    for field in S.EVENT_SCHEMA:
        name = field.name
        if name == "metadata":
            parts.append(_sql_raw_member(name, _metadata_json(), optional=False))
        elif name in ("calls", "logs", "search_calls"):
            parts.append(sql_text(f'"{name}":[]'))
        elif name == "is_workflow":
            parts.append("CASE WHEN is_workflow THEN '\"is_workflow\":true' END")
        elif name == "workflow_run_id":
            parts.append(_sql_member(name, name, optional=True))
        elif field.dataType.simpleString() in ("bigint", "boolean"):
            parts.append(_sql_raw_member(name, f"CAST({name} AS STRING)", optional=False))
        else:
            parts.append(_sql_member(name, name))
    return F.expr("concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')")


def with_envelope(
    events: DataFrame, size: int = S.ENVELOPE_CANDIDATES, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add `batch`: the envelope each event belongs to, first in, first out per server.

    A batch takes `size` candidates; the events of one candidate (up to three) stay
    together. The places of the candidates, narrow rows, are written once and numbered by
    themselves; events find their number by their place, so no window holds whole events and all
    tasks share them, however few the servers. Servers with very many places are cut into slices:
    candidates are numbered within each, and the numbers of the slices before it, summed up over one
    row a slice, are added. So the numbers are the same at any size. `hot_rows=None`, for a small
    table, numbers the events where they are.
    """
    order = ["recorded_at", "source_seq"]
    if hot_rows is None:
        window = Window.partitionBy("server_id").orderBy(*order)
        return events.withColumn("batch", F.floor((F.dense_rank().over(window) - 1) / size).cast("bigint"))
    places = written(events.select("server_id", *order).distinct(), "places")
    sliced = slice_hot(places, ["server_id"], order, hot_rows)
    window = Window.partitionBy(*sliced.window_keys(["server_id"])).orderBy(*order)
    local = sliced.df.withColumn("__candidate", F.row_number().over(window))
    number = F.col("__candidate")
    if sliced.hot is not None:
        before = Window.partitionBy("server_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        counts = sliced.df.groupBy("server_id", SLICE).agg(F.count(F.lit(1)).alias("__held"))
        carried = counts.withColumn("__before", F.coalesce(F.sum("__held").over(before), F.lit(0))).drop("__held")
        local = local.join(carried, ["server_id", SLICE])
        number = number + F.col("__before")
    place = F.struct("server_id", *order).alias("__place")
    batches = local.select(place, F.floor((number - 1) / size).cast("bigint").alias("batch"))
    return dealt(events.withColumn("__place", place), ["__place"], places.count()).join(batches, "__place").drop("__place")


def pack_envelopes(
    events: DataFrame, size: int = S.ENVELOPE_CANDIDATES, hot_rows: int | None = HOT_ROWS, once: bool = False
) -> DataFrame:
    """Envelope documents of an event table: one row per batch with its JSON `body`.

    Numbering reads the events for their places before they are packed. With `once`, for events that are
    costly to make and whose bodies are wanted, their JSON is written first and both read that.
    """
    rows = events.select("server_id", "recorded_at", "source_seq", "emit_pos", event_json().alias("json"))
    if once:
        rows = written(rows, "packed-events")
    placed = with_envelope(rows, size, hot_rows)
    if once:
        placed = dealt(placed, ["server_id", "batch"], rows.count())
    in_order = F.array_sort(F.collect_list(F.struct("recorded_at", "source_seq", "emit_pos", "json")))
    body = F.concat(
        F.lit('{"schema_version":%d,"events":[' % S.SCHEMA_VERSION),
        F.array_join(F.transform(in_order, lambda e: e["json"]), ","),
        F.lit("]}"),
    )
    return placed.groupBy("server_id", "batch").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("recorded_at").alias("first_at"),
        body.alias("body"),
    )


def unpack_envelopes(documents: DataFrame, body: str = "body") -> DataFrame:
    """Event rows of envelope documents, with `schema_version` and `position` kept."""
    parsed = documents.withColumn("__envelope", F.from_json(body, S.ENVELOPE_SCHEMA))
    others = [c for c in documents.columns if c != body]
    exploded = parsed.select(
        *others,
        F.col("__envelope.schema_version").alias("schema_version"),
        F.posexplode("__envelope.events").alias("position", "event"),
    )
    return exploded.select(*others, "schema_version", "position", "event.*").withColumns({
        "is_workflow": F.coalesce("is_workflow", F.lit(False)),
    })


def rejection_reason(version: str = "schema_version") -> Column:
    """Why an event is refused, NULL if it is taken.

    Only the version mismatch is a published reason; the two others are ours.
    """
    kinds = [S.TOOL_CALL, S.SESSION_INIT, S.ACTOR_IDENTITY]
    return (
        F.when(~F.col(version).eqNullSafe(S.SCHEMA_VERSION), "schema_version_mismatch")
        .when(F.coalesce("event_id", F.lit("")) == "", "missing_event_id")
        .when(~F.coalesce(F.col("kind").isin(kinds), F.lit(False)), "unknown_kind")
    )


def dedup_events(events: DataFrame, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """One row per event id: the first in `order`, whatever the partitioning."""
    return keep_first(events, keys or ["event_id"], order)


def ingest_report(received: DataFrame, batch: str, order: list[str]) -> DataFrame:
    """Accepted, rejected and duplicate events per batch of received events.

    A duplicate counts as accepted. The first copy of each event is found by a
    pre-aggregated minimum, and duplicates are what remains, so an event that fills a
    third of the table needs no join on its id.
    """
    judged = received.withColumn("reason", rejection_reason())
    taken = F.col("reason").isNull()
    totals = judged.groupBy(batch).agg(
        F.count_if(taken).alias("accepted"), F.count_if(~taken).alias("rejected")
    )
    place = F.struct(*order, F.col(batch))
    firsts = (
        judged.filter(taken)
        .groupBy("event_id").agg(F.min(place).alias("first"))
        .groupBy(F.col(f"first.{batch}").alias(batch)).agg(F.count(F.lit(1)).alias("fresh"))
    )
    return totals.join(firsts, batch, "left").select(
        batch, "accepted", "rejected",
        (F.col("accepted") - F.coalesce("fresh", F.lit(0))).alias("duplicate_count"),
    )


def rejected_events(received: DataFrame, batch: str) -> DataFrame:
    """Refused events with their reason."""
    judged = received.withColumn("reason", rejection_reason())
    return judged.filter(F.col("reason").isNotNull()).select(batch, "event_id", "reason")

"""Streaming queries over the driver's tables; each must give its batch form's rows.

The log comes as FILES spans of time in order, one in each micro-batch.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.functions import ids
from callscope.operators import quality
from callscope.operators.envelopes import unpack_envelopes
from callscope.operators.pairing import pair_calls
from callscope.options import BuildOptions
from callscope.schemas import MESSAGE_SCHEMA
from callscope.session import scratch_dir
from callscope.sources.readers import read_messages
from callscope.streaming import build, sinks
from callscope.streaming.log import LogTables, end_of_log
from workload import sql as Q
from workload import views as V
from workload.registry import EVENTS_SQL, FLAT, owned_tools, register

OPTIONS = BuildOptions(hot_rows=None)
DELAY = 600
FILES = 8
#: Rows of one file of the log, about; a time span of more comes in several files.
FILE_ROWS = 100_000


def with_file(log: DataFrame, spans: int = FILES) -> DataFrame:
    """The file of each row: equal spans of the log's time."""
    span = log.agg(F.min(F.unix_micros("ts")).alias("low"), F.max(F.unix_micros("ts")).alias("high")).first()
    if span.low is None:
        return log.withColumn("file", F.lit(0))
    number = F.floor((F.unix_micros("ts") - F.lit(span.low)) * spans / F.lit(span.high - span.low + 1))
    return log.withColumn("file", number.cast("int"))


def message_files(spark: SparkSession, sf: str, late: str = "false", spans: int = FILES) -> tuple[str, int]:
    """The message log as files in time order, for a stream to read span by span, and the files of a span.

    Rows for which `late` holds come with the last span; one row after it ends the log. Each
    span is written in parallel, in as many files as the log's size asks for.
    """
    dealt, path = scratch_dir(spark, "messages-by-file"), scratch_dir(spark, "messages")
    file = F.when(F.expr(late), spans - 1).otherwise(F.col("file"))
    with_file(V.messages(spark, sf), spans).withColumn("file", file).write.partitionBy("file").parquet(dealt)
    # A stream takes the oldest files first, so the spans are written in turn.
    rows = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in MESSAGE_SCHEMA)}, file int").parquet(dealt)
    sizes = dict(rows.groupBy("file").count().collect())
    files = max(1, min([-(-max(sizes.values(), default=1) // FILE_ROWS), *sizes.values()]))
    for number in sorted(sizes):
        rows.filter(F.col("file") == number).select(MESSAGE_SCHEMA.fieldNames()).repartition(files).write.mode("append").parquet(path)
    end_of_log(spark, rows, OPTIONS, DELAY).repartition(1).write.mode("append").parquet(path)
    return path, files


def log_stream(spark: SparkSession, path: str, files: int = 1) -> DataFrame:
    return read_messages(spark, path, streaming=True, files_per_trigger=files)


def drain(stream: DataFrame, **sink) -> None:
    spark = stream.sparkSession
    query = sinks.start(stream, scratch_dir(spark, "stream-state"), **sink)
    query.awaitTermination()


def collected(stream: DataFrame) -> DataFrame:
    """Run an append query over all available input and read what it wrote."""
    spark = stream.sparkSession
    path = scratch_dir(spark, "stream-out")
    drain(stream, path=path)
    return spark.read.schema(stream.schema).parquet(path)


def processed(spark, sf, owned=None, late="false", only_calls=True, spans=FILES, watched=None) -> LogTables:
    """The whole log taken in micro-batches, with the default delay; `watched` gets their progress."""
    taken = LogTables(spark, scratch_dir(spark, "stream-log"), OPTIONS, delay=DELAY, owned=owned)
    query = taken.start(log_stream(spark, *message_files(spark, sf, late, spans)))
    query.awaitTermination()
    if watched is not None:
        watched.extend(query.recentProgress)
    if not only_calls:
        taken.start_sessions().awaitTermination()
    return taken


_PAIRED = f"""WITH {Q.LOG} SELECT server AS server_id, session AS session_id, b_tool AS tool_name, seq AS source_seq,
  {Q.stamp('b_at')} AS started_at, {Q.stamp('t')} AS finished_at FROM paired"""


@register("stream_paired_calls", _PAIRED)
def stream_paired_calls(spark, sf):
    return processed(spark, sf).calls().select(
        "server_id", "session_id", "tool_name", "source_seq",
        ids.rfc3339("started_at").alias("started_at"), ids.rfc3339("finished_at").alias("finished_at"),
    )


@register("stream_log_events", EVENTS_SQL)
def stream_log_events(spark, sf):
    """The whole event table, with session starts and identities from calls as well."""
    return processed(spark, sf, owned_tools(spark, sf), only_calls=False).events().selectExpr(*FLAT)


@register("stream_tool_calls", f"""WITH {Q.LOG} SELECT sha256(actor || ' tool_call ' || {Q.uuid_of('server', 'epoch_us(t)', 'seq')}) AS event_id,
  b_tool AS tool_name, b_args AS input_preview, phase = 'end' AND failure IS NULL AND NOT tool_error AS ok FROM paired""")
def stream_tool_calls(spark, sf):
    """Finished calls as a stream of their own, built without state."""
    taken = processed(spark, sf)
    events = collected(build.tool_calls_stream(taken.call_stream(), OPTIONS))
    return events.selectExpr(
        "event_id", "metadata.tool_name AS tool_name", "metadata.input_preview AS input_preview", "ok"
    )


_FIRST = "QUALIFY row_number() OVER (PARTITION BY server, actor, {0} ORDER BY t, seq) = 1"


@register("stream_session_inits", f"""WITH {Q.LOG} SELECT server AS server_id, session AS session_id_hint, actor AS actor_id, {Q.stamp('began')} AS started_at,
  client AS client_name, run AS workflow_run_id FROM (SELECT * FROM sightings {_FIRST.format('session')})""")
def stream_session_inits(spark, sf):
    events = processed(spark, sf, only_calls=False).session_events().filter("kind = 'session_init'")
    return events.selectExpr(
        "server_id", "session_id_hint", "actor_id", "started_at", "metadata.client_name AS client_name", "workflow_run_id"
    )


@register("stream_identities", f"""WITH {Q.LOG} SELECT server AS server_id, who AS identifier, {Q.stamp('began')} AS started_at
  FROM (SELECT * FROM sightings WHERE who IS NOT NULL {_FIRST.format('who')})""")
def stream_identities(spark, sf):
    events = processed(spark, sf, only_calls=False).session_events().filter("kind = 'actor_identity'")
    return events.selectExpr("server_id", "metadata.identifier AS identifier", "started_at")


_LATE = "event_id % 97 = 0 AND phase = 'begin'"


@register("stream_late_rows", f"""WITH {Q.LOG}, span AS (SELECT min(epoch_us(t)) AS low, max(epoch_us(t)) - min(epoch_us(t)) + 1 AS width FROM log),
  filed AS (SELECT server, seq, t, {_LATE} AS held, (epoch_us(t) - low) * {FILES} // width AS file FROM log, span)
SELECT server AS server_id, seq FROM filed
WHERE held AND file < {FILES - 1} AND epoch_us(t) <= (SELECT max(epoch_us(t)) FROM filed WHERE NOT held AND file < {FILES - 1}) - 600000000""")
def stream_late_rows(spark, sf):
    """Requests that come with the last file, after their time was decided."""
    taken = processed(spark, sf, late="seq div 4 % 97 = 0 AND phase = 'begin'")
    return taken.late().select("server_id", "seq")


@register("stream_deduplicated", f"""WITH {Q.EV} SELECT DISTINCT server AS server_id, session AS event_id FROM ev""")
def stream_deduplicated(spark, sf):
    """Every message of a session arrives as the same event; one may stay."""
    messages = log_stream(spark, *message_files(spark, sf))
    events = messages.filter("phase = 'begin'").selectExpr(
        "server_id", "transport_session_id AS event_id", "ts AS recorded_at"
    )
    return collected(build.dedup_stream(events, delay="60 days")).select("server_id", "event_id")


@register("stream_session_rollup", f"""WITH {Q.EV} SELECT server AS server_id, session AS session_key, count(*) AS event_count,
  count(*) FILTER (WHERE event_type <> 'error') AS ok_count, count(*) FILTER (WHERE event_type = 'error') AS error_count FROM ev GROUP BY ALL""")
def stream_session_rollup(spark, sf):
    """Running counts by session and day; the last snapshots of a session sum up to it."""
    messages = log_stream(spark, *message_files(spark, sf))
    calls = messages.filter("phase = 'begin'").selectExpr(
        "server_id", "transport_session_id AS session_key", "ts AS started",
        "get_json_object(params, '$.name') <> 'error' AS ok",
    )
    path = scratch_dir(spark, "stream-rollup")
    drain(build.session_rollup_stream(calls, span="1 day"), batch=sinks.snapshot_batch(path), mode="update")
    last = spark.read.parquet(path).groupBy("server_id", "session_key", "span").agg(
        *[F.max_by(n, "micro_batch").alias(n) for n in ("event_count", "ok_count", "error_count")]
    )
    return last.groupBy("server_id", "session_key").agg(
        *[F.sum(n).alias(n) for n in ("event_count", "ok_count", "error_count")]
    )


@register("stream_envelopes", f"""WITH {Q.LOG} SELECT sha256(actor || ' tool_call ' || {Q.uuid_of('server', 'epoch_us(t)', 'seq')}) AS event_id, 1 AS schema_version FROM paired""")
def stream_envelopes(spark, sf):
    """Envelopes written per micro-batch, read back as events."""
    taken, path = processed(spark, sf), scratch_dir(spark, "stream-envelopes")
    drain(build.tool_calls_stream(taken.call_stream(), OPTIONS), batch=sinks.envelope_batch(path))
    documents = spark.read.parquet(path).filter("event_count > 0").select("body")
    return unpack_envelopes(documents).select("event_id", "schema_version")


@register("stream_client_enrichment", f"WITH {Q.LOG} SELECT seq AS source_seq, server AS server_id, b_client AS client_name FROM paired")
def stream_client_enrichment(spark, sf):
    """Client of each streamed call, out of the starts that the state remembers."""
    return processed(spark, sf).calls().select("source_seq", "server_id", F.col("client.name").alias("client_name"))


@register("stream_equals_batch", f"""WITH {Q.LOG} SELECT server AS server_id, count(*) AS calls, count(*) AS streamed, 0 AS different FROM paired GROUP BY ALL""")
def stream_equals_batch(spark, sf):
    """Calls of the batch job and of the stream by server, and rows that only one of them has."""
    columns = ["server_id", "session_id", "source_seq", "tool_name"]
    streamed = processed(spark, sf).calls().select(columns)
    batch = pair_calls(V.messages(spark, sf), OPTIONS).calls.select(columns)
    different = quality.table_difference(streamed, batch).select("server_id", F.lit("different").alias("what"))
    rows = batch.select("server_id", F.lit("calls").alias("what")).unionByName(
        streamed.select("server_id", F.lit("streamed").alias("what"))).unionByName(different)
    return rows.groupBy("server_id").agg(
        *[F.count_if(F.col("what") == w).alias(w) for w in ("calls", "streamed", "different")]
    )

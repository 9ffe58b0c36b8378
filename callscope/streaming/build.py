"""Streams of events and finished calls; `keyed.py` pairs the message log itself.

State is bounded by watermarks. What a watermark has already let go may
come once more; ids are stable, so the event table drops the copy.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.assemble import build_tool_calls
from callscope.options import BuildOptions


def dedup_stream(events: DataFrame, ts: str = "recorded_at", delay: str = "10 minutes") -> DataFrame:
    """Drop repeated event ids that arrive within the watermark delay."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["server_id", "event_id"])


def tool_calls_stream(
    calls: DataFrame, options: BuildOptions, owned: DataFrame | None = None
) -> DataFrame:
    """`tool_call` events of a stream of finished calls; needs no state."""
    return build_tool_calls(calls, options, owned)


def session_rollup_stream(calls: DataFrame, delay: str = "10 minutes", span: str | None = None) -> DataFrame:
    """Running counts per session, for update output.

    With `span`, counts are per session and span of time, and the watermark lets a span go
    once it has passed; the table of their last snapshots sums up to whole sessions. Without
    it the state keeps one row for each session seen.
    """
    rows = calls.filter(F.col("session_key") != "").withWatermark("started", delay)
    keys = ["server_id", "session_key", *([F.window("started", span).alias("span")] if span else [])]
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_if("ok").alias("ok_count"),
        F.count_if(~F.col("ok")).alias("error_count"),
        F.min("started").alias("first_at"),
        F.max("started").alias("last_at"),
    )

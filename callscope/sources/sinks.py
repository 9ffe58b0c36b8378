"""Event tables and envelopes written out, and user sinks."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.envelopes import pack_envelopes
from callscope.operators.ordered import HOT_ROWS


def write_events(events: DataFrame, path: str, mode: str = "append") -> None:
    """Event table laid out by day and kind, so that ranges and kinds prune files.

    Rows are dealt out by day and kind first, in parts of the advisory size, so that a
    task writes few files and a hot day is split.
    """
    dealt = events.withColumn("day", F.to_date(F.to_timestamp("started_at"))).hint("rebalance", F.col("day"), F.col("kind"))
    dealt.write.mode(mode).partitionBy("day", "kind").parquet(path)


def write_envelopes(
    events: DataFrame, path: str, size: int = 20, mode: str = "append", hot_rows: int | None = HOT_ROWS
) -> None:
    """Envelope documents, one per line."""
    pack_envelopes(events, size, hot_rows).select("body").write.mode(mode).text(path)


def emit_to(
    events: DataFrame, emit: Callable[[str], None], size: int = 20, hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Hand each envelope document to `emit` on the executors; the failed ones come back.

    A failure never stops the others. The result has one row per failed envelope, with
    its error, and is evaluated by whoever writes it.
    """
    packed = pack_envelopes(events, size, hot_rows).select("server_id", "batch", "event_count", "body")

    def send(batches):
        for frame in batches:
            errors = []
            for body in frame["body"]:
                try:
                    emit(body)
                    errors.append(None)
                except Exception as error:
                    errors.append(f"{type(error).__name__}: {error}")
            frame = frame.assign(error=errors)
            yield frame[frame["error"].notna()]

    schema = "server_id string, batch bigint, event_count bigint, body string, error string"
    return packed.mapInPandas(send, schema)

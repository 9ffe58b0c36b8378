"""Sinks of streaming queries, idempotent per micro-batch."""

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from callscope.operators.envelopes import pack_envelopes
from callscope.operators.ordered import HOT_ROWS


def start(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    """Start a query into parquet files, or into a function on each micro-batch."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if available_now:
        writer = writer.trigger(availableNow=True)
    if batch is not None:
        return writer.foreachBatch(batch).start()
    return writer.format("parquet").option("path", path).start()


def envelope_batch(path: str, size: int = 20, hot_rows: int | None = HOT_ROWS) -> Callable[[DataFrame, int], None]:
    """Write the envelopes of a micro-batch below its number, so a replay overwrites it.

    A micro-batch may be a whole log, and its servers are few: events are made once by all tasks and
    numbered by narrow rows, unless `hot_rows` is None, for small ones.
    """

    def write(events: DataFrame, batch_id: int) -> None:
        target = os.path.join(path, f"micro_batch={batch_id}")
        pack_envelopes(events, size, hot_rows, once=hot_rows is not None).write.mode("overwrite").parquet(target)

    return write


def snapshot_batch(path: str) -> Callable[[DataFrame, int], None]:
    """Write the changed rows of an update-mode query below the micro-batch number."""

    def write(rows: DataFrame, batch_id: int) -> None:
        target = os.path.join(path, f"micro_batch={batch_id}")
        rows.write.mode("overwrite").parquet(target)

    return write

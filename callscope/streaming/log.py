"""Tables of a message log that arrives as a stream, equal to those of the batch job.

Two streaming queries with checkpoints of their own: one pairs the log over keyed state
(`keyed.observe`) into the table `decided`, the other picks the first sighting of each session and
identity out of it. Calls, events and late rows are views of these tables; `call_stream` reads them
as a stream again. Both queries resume where they stopped, and their sinks hold each
micro-batch once.
"""

import os
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from callscope import schemas as S
from callscope.operators.assemble import START_COLUMNS, build_session_events, build_tool_calls
from callscope.operators.ordered import dealt
from callscope.options import BuildOptions
from callscope.streaming import keyed, sinks


def end_of_log(spark: SparkSession, messages: DataFrame, options: BuildOptions, delay: int) -> DataFrame:
    """One row that moves the watermark past all of `messages`, or to `as_of` where that is given.

    It closes a connection that does not exist. A log that goes on needs none: its later rows
    move the time.
    """
    row = messages.agg(F.max("ts").alias("last"), F.lit(options.as_of).cast("timestamp").alias("as_of")).first()
    last = max((t for t in (row.last, row.as_of) if t is not None), default=None)
    if last is None:
        return spark.createDataFrame([], S.MESSAGE_SCHEMA)
    given = {"seq": 0, "ts": last + timedelta(seconds=delay, milliseconds=1), "phase": "close"}
    return spark.createDataFrame([tuple(given.get(f.name) for f in S.MESSAGE_SCHEMA)], S.MESSAGE_SCHEMA)


class LogTables:
    """The tables of one log below `folder`, and the queries that write them."""

    def __init__(
        self, spark: SparkSession, folder: str, options: BuildOptions | None = None,
        delay: int = 600, owned: DataFrame | None = None, forget_after: int | None = None,
    ):
        """`delay` and `forget_after` in seconds; see `keyed`."""
        self.spark, self.folder, self.options = spark, folder, options or BuildOptions()
        self.delay, self.owned, self.forget_after = delay, owned, forget_after

    def _path(self, *name: str) -> str:
        return os.path.join(self.folder, *name)

    def start(self, messages: DataFrame, available_now: bool = True) -> StreamingQuery:
        """Pair a stream of messages into the table `decided`."""
        decided = keyed.observe(messages, self.options, f"{self.delay} seconds", self.forget_after)
        return sinks.start(decided, self._path("checkpoints", "decided"), path=self._path("decided"), available_now=available_now)

    def start_sessions(self, available_now: bool = True) -> StreamingQuery:
        """Write the session starts and identities that the table `decided` holds or gets."""
        decided = self._decided(streaming=True)
        calls = keyed.decided_calls(decided, self.options).select(*START_COLUMNS, F.lit(False).alias("explicit"))
        starts = keyed.decided_starts(decided, self.options).select(*START_COLUMNS, "explicit")
        firsts = keyed.first_of_each_stream(calls.unionByName(starts), self.forget_after)
        return sinks.start(build_session_events(firsts), self._path("checkpoints", "sessions"), path=self._path("sessions"), available_now=available_now)

    def _decided(self, streaming: bool = False) -> DataFrame:
        reader = self.spark.readStream if streaming else self.spark.read
        return reader.schema(keyed.DECIDED).parquet(self._path("decided"))

    def call_stream(self) -> DataFrame:
        """Finished calls as a stream of their own, its micro-batches dealt out by rows, as in `events`."""
        decided = self._decided(streaming=True)
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), self.spark.sparkContext.defaultParallelism)
        return keyed.decided_calls(decided.repartition(tasks, "server_id", "seq"), self.options)

    def calls(self) -> DataFrame:
        return keyed.decided_calls(self._decided(), self.options)

    def session_events(self) -> DataFrame:
        schema = build_session_events(self.spark.createDataFrame([], keyed.FIRSTS)).schema
        return self.spark.read.schema(schema).parquet(self._path("sessions"))

    def events(self) -> DataFrame:
        """The whole event table; `disabled` exports nothing.

        Files of equal bytes hold rows of very different numbers, and an event costs the same: they are dealt out by rows.
        """
        decided = self._decided()
        calls = keyed.decided_calls(dealt(decided, ["server_id", "seq"], decided.count()), self.options)
        events = self.session_events().unionByName(build_tool_calls(calls, self.options, self.owned))
        return events.filter("false") if self.options.disabled else events

    def late(self) -> DataFrame:
        """Rows that came after their time was decided, or without a time."""
        return self._decided().filter("kind = 'late'").select("server_id", "seq", F.timestamp_micros("micros").alias("ts"))

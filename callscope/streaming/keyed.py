"""The message log as a stream over keyed state: pairing, clients, sessions and identities.

`observe` keeps, in Spark's state store, the rows that the watermark has not passed yet and, for each
connection, the requests without an answer and the client in force. A timer at the earliest
waiting row lets a micro-batch decide the rows its watermark has passed, in their order, so that
answers pair once and starts are those of the batch job, however the log was cut into
micro-batches. An agenda by minute ends requests that were never answered, and forgets.

Connections share the keys of the store (`buckets`): their waiting rows lie in one list, which holds
the rows of the delay alone, and each connection's state is an entry of one map. A micro-batch
reads the map in one go as far as a few entries for each connection that it decides something for, and asks
for those it did not meet one by one. So its work follows what it decides, however many others there are. The
entries themselves lie in `Pages` of some dozens, whose number grows with them: a call moves a page, and what a
micro-batch changed is written once a page.

Rows cross into Python, wait there and come back in packs (`packed_rows`), compressed on the way in, since a
processor pays for every column of each of its rows and the store for every byte.

`first_of_each_stream` keeps one mark for each session and identity that was sent, in buckets as well.

Rows that come after their time was decided, or without a time, are handed out as `late`. State
is bounded by `forget_after`: what was not touched for so long is dropped.

A connection is decided by one task, as its order demands.
"""

import json
import sys
import zlib
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callscope import schemas as S
from callscope.functions import ids
from callscope.functions.text import blank_to_null, trim_space
from callscope.operators.assemble import START_COLUMNS, session_roles
from callscope.operators.pairing import (
    INITIALIZE,
    REQUEST_COLUMNS,
    TOOLS_CALL,
    analytics_session_id,
    client_info,
    finish_call,
    prepare_messages,
    sighting_rows,
)
from callscope.options import HOOKS, BuildOptions

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

DECIDED = (
    "server_id string, kind string, micros bigint, seq bigint, begun_micros bigint, begun_seq bigint, request string, row string, "
    "client string, session_id string"
)
_DECIDED = Row("decided")
#: Rows of a pack that leaves a processor; rows and characters that a task packs at once before one enters.
_PACK, _HELD_ROWS, _HELD_TEXT = 256, 50_000, 1 << 24
#: Entries read at once for each connection that is asked for: a call for one costs as much as many of them.
_AT_ONCE = 4
#: A row that waits: its connection, its place, what it is, and its columns as JSON; in a pack all are texts.
_FIELDS = ["server_id", "connection", "micros", "seq", "what", "request_id", "client", "own_id", "session", "fallback", "row"]
#: Entries of a page; one that gets more makes a bucket double its pages.
_PAGE = 64
_MINUTE = 60_000_000
#: Columns of the log that requests, answers and starts need.
_COLUMNS = [
    "params", "result", "error", "error_type", "capability_provenance", "headers", "actor_seed", "identifier", "context_telemetry",
]
_ROW = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.MESSAGE_SCHEMA if f.name in _COLUMNS)


def use_state_store(spark) -> None:
    """Keyed state with timers needs RocksDB; its changes are saved, not whole snapshots."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class Connection:
    """What is known of one connection, and how its rows are decided in order."""

    def __init__(self, options: dict, known: tuple | None):
        """`options`: keep_first_client, abandon and forget (microseconds or None)."""
        self.keep_first_client, self.abandon, self.forget = options["keep_first_client"], options["abandon"], options["forget"]
        begun, self.client, self.remembered, self.started, self.touched = known or (None, None, None, False, None)
        #: By request id: (micros, seq, row, client, session_id).
        self.begun: dict[str, list] = json.loads(begun) if begun else {}
        self.out: list[tuple] = []

    def known(self) -> tuple | None:
        """What has to be kept, None if nothing has."""
        if not (self.begun or self.client or self.remembered or self.started):
            return None
        touched = None if self.forget is None else self.touched
        return json.dumps(self.begun) if self.begun else None, self.client, self.remembered, bool(self.started), touched

    def decide(self, rows: list[list]) -> None:
        for row in rows:
            self._decide(*row)
            self.touched = row[0]

    def let_go(self, passed: int) -> None:
        """End the requests that are past their time, and forget what was not touched for long."""
        for request_id, request in list(self.begun.items()):
            if self.abandon is not None and request[0] + self.abandon <= passed:
                self._show("abandoned", request[0] + self.abandon, request[1], request=request)
                del self.begun[request_id]
            elif self.forget is not None and request[0] + self.forget <= passed:
                del self.begun[request_id]
        if self.forget is not None and self.touched is not None and self.touched + self.forget <= passed:
            self.client, self.remembered, self.started = None, None, False

    def ends_at(self) -> int | None:
        """When something here is past its time."""
        horizons = [h for h in (self.abandon, self.forget) if h is not None]
        times = [request[0] + min(horizons) for request in self.begun.values()] if horizons else []
        if self.forget is not None and self.touched is not None and (self.client or self.remembered or self.started):
            times.append(self.touched + self.forget)
        return min(times, default=None)

    def _decide(self, micros, seq, what, request_id, info, own_id, session, fallback, row) -> None:
        if what == "close":
            self.client, self.remembered, self.started = None, None, False
        elif what == "lone start":
            self._show("start", micros, seq, row=row, session=session if session is not None else fallback or "")
        elif what == "start":
            opens, self.started = not self.started, True
            self.remembered = self.remembered or own_id
            self.client = (self.client or info) if self.keep_first_client else (info or self.client)
            if opens:
                self._show("start", micros, seq, row=row, session=self._session(session, fallback))
        elif what == "begin":
            self.begun[request_id] = [micros, seq, row, self.client, self._session(session, fallback)]
        elif request_id in self.begun:
            self._show(what, micros, seq, row=row, request=self.begun.pop(request_id))

    def _session(self, session, fallback) -> str:
        return session if session is not None else self.remembered or fallback or ""

    def _show(self, kind, micros, seq, row=None, request=None, session=None) -> None:
        if request is None:
            self.out.append((kind, micros, seq, None, None, None, row, None, session))
        else:
            began, began_seq, asked, client, session = request
            self.out.append((kind, micros, seq, began, began_seq, asked, row, client, session))


def packed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (`bucket`, `micros`, `row`) as packs: `bucket`, their earliest time `low`, and `pack`, a compressed JSON list.

    A pack with a row without time has no `low`. A task holds few rows at once, whatever its part of the log.
    """
    names, held, rows, size = ["bucket", "low", "pack"], {}, 0, 0

    def packs() -> pa.RecordBatch:
        lows = [None if None in times else min(times) for times, _ in held.values()]
        made = [_compressed(f"[{','.join(texts)}]") for _, texts in held.values()]
        return pa.record_batch([pa.array(list(held), pa.int64()), pa.array(lows, pa.int64()), pa.array(made, pa.binary())], names)

    for batch in batches:
        for bucket, micros, row in zip(*(column.to_pylist() for column in batch.columns)):
            times, texts = held.setdefault(bucket, ([], []))
            times.append(micros)
            texts.append(row)
            rows, size = rows + 1, size + len(row)
            if rows >= _HELD_ROWS or size >= _HELD_TEXT:
                yield packs()
                held, rows, size = {}, 0, 0
    if held:
        yield packs()


def _compressed(text: str) -> bytes:
    return zlib.compress(text.encode(), 1)


def unpacked(pack: bytes) -> list[list]:
    """The rows of a pack, their places as numbers again."""
    rows = json.loads(zlib.decompress(pack))
    for row in rows:
        row[2:4] = [None if value is None else int(value) for value in row[2:4]]
    return rows


def in_packs(rows: Iterator[tuple]) -> Iterator[Row]:
    """Decided rows in packs, as a processor hands them out."""
    while pack := list(islice(rows, _PACK)):
        yield _DECIDED(pack)


def entries_of(state, names: dict[tuple, object]) -> dict[tuple, tuple | None]:
    """The entries of a map of the store under these names, read in one go as far as a few for each of them."""
    read, found = 0, dict.fromkeys(names)
    most = _AT_ONCE * len(names)
    for name, value in islice(state.iterator(), most):
        read += 1
        if tuple(name) in found:
            found[tuple(name)] = value
    if read < most:
        return found
    return {name: state.getValue(name) if value is None else value for name, value in found.items()}


#: Columns of the store that `Pages` use: their map, and the number of its pages as bits.
_PAGED, _SIZE = ("page bigint", "entries binary"), "bits int"


class Pages:
    """A map of texts to values whose entries share the entries of a map of the store (`_PAGED`).

    A call to the store costs as much as dozens of entries, so these lie in pages by a hash of their names. Pages
    that were read stay until `save`, which writes those that changed. There are as many pages, a power of two kept in
    `size` (`_SIZE`), as leave `_PAGE` entries to one at most, so an entry costs the same however many others there are.
    With `ttl` in milliseconds an entry ends that long after `now` when it was set.
    """

    def __init__(self, store, size, ttl: int | None = None):
        self.store, self.size, self.ttl, self.now = store, size, ttl, None
        self._bits, self._read, self._changed = None, {}, set()

    def getValue(self, name: tuple) -> tuple | None:
        return self._page(self._number(name)).get(tuple(name), (None,))[0]

    def iterator(self) -> Iterator[tuple[tuple, tuple]]:
        for (number,), (page,) in self.store.iterator():
            if number not in self._read:
                self._read[number] = self._unpacked(page)
            yield from ((name, value) for name, (value, _) in self._read[number].items())

    def updateValue(self, name: tuple, value: tuple) -> None:
        number = self._number(name)
        self._page(number)[tuple(name)] = (tuple(value), None if self.ttl is None else self.now + self.ttl)
        self._changed.add(number)

    def removeKey(self, name: tuple) -> None:
        number = self._number(name)
        if self._page(number).pop(tuple(name), None) is not None:
            self._changed.add(number)

    def save(self) -> None:
        """Write what changed; the next call reads anew."""
        if any(len(self._read[number]) > _PAGE for number in self._changed):
            self._grow()
        for number in sorted(self._changed):
            if page := self._read[number]:
                self.store.updateValue((number,), (_compressed(json.dumps([[name, *held] for name, held in page.items()])),))
            else:
                self.store.removeKey((number,))
        self._bits, self._read, self._changed = None, {}, set()

    def _grow(self) -> None:
        """Deal all entries out over so many pages that none has too many."""
        for _ in self.iterator():
            pass
        entries, gone = {n: v for page in self._read.values() for n, v in page.items()}, set(self._read)
        while self._bits < 32 and max(map(len, self._read.values())) > _PAGE:
            self._bits += 1
            self._read = {}
            for name, value in entries.items():
                self._read.setdefault(self._number(name), {})[name] = value
        self._read = {number: {} for number in gone} | self._read
        self._changed = set(self._read)
        self.size.update((self._bits,))

    def _number(self, name: tuple) -> int:
        if self._bits is None:
            there = self.size.get()
            self._bits = 0 if there is None else there[0]
        return zlib.crc32(json.dumps(list(name)).encode()) & ((1 << self._bits) - 1)

    def _page(self, number: int) -> dict:
        if number not in self._read:
            there = self.store.getValue((number,))
            self._read[number] = {} if there is None else self._unpacked(there[0])
        return self._read[number]

    def _unpacked(self, page: bytes) -> dict:
        held = json.loads(zlib.decompress(page))
        return {tuple(name): (tuple(value), until) for name, value, until in held if until is None or until > self.now}


class LogState(StatefulProcessor):
    """The connections of one bucket: rows wait for the watermark, then are decided in order."""

    def __init__(self, options: dict):
        self.options, self.pages, self.settled = options, None, None
        self.has_agenda = options["abandon"] is not None or options["forget"] is not None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "packs array<binary>")
        self.known = self.pages = Pages(handle.getMapState("known", *_PAGED), handle.getValueState("known_size", _SIZE))
        self.agenda = handle.getMapState("agenda", "minute bigint", "connections string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        return in_packs(self._taken(rows, timerValues.getCurrentWatermarkInMs() * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return in_packs(self._once(key, timerValues.getCurrentWatermarkInMs() * 1000))

    def _taken(self, packs: Iterator[Row], passed: int) -> Iterator[tuple]:
        """Keep the rows of these packs that are in time; the others are late."""
        kept, first = [], None
        for _, low, pack in packs:
            if low is None or low <= passed:
                own = []
                for r in unpacked(pack):
                    if r[2] is None or r[2] <= passed:
                        yield r[0], "late", r[2], r[3], None, None, None, r[10], None, None
                    else:
                        own.append(r)
                if not own:
                    continue
                low, pack = min(r[2] for r in own), _compressed(json.dumps(own))
            kept.append(pack)
            first = low if first is None else min(first, low)
        if kept:
            # One value for the rows of a micro-batch: a call to the store costs far more than a row.
            self.waiting.appendValue((kept,))
            self._wake(first)

    def _once(self, key, passed: int) -> Iterator[tuple]:
        """What is due for a bucket, at the first of its timers that a micro-batch lets expire."""
        if self.settled != (key, passed):
            yield from self._due(passed)
            self.pages.save()
            self.settled = (key, passed)

    def _due(self, passed: int) -> Iterator[tuple]:
        rows = [r for part in self.waiting.get() for pack in part[0] for r in unpacked(pack)]
        due = sorted((r for r in rows if r[2] <= passed), key=lambda r: r[:4])
        if due:
            later = [r for r in rows if r[2] > passed]
            if later:
                self.waiting.put([([_compressed(json.dumps(later))],)])
                self._wake(min(r[2] for r in later))
            else:
                self.waiting.clear()
        connections = {name: list(own) for name, own in groupby(due, key=lambda r: tuple(r[:2]))}
        known = self._known_of(connections)
        for name, own in connections.items():
            yield from self._settled(name, [r[2:] for r in own], passed, known[name])
        if self.has_agenda:
            for minute in sorted(m[0] for m in self.agenda.keys()):
                if minute * _MINUTE <= passed:
                    names = json.loads(self.agenda.getValue((minute,))[0])
                    self.agenda.removeKey((minute,))
                    for name in sorted({tuple(n) for n in names}):
                        yield from self._settled(name, [], passed, self.known.getValue(name))

    def _known_of(self, names: dict[tuple, list]) -> dict[tuple, tuple | None]:
        """What is known of these connections."""
        return entries_of(self.known, names)

    def _settled(self, name: tuple, rows: list[list], passed: int, before: tuple | None) -> Iterator[tuple]:
        """Decide rows of one connection, end what is past its time, and keep the rest. `before`: what was known of it."""
        before = None if before is None else tuple(before)
        one = Connection(self.options, before)
        ended = one.ends_at()
        one.decide(rows)
        one.let_go(passed)
        after = one.known()
        if after is None:
            if before is not None:
                self.known.removeKey(name)
        elif after != before:
            self.known.updateValue(name, after)
        ends = one.ends_at() if after is not None else None
        if ends is not None and (ends != ended or not rows):
            self._enter(-(-ends // _MINUTE), name)
        for shown in one.out:
            yield name[0], *shown

    def _enter(self, minute: int, name: tuple) -> None:
        """A connection comes up again in that minute."""
        there = self.agenda.getValue((minute,))
        names = json.loads(there[0]) if there is not None else []
        self.agenda.updateValue((minute,), (json.dumps([*names, list(name)]),))
        if not names:
            self._wake(minute * _MINUTE)

    def _wake(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def close(self) -> None:
        pass


def _narrow(messages: DataFrame, options: BuildOptions, delay: str) -> DataFrame:
    """Rows for the state: what they are, what is known without memory, the rest as JSON.

    The watermark is that of the whole log, so any row moves it on. Its column itself stays
    behind: rows that are late reach the state, which hands them out.
    """
    rows = prepare_messages(messages.withWatermark("ts", delay), options)
    hooks = options.adapter == HOOKS
    lone = blank_to_null("transport_session_id").isNull() & blank_to_null("connection_id").isNull()
    is_start = F.col("method").eqNullSafe(INITIALIZE) & (F.col("phase") == "end")
    is_call = F.col("method").eqNullSafe(TOOLS_CALL)
    own_id = analytics_session_id(options.adapter, options.session_header, F.lit(None).cast("string"))
    if hooks:
        session, fallback = F.coalesce(own_id, F.lit("")), F.lit(None).cast("string")
    else:
        header = blank_to_null(trim_space(ids.header("headers", options.session_header)))
        without = F.when(F.col("headers").isNull(), F.col("process_id"))
        session, fallback = blank_to_null("transport_session_id"), F.coalesce(header, without)
    # A lone start opens a session of its own with middleware; with hooks it counts as any other.
    start = F.when(lone & F.lit(not hooks), "lone start").otherwise("start")
    return rows.select(
        "server_id", "connection", F.unix_micros("ts").alias("micros"), "seq",
        F.when(F.col("phase") == "close", "close").when(is_start, start).when(is_call, F.col("phase")).alias("what"),
        "request_id",
        F.when(is_start & ~lone, F.to_json(client_info(F.col("params"), options.adapter))).alias("client"),
        F.when(is_start & ~lone, blank_to_null(own_id)).alias("own_id"),
        session.alias("session"), fallback.alias("fallback"),
        F.to_json(F.struct(*_COLUMNS)).alias("row"),
    )


def observe(
    messages: DataFrame, options: BuildOptions, delay: str = "10 minutes", forget_after: int | None = None, buckets: int | None = None
) -> DataFrame:
    """Decided rows of a stream of messages: pairs (`end`, `cancel`, `abandoned`), `start`, `late`.

    `buckets`, eight for each shuffle partition by default, must stay as it is for the life of a
    checkpoint.
    """
    spark = messages.sparkSession
    use_state_store(spark)
    given = {"keep_first_client": options.adapter != HOOKS} | {
        name: None if seconds is None else seconds * 1_000_000 for name, seconds in (("abandon", options.abandon_after), ("forget", forget_after))
    }
    count = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _narrow(messages, options, delay).select(
        F.pmod(F.xxhash64("server_id", "connection"), F.lit(count)).alias("bucket"), "micros",
        F.to_json(F.array(*[F.col(name).cast("string") for name in _FIELDS])).alias("row"),
    )
    packs = rows.mapInArrow(packed_rows, "bucket bigint, low bigint, pack binary")
    decided = packs.groupBy("bucket").transformWithState(LogState(given), f"decided array<struct<{DECIDED}>>", "Append", "EventTime")
    return decided.select(F.inline("decided"))


def decided_pairs(decided: DataFrame) -> DataFrame:
    """Paired messages out of decided rows, in the form `finish_call` reads."""
    pairs = decided.filter(F.col("kind").isin("end", "cancel", "abandoned")).withColumns({
        "began": F.from_json("request", _ROW), "answer": F.from_json("row", _ROW), "client": F.from_json("client", S.CLIENT_SCHEMA),
    })
    given = {"ts": F.timestamp_micros("begun_micros"), "seq": F.col("begun_seq"), "client": F.col("client"), "session_id": F.col("session_id")}
    return pairs.select(
        "server_id", "seq", F.timestamp_micros("micros").alias("ts"),
        F.when(F.col("kind") == "end", "end").otherwise("cancel").alias("phase"),
        *[F.col(f"answer.{c}").alias(c) for c in ("result", "error", "error_type")],
        # An abandoned request has no answer to carry the mark; its own counts.
        F.when(F.col("kind") == "abandoned", F.col("began.capability_provenance")).otherwise(F.col("answer.capability_provenance")).alias("capability_provenance"),
        *[given.get(c, F.col(f"began.{c}")).alias(f"prev_{c}") for c in REQUEST_COLUMNS],
    )


def decided_calls(decided: DataFrame, options: BuildOptions) -> DataFrame:
    """`CALL_SCHEMA` rows of decided rows, of a table or a stream."""
    return finish_call(decided_pairs(decided), options)


def decided_starts(decided: DataFrame, options: BuildOptions) -> DataFrame:
    """The starts that open a session, as sightings."""
    starts = decided.filter("kind = 'start'").withColumn("row", F.from_json("row", _ROW)).select(
        "server_id", "seq", F.timestamp_micros("micros").alias("ts"), "session_id", F.lit(True).alias("opens_session"), "row.*"
    )
    return sighting_rows(starts, options, only_starts=True)


#: What a session start or identity is built from.
FIRSTS = T.StructType([
    *[f for f in S.CALL_SCHEMA if f.name in START_COLUMNS],
    T.StructField("explicit", T.BooleanType()), *[T.StructField(n, T.StringType()) for n in ("actor_id", "role", "about")],
])


_KEY = "server_id string, actor_id string, role string, about string"
_FIRST = f"{_KEY}, micros bigint, seq bigint, row string"
_FIRST_PACK = Row("firsts")


def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (`bucket`, key, `micros`, `seq`, `row`) the first of each key in a task, as packs (`bucket`, `pack`).

    A task holds few keys at once, whatever its part of the log; a key may come in several packs.
    """
    held, size = {}, 0

    def packs() -> pa.RecordBatch:
        buckets = {}
        for (bucket, *key), first in held.items():
            buckets.setdefault(bucket, []).append([*key, *first])
        made = [_compressed(json.dumps(rows)) for rows in buckets.values()]
        return pa.record_batch([pa.array(list(buckets), pa.int64()), pa.array(made, pa.binary())], ["bucket", "pack"])

    for batch in batches:
        for *key, micros, seq, row in zip(*(column.to_pylist() for column in batch.columns)):
            key, there = tuple(key), held.get(tuple(key))
            if there is None or (micros, seq) < there[:2]:
                held[key] = (micros, seq, row)
                size += len(row) if there is None else 0
            if len(held) >= _HELD_ROWS or size >= _HELD_TEXT:
                yield packs()
                held, size = {}, 0
    if held:
        yield packs()


class FirstOfKey(StatefulProcessor):
    """Lets the first row of each key of a bucket pass, by its place; later ones find the mark and end here."""

    def __init__(self, forget_after: int | None):
        self.ttl, self.pages = None if forget_after is None else forget_after * 1000, None

    def init(self, handle: StatefulProcessorHandle) -> None:
        # A page ends when none of its marks was set for so long; a mark in a page that goes on ends by itself.
        store = handle.getMapState("sent", *_PAGED, self.ttl)
        self.sent = self.pages = Pages(store, handle.getValueState("sent_size", _SIZE), self.ttl)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.ttl is not None:
            self.pages.now = timerValues.getCurrentProcessingTimeInMs()
        firsts = {}
        for _, pack in rows:
            for *name, micros, seq, row in json.loads(zlib.decompress(pack)):
                name, place = tuple(name), (micros, seq, row)
                if name not in firsts or place[:2] < firsts[name][:2]:
                    firsts[name] = place
        sent = entries_of(self.sent, firsts)
        fresh = [(*name, *place) for name, place in firsts.items() if sent[name] is None]
        for row in fresh:
            self.sent.updateValue(row[:4], (True,))
        if self.pages is not None:
            self.pages.save()
        for start in range(0, len(fresh), _PACK):
            yield _FIRST_PACK(fresh[start:start + _PACK])

    def close(self) -> None:
        pass


def first_of_each_stream(sightings: DataFrame, forget_after: int | None = None, buckets: int | None = None) -> DataFrame:
    """The first sighting of each session and identity of a stream, as `first_of_each` of a table.

    A micro-batch must hold whole spans of time, as the output of `observe` does; the state is
    one mark for each session and identity, forgotten `forget_after` seconds after it was set. Tasks keep the
    first row of a key before they shuffle, and sessions share keys of the store in `buckets`, eight for each
    shuffle partition by default, which must stay as they are for the life of a checkpoint.
    """
    spark = sightings.sparkSession
    use_state_store(spark)
    each = session_roles(sightings.select(*START_COLUMNS, "explicit"))
    keys = ["server_id", "actor_id", "role", "about"]
    count = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = each.select(
        F.pmod(F.xxhash64(*keys), F.lit(count)).alias("bucket"), *keys, F.unix_micros("recorded_at").alias("micros"), F.col("source_seq").alias("seq"),
        F.to_json(F.struct(*[_as_json(each, c) for c in (*START_COLUMNS, "explicit") if c != "server_id"])).alias("row"),
    )
    packs = narrow.mapInArrow(first_rows, "bucket bigint, pack binary")
    mode = "None" if forget_after is None else "ProcessingTime"
    first = packs.groupBy("bucket").transformWithState(FirstOfKey(forget_after), f"firsts array<struct<{_FIRST}>>", "Append", mode).select(F.inline("firsts"))
    kinds = {f.name: f.dataType.simpleString() for f in FIRSTS if f.name in (*START_COLUMNS, "explicit") and f.name != "server_id"}
    row = F.from_json("row", ", ".join(f"{n} {'bigint' if k == 'timestamp' else k}" for n, k in kinds.items()))
    values = [(F.timestamp_micros(f"row.{n}") if k == "timestamp" else F.col(f"row.{n}")).alias(n) for n, k in kinds.items()]
    return first.withColumn("row", row).select("server_id", *values, "actor_id", "role", "about")


def _as_json(df: DataFrame, name: str):
    """A column as JSON holds it: times as microseconds."""
    return F.unix_micros(name).alias(name) if dict(df.dtypes)[name] == "timestamp" else F.col(name)


# The runner that prepares a processor on the driver does not see the files added to the session,
# so the processors travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Substring de-duplication by recompression.

Removes every word covered by a window of `WINDOW` consecutive words that also starts earlier,
in a document with a smaller doc_id or earlier in the same one.

Recompression: a text's words are named by hashes. The first round names runs of one word; each
round then parts all names in a left and a right half, by a hash that is the same everywhere, and
names each pair of a left name and a right name that follows it. A name is a hash of what it
stands for, so that names are global, and whether a pair is made depends on its two names alone.
Equal windows therefore have equal symbols inside; every symbol carries the stretch of words its
making depended on, and a window counts the symbols whose stretch lies inside it. A window looks
at the highest level that has such a symbol, down to its words.

1. Symbols of the levels that windows look at are counted over all documents. (Spark)
2. A window all of whose symbols also occur in another document is a candidate; the smallest
   doc_id is found for the hash of each candidate's words, which verifies the repeat. (Spark)
3. A candidate whose smallest doc_id is another document's starts earlier there; within one
   document the first of equal windows stays.
4. A text that is equal to one with a smaller doc_id is one repeat as a whole: all its windows
   start earlier there, so they need not be looked up.

Scale: far fewer symbols than words are shuffled, counts and minima are pre-aggregated, and a hot
symbol or window is one row a task. What returns to a document are its own shared symbols and
the windows it owns, at most as many as its words. Texts cross the network once. Symbol names
that collide only make candidates; windows are told apart by 80 bits.

Cases: null and empty texts have no words; texts under `WINDOW` words keep all of them. A null
doc_id is the smallest. Rows that share a doc_id are one place in the order: neither is earlier than the
other. An empty table gives an empty table; extra columns are ignored.
"""

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import MIN_LONG, pieces, read_table, shuffle_partitions
from callscope.llm.registry import register

WINDOW = 20
ROUNDS = 5
#: Symbol names are cut to as many bits; a chance match only makes a candidate.
NAME_BITS = 48

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as were needed so far."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up[:n], cls.down[:n]


def _stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each stretch of `values`."""
    up, down = _Powers.of(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return (sums[ends] - sums[starts]) * down[starts]


class Words:
    """The words of some texts: a hash of each, and where each text's begin."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).astype(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        raw = _stretches(data.astype(np.uint64) + _U(1), starts, ends)
        self.hash = _mix(raw + (ends - starts).astype(np.uint64) * _U(0x165667B19E3779F9))
        bounds = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate(([0], np.searchsorted(starts, bounds)))
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a window starts at each word, and two hashes of each window (64 and 16 bits)."""
        n = len(self.hash)
        fits = np.zeros(n, dtype=bool)
        if n >= WINDOW:
            fits[:n - WINDOW + 1] = self.doc[:n - WINDOW + 1] == self.doc[WINDOW - 1:]
        starts = np.flatnonzero(fits)
        hashes = np.zeros((2, n), dtype=np.uint64)
        hashes[0, starts] = _mix(_stretches(self.hash, starts, starts + WINDOW))
        hashes[1, starts] = _mix(_stretches(_mix(self.hash + _U(7)), starts, starts + WINDOW)) >> _U(48)
        return fits, hashes


class Level:
    """Symbols in order: name, document, and the stretch of words each one depends on."""

    def __init__(self, name, doc, low, high):
        self.name, self.doc, self.low, self.high = name, doc, low, high


_NEVER = 1 << 40


def _runs(level: Level) -> Level:
    """Runs of one name get a name of their own; the name before and the one after must differ."""
    n = len(level.name)
    opens = np.ones(n, dtype=bool)
    opens[1:] = (level.name[1:] != level.name[:-1]) | (level.doc[1:] != level.doc[:-1])
    at = np.flatnonzero(opens)
    last = np.append(at[1:], n) - 1
    length = last - at + 1
    name = np.where(length > 1, _mix(level.name[at] + length.astype(np.uint64) * _U(0x9FB21C651E98DF25)), level.name[at])
    doc = level.doc[at]
    low, high = level.low[at].copy(), level.high[last].copy()
    inside = np.zeros(len(at) + 1, dtype=bool)
    inside[1:-1] = doc[1:] == doc[:-1]
    before, after = inside[:-1], inside[1:]
    low = np.where(before, low - 1, -_NEVER)
    high = np.where(after, high + 1, _NEVER)
    return Level(name, doc, low, high)


def _pairs(level: Level, turn: int) -> Level:
    """Pairs of a left name and a right name after it get a name; the others depend on their neighbour."""
    n = len(level.name)
    right = (_mix(level.name + _U(0x100000001B3 * (turn + 1))) >> _U(63)).astype(bool)
    same = np.zeros(n + 1, dtype=bool)  # whether a neighbour stands before place i
    same[1:n] = level.doc[1:] == level.doc[:-1]
    opens = np.zeros(n, dtype=bool)  # first of a pair
    opens[:-1] = ~right[:-1] & right[1:] & same[1:n]
    closes = np.zeros(n, dtype=bool)
    closes[1:] = opens[:-1]
    low, high = level.low.copy(), level.high.copy()
    # A left name alone was not followed by a right one, a right name alone not preceded by a left one.
    alone = ~opens & ~closes
    for side, step in ((alone & ~right, 1), (alone & right, -1)):
        at = np.flatnonzero(side)
        near = same[at + 1] if step == 1 else same[at]
        lone, at = at[~near], at[near]
        low[at] = np.minimum(low[at], level.low[at + step])
        high[at] = np.maximum(high[at], level.high[at + step])
        (high if step == 1 else low)[lone] = _NEVER * step
    first = np.flatnonzero(opens)
    low[first] = np.minimum(low[first], low[first + 1])
    high[first] = np.maximum(high[first], high[first + 1])
    name = level.name.copy()
    name[first] = _mix(_mix(level.name[first]) * _U(3) + level.name[first + 1])
    keep = ~closes
    return Level(name[keep], level.doc[keep], low[keep], high[keep])


def levels(words: Words, rounds: int = ROUNDS) -> list[Level]:
    """The words, then the symbols after each round."""
    place = np.arange(len(words.hash), dtype=np.int64)
    out = [Level(words.hash, words.doc, place, place + 1)]
    for turn in range(rounds if len(place) else 0):
        out.append(_pairs(_runs(out[0]) if not turn else out[-1], turn))
    return out


class Symbols:
    """The symbols each window looks at, for the texts of some words."""

    def __init__(self, words: Words):
        self.fits, self.hashes = words.windows()
        n = len(words.hash)
        open_windows = self.fits.copy()
        begin, end = words.first[:-1], words.first[1:]
        self.used = []
        for level in reversed(levels(words)):
            # Windows from a to b hold the symbol's stretch; b < a if none does.
            a = np.maximum(level.high - WINDOW, begin[level.doc])
            b = np.minimum(level.low, end[level.doc] - WINDOW)
            sums = np.concatenate(([0], np.cumsum(open_windows)))
            some = b >= a
            a, b, at = a[some], b[some], np.flatnonzero(some)
            wanted = sums[b + 1] > sums[a]
            a, b, at = a[wanted], b[wanted], at[wanted]
            names = (level.name[at] >> _U(64 - NAME_BITS)).astype(np.int64)
            seen = _covered(n, a, b) > 0
            self.used.append((names, level.doc[at], a, b, open_windows & seen))
            open_windows = open_windows & ~seen
            if not open_windows.any():
                break

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """(name, text), each once."""
        name = np.concatenate([u[0] for u in self.used])
        doc = np.concatenate([u[1] for u in self.used])
        order = np.lexsort((name, doc))
        name, doc = name[order], doc[order]
        new = np.ones(len(name), dtype=bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        return name[new], doc[new]

    def candidates(self, shared: list[np.ndarray]) -> np.ndarray:
        """Windows all of whose symbols are shared; `shared`: sorted names of each text."""
        out = self.fits.copy()
        sizes = np.array([len(s) for s in shared])
        if not sizes.any():
            return np.zeros_like(out)
        # Names of all texts in one sorted table, by text.
        table = np.concatenate(shared)
        owner = np.repeat(np.arange(len(shared)), sizes)
        table = table.astype(np.uint64) ^ _mix(owner.astype(np.uint64) + _U(1))
        table.sort()
        for names, doc, a, b, looked in self.used:
            keys = names.astype(np.uint64) ^ _mix(doc.astype(np.uint64) + _U(1))
            at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
            alone = table[at] != keys
            out &= ~(looked & (_covered(len(out), a[alone], b[alone]) > 0))
        return out


def _covered(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many of the stretches a to b, both included, hold each place."""
    steps = np.bincount(a, minlength=n + 1) - np.bincount(b + 1, minlength=n + 1)
    return np.cumsum(steps[:n])


def _encoded(column: pa.Array) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in column.to_pylist()]


def _grouped(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches in pieces of bounded size, with their texts."""
    for batch in batches:
        texts = _encoded(batch.column(text))
        for start, end in pieces([len(t) for t in texts]):
            yield batch.slice(start, end - start), texts[start:end]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.int64, copy=False))


def _symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(name, key) of the symbols that the windows of each document look at."""
    for batch, texts in _grouped(batches, 1):
        names, doc = Symbols(Words(texts)).names()
        keys = batch.column(0).to_numpy(zero_copy_only=False)[doc]
        yield pa.RecordBatch.from_arrays([_long(names), _long(keys)], ["name", "key"])


def _lists(column: pa.Array) -> list[np.ndarray]:
    """The sorted longs of each row; none where it is null."""
    values = column.values.to_numpy(zero_copy_only=False)
    offsets = column.offsets.to_numpy()
    return [np.sort(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _with_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have shared symbols."""
    for batch in batches:
        yield batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, c, key) of the candidate windows of each document, each once."""
    for batch, texts in _grouped(_with_shared(batches), 1):
        words = Words(texts)
        symbols = Symbols(words)
        at = np.flatnonzero(symbols.candidates(_lists(batch.column(2))))
        h, c, doc = symbols.hashes[0, at], symbols.hashes[1, at], words.doc[at]
        order = np.lexsort((c, h, doc))
        h, c, doc = h[order], c[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (doc[1:] != doc[:-1])
        keys = batch.column(0).to_numpy(zero_copy_only=False)[doc[new]]
        yield pa.RecordBatch.from_arrays([_long(h[new].view(np.int64)), pa.array(c[new].astype(np.int32)), _long(keys)], ["h", "c", "key"])


def _first_of_equals(h: np.ndarray, c: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which of the rows, in order, come first in their document with their hashes."""
    order = np.lexsort((np.arange(len(h)), c, h, doc))
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    first = np.ones(len(h), dtype=bool)
    first[order[same]] = False
    return first


def removed_words(texts: list[bytes], shared: list[np.ndarray], owned: list[tuple[np.ndarray, np.ndarray]]) -> tuple[Words, np.ndarray]:
    """Which words of the texts go; `owned`: the hashes (h, c) of the windows a text has first."""
    words = Words(texts)
    symbols = Symbols(words)
    go = np.zeros(len(words.hash), dtype=bool)
    at = np.flatnonzero(symbols.candidates(shared))
    if len(at):
        sizes = [len(h) for h, _ in owned]
        doc = np.repeat(np.arange(len(owned)), sizes)
        h = np.concatenate([h for h, _ in owned]).view(np.uint64)
        c = np.concatenate([c for _, c in owned]).astype(np.uint64)
        mine = words.doc[at]
        # Owned rows first: a candidate that is not the first of its equals is owned.
        lead = _first_of_equals(
            np.concatenate((h, symbols.hashes[0, at])), np.concatenate((c, symbols.hashes[1, at])), np.concatenate((doc, mine))
        )[len(h):]
        # Of candidates equal in one text only the first could be seen as not owned; all are, then.
        foreign = _spread(symbols.hashes[0, at], symbols.hashes[1, at], mine, lead)
        go[at[foreign]] = True
    starts = np.flatnonzero(symbols.fits)
    again = ~_first_of_equals(symbols.hashes[0, starts], symbols.hashes[1, starts], words.doc[starts])
    go[starts[again]] = True
    steps = np.zeros(len(go) + WINDOW + 1, dtype=np.int64)
    steps[:len(go)] += go
    steps[WINDOW:WINDOW + len(go)] -= go
    return words, np.cumsum(steps[:len(go)]) > 0


def _spread(h: np.ndarray, c: np.ndarray, doc: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """`marked` for all rows that equal a marked one."""
    order = np.lexsort((c, h, doc))
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    group = np.cumsum(new) - 1
    any_marked = np.zeros(group[-1] + 1, dtype=bool)
    np.logical_or.at(any_marked, group, marked[order])
    out = np.empty(len(h), dtype=bool)
    out[order] = any_marked[group]
    return out


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, number of words and of removed words, and the kept words joined by spaces."""
    for batch, texts in _grouped(batches, 1):
        at_h, at_c = _unsorted(batch.column(3)), _unsorted(batch.column(4))
        words, go = removed_words(texts, _lists(batch.column(2)), list(zip(at_h, at_c, strict=True)))
        n_words, n_removed, kept = [], [], []
        copies = batch.column(6).to_pylist()
        for i, text in enumerate(texts):
            mine = go[words.first[i]:words.first[i + 1]]
            if copies[i] and len(mine) >= WINDOW:
                mine = np.ones(len(mine), dtype=bool)
            n_words.append(len(mine))
            n_removed.append(int(mine.sum()))
            parts = text.split()  # bytes are split at ASCII white space
            kept.append(b" ".join(compress(parts, (~mine).tolist()) if n_removed[-1] else parts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(5), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )


def _unsorted(column: pa.Array) -> list[np.ndarray]:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _later_copies(docs: DataFrame) -> DataFrame:
    """(key, copies): digests of the texts that are, as a whole, the text of a smaller key."""
    texts = docs.filter("text IS NOT NULL").select("key", F.md5("text").alias("digest")).distinct()
    first = texts.groupBy("digest").agg(F.min("key").alias("first"))
    later = texts.join(first, "digest").filter("key > first")
    return later.groupBy("key").agg(F.collect_set("digest").alias("copies"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of `docs` (doc_id, text); kept is UTF-8."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("doc_id", F.lit(MIN_LONG)).cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    # Dealt out by document before they are listed: rows are smaller than lists of a few items.
    partitions = shuffle_partitions(docs.sparkSession)
    symbols = docs.select("key", "text").mapInArrow(_symbols, "name long, key long")
    shared = symbols.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1").select("name")
    by_doc = symbols.join(shared, "name").select("key", "name").repartition(partitions, "key").groupBy("key").agg(F.collect_list("name").alias("shared"))
    # Both uses of this table have the same columns and rows, so that its shuffles are reused.
    no_longs, no_ints = F.array().cast("array<long>"), F.array().cast("array<int>")
    copy = F.coalesce(F.array_contains("copies", F.md5("text")), F.lit(False))
    with_shared = docs.join(_later_copies(docs), "key", "left").join(by_doc, "key", "left").select(
        "key", "text", F.when(copy | F.col("shared").isNull(), no_longs).otherwise(F.col("shared")).alias("shared"), "doc_id", copy.alias("copy")
    )
    windows = with_shared.mapInArrow(_candidates, "h long, c int, key long")
    owners = windows.groupBy("h", "c").agg(F.min("key").alias("key"))
    owned = owners.select("key", "h", "c").repartition(partitions, "key").groupBy("key").agg(F.collect_list("h").alias("h"), F.collect_list("c").alias("c"))
    ready = with_shared.join(owned, "key", "left").select(
        "key", "text", "shared", F.coalesce("h", no_longs).alias("h"), F.coalesce("c", no_ints).alias("c"), "doc_id", "copy"
    )
    return ready.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept binary")


@register("op9_recompression")
def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return remove_repeats(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

"""Near duplicates: SimHash fingerprints, linked through pivot distance tables.

A fingerprint has 64 bits; a bit is set if it is set in over half of the XXH64 hashes of the
text's 3-word shingles. Two fingerprints are linked if at most `DISTANCE` bits differ. The query
returns components, `keep_one` one document of each; both use the same constants.

The search uses tables of Hamming distances to reference fingerprints (pivots):

1. The first table holds the distances to the origin and to the 64 one-bit references. Taken
   relative to the origin's, a coordinate shows one position of the fingerprint. The one-bit
   references fall into `SEGMENTS` groups; two fingerprints at most two bits apart differ in the
   coordinates of two groups at most, so that the coordinates of all other groups are equal.
   Every choice of two groups left out is a cell key, and linked fingerprints share a cell.
2. The second table holds the distances to `PIVOTS` spread references. By the triangle
   inequality a pair whose largest coordinate difference is above `DISTANCE` cannot be linked;
   such pairs of a cell are discarded.
3. Survivors are verified by the bits that differ.

Scale: equal fingerprints are one, whatever the number of copies, pre-aggregated before the
shuffle. A cell fixes all positions but those of two groups, so it holds at most 2^14 distinct
fingerprints, however large a cluster is; of the links in a cell only a spanning forest is
returned. Components are joined to the narrow table of fingerprints, never collected.

Cases: null and empty texts, or texts of white space, have fingerprint zero and are linked like
any other; texts of one or two words have one shingle, all of the text. A null doc_id is not a
candidate for component_id, which is null where no document of the component has an id. Repeated
rows share a fingerprint, hence a component. An empty table gives an empty table; extra columns
are ignored by the query and stay in `keep_one`, which for rows that agree in doc_id and text
keeps one of them.
"""

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, read_table, shuffle_partitions, spare_name
from callscope.llm.components import components
from callscope.llm.registry import register

SHINGLE = 3
SEED = 42
DISTANCE = 2
SEGMENTS = 10
PIVOTS = 32

_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Hashes whose bits are counted at a time.
_BLOCK = 1 << 14


def _shingles(text: str | None, size: int) -> tuple[bytes, list[int], list[int]]:
    """The words of a text in one line, and where its shingles start and end; none without words."""
    words = _WORDS.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER)) if text else []
    if not words:
        return b"", [], []
    line = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    n = max(1, len(words) - size + 1)
    return line, [0, *(e + 1 for e in ends)][:n], ends[min(size, len(words)) - 1:]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one text."""
    line, starts, last = _shingles(text, shingle)
    n = len(starts)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for low in range(0, n, _BLOCK):
        hashes = np.array([digest(line[s:e], SEED) for s, e in zip(starts[low:low + _BLOCK], last[low:low + _BLOCK], strict=False)], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprint_of(text: Column) -> Column:
    """Fingerprints as signed longs."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))

    return prints(text)


def _groups() -> list[np.ndarray]:
    """The positions of the one-bit references, in groups of consecutive ones."""
    return np.array_split(np.arange(64), SEGMENTS)


_LEFT_OUT = list(combinations(range(SEGMENTS), DISTANCE))
_ONE_BIT = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)


def _spread_pivots() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"pivot {i}".encode()) for i in range(PIVOTS)], dtype=np.uint64)


def distances(prints: np.ndarray, references: np.ndarray) -> np.ndarray:
    """The pivot distance table: one row a fingerprint, one column a reference."""
    return np.bitwise_count(prints[:, None] ^ references[None, :]).astype(np.int16)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint under each choice of groups left out, with the coordinates that remain."""
    references = np.concatenate((np.zeros(1, dtype=np.uint64), _ONE_BIT))
    groups = _groups()
    masks = []
    for out in _LEFT_OUT:
        kept = np.ones(64, dtype=np.uint8)
        for g in out:
            kept[groups[g]] = 0
        masks.append(int.from_bytes(np.packbits(kept).tobytes(), "big"))
    masks = np.array(masks, dtype=np.uint64)
    for batch in batches:
        for start in range(0, batch.num_rows, 4096):
            prints = batch.column(0).slice(start, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
            table = distances(prints, references)
            relative = (table[:, :1] + 1 - table[:, 1:]) // 2
            code = np.packbits(relative.astype(np.uint8), axis=1).view(">u8").astype(np.uint64).ravel()
            n, k = len(prints), len(masks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(np.arange(k, dtype=np.int8), n)),
                    pa.array((code[:, None] & masks[None, :]).ravel().view(np.int64)),
                    pa.array(np.repeat(prints, k).view(np.int64)),
                ],
                ["choice", "cell", "print"],
            )


def _links(prints: np.ndarray, group: np.ndarray, pivots: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links within each group; groups are runs."""
    ends = np.flatnonzero(np.append(group[1:] != group[:-1], True))
    sizes = np.diff(np.append(-1, ends))
    several = np.repeat(sizes > 1, sizes)
    prints, group = prints[several], group[several]
    if not len(prints):
        return []
    table = distances(prints, pivots)
    found = []
    for step in range(1, int(sizes.max())):
        a = np.flatnonzero(group[step:] == group[:-step])
        if not len(a):
            break
        for low in range(0, len(a), 1 << 14):
            first = a[low:low + (1 << 14)]
            near = first[np.abs(table[first] - table[first + step]).max(axis=1) <= DISTANCE]
            near = near[np.bitwise_count(prints[near] ^ prints[near + step]) <= DISTANCE]
            found.extend(zip(near.tolist(), (near + step).tolist(), strict=True))
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    forest = []
    for x, y in found:
        p, q = top(x), top(y)
        if p != q:
            root[q] = p
            forest.append((x, y))
    signed = prints.view(np.int64)
    return [(int(signed[x]), int(signed[y])) for x, y in forest]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the cells; rows come sorted by cell, and a cell may span batches."""
    pivots = _spread_pivots()
    held = None
    for batch in batches:
        rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        if not len(rows[0]):
            continue
        changes = (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])
        group = np.concatenate(([0], np.cumsum(changes)))
        whole = int(np.searchsorted(group, group[-1]))
        held = [x[whole:] for x in rows]
        if whole:
            yield _edges(_links(rows[2][:whole].view(np.uint64), group[:whole], pivots))
    if held is not None:
        yield _edges(_links(held[2].view(np.uint64), np.zeros(len(held[2]), dtype=np.int64), pivots))


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"])


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Links (u, v) that connect all of `prints` (print: long, distinct) at most DISTANCE apart."""
    partitions = shuffle_partitions(prints.sparkSession)
    cells = prints.select("print").mapInArrow(_cells, "choice byte, cell long, print long")
    return (
        cells.repartition(partitions, "choice", "cell").sortWithinPartitions("choice", "cell")
        .mapInArrow(_linked, "u long, v long")
    )


def classes(fingerprints: DataFrame) -> DataFrame:
    """(print, root, component_id) of all fingerprints in `fingerprints` (doc_id, print)."""
    prints = materialise(fingerprints.groupBy("print").agg(F.min("doc_id").alias("first_id")), "prints")
    roots = components(link_fingerprints(prints))
    rooted = prints.join(roots, F.col("print") == F.col("node"), "left").select("print", "first_id", F.coalesce("root", "print").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(ids, "root").select("print", "root", "component_id")


# --- one of each component -------------------------------------------------------------------------


def _text_key(text: Column) -> Column:
    """128 bits that stand for a text; null has a key of its own."""
    return F.coalesce(F.unhex(F.md5(F.encode(text, "UTF-8"))), F.lit(b""))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component of linked fingerprints: that with the smallest doc_id.

    Null ids come last; equal ids are told apart by their texts, and of rows that agree in
    both one stays.
    """
    key = spare_name(docs, "text_key")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("text_key").alias("text_key"))
    narrow = materialise(docs.select("doc_id", _text_key(F.col("text")).alias("text_key"), fingerprint_of(F.col("text")).alias("print")), "fingerprints")
    # One row for each fingerprint before anything is joined, so that copies never meet in a task.
    least = narrow.groupBy("print").agg(F.min(order).alias("f"))
    first = least.join(classes(narrow).select("print", "root"), "print").groupBy("root").agg(F.min("f").alias("f")).select("f.doc_id", "f.text_key")
    same = narrow.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"))
    on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key"))
    kept = materialise(first.alias("a").join(same.alias("b"), on).select("a.doc_id", "a.text_key", "rows"), "kept-documents")
    on = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{key}") == F.col("k.text_key"))
    chosen = docs.withColumn(key, _text_key(F.col("text"))).alias("d").join(kept.alias("k"), on)
    columns = [F.col(f"d.`{c}`") for c in docs.columns]
    single = chosen.filter("k.rows = 1").select(*columns)
    repeated = (
        chosen.filter("k.rows > 1").select(F.col("k.doc_id").alias("i"), F.col("k.text_key").alias("h"), F.struct(*columns).alias("row"))
        .groupBy("i", "h").agg(F.first("row").alias("row")).select("row.*")
    )
    return single.union(repeated)


@register("op2_simhash_pivots")
def op2_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    narrow = materialise(docs.select("doc_id", fingerprint_of(F.col("text")).alias("print")), "fingerprints")
    found = classes(narrow)
    return narrow.join(found, "print").select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")

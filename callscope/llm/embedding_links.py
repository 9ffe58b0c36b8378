"""Embedding near-dedup: an inverted multi-index over vector halves.

Both halves of the unit vectors have a codebook of their own; the product of the codebooks is a
grid of cells, and every vector lies in the cell of its nearest codes. A vector visits cells in
the order of their distance (the sum of both halves' squared distances) by multi-sequence
traversal over the two sorted distance lists, until the cells it has seen hold a neighbour at the
threshold with the target odds; it meets what lies there, and each pair is verified by its cosine
in double precision. A pair is found if either of its vectors visits the other's cell, so recall
is above the target; links that are found are exact.

When to stop is learned: for vectors of the sample, neighbours at exactly the threshold are made in
random directions, and the quantile `target` of how much farther than the nearest cell theirs lies
is the slack every traversal is given. No number of cells, partners or candidates is capped.

Codebooks are fitted on a bounded sample of `SAMPLE` vectors (the smallest digests, so the same
in every run) of each length in it; the number of codes follows the number of vectors, so that a
cell holds about `occupancy`, up to `MAX_CODES` a half.

Scale: equal vectors are one, whatever the number of copies, pre-aggregated before the shuffle. A
cell of more than `block` vectors is cut into blocks, and what has to meet it goes to each block, so
that the vectors a task holds at a time are bounded; visitors stream past. Tasks return counts
of links and a spanning forest, never pairs. Components are joined, not collected. To the driver
come the sample and, for cells above `block`, one number each (at most 2^20 cells a length).

Cases: vectors that are null, empty or zero, or hold null or non-finite components, link with
nothing and are their own component; vectors of different lengths do not link; rows that hold
equal vectors are linked; a null vec_id is no candidate for component_id, which is null where no
row of the component has an id; rows with one vec_id are one vector each; an empty table gives an
empty table; extra columns are ignored.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, read_table, shuffle_partitions
from callscope.llm.components import components
from callscope.llm.registry import register

COSINE = 0.95
TARGET = 0.99
SAMPLE = 16_384
OCCUPANCY = 1_000
MAX_CODES = 1_024
BLOCK = 4_096
#: Rounds of k-means, neighbours made for each sampled vector, and how many of those are asked.
_ROUNDS, _MADE, _ASKED = 8, 4, 2_048
#: Cells of one vector length are numbered from a multiple of this.
_GRID = MAX_CODES * MAX_CODES
_STEP = 1_024


def packed_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector): little-endian doubles, null where the vector cannot link."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            values = column.values.to_numpy(zero_copy_only=False).astype("<f8")
            ends = column.offsets.to_numpy()
            known = column.is_valid().to_numpy(zero_copy_only=False)
            packed = []
            for i in range(batch.num_rows):
                one = values[ends[i]:ends[i + 1]]
                packed.append(one.tobytes() if known[i] and len(one) and np.isfinite(one).all() and one.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "vector"])

    doubles = F.col(embedding).cast("array<double>")
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), doubles.alias("embedding")).mapInArrow(pack, "vec_id long, vector binary")


def unit_vectors(packed: list[bytes]) -> np.ndarray:
    """One unit vector a row; all have one length. Large and small components neither overflow nor vanish."""
    vectors = np.frombuffer(b"".join(packed), dtype="<f8").reshape(len(packed), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


# --- codebooks and traversal -----------------------------------------------------------------------


def halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = units.shape[1] // 2
    return units[:, :middle], units[:, middle:]


def code_distances(part: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of each row of `part` to each code."""
    return np.maximum((part * part).sum(axis=1)[:, None] - 2 * part @ codes.T + (codes * codes).sum(axis=1)[None, :], 0)


def fit_codes(part: np.ndarray, count: int, seed: int) -> np.ndarray:
    """k-means; codes without rows stay where they were."""
    draw = np.random.default_rng(seed)
    codes = part[draw.choice(len(part), min(count, len(part)), replace=False)].copy()
    for _ in range(_ROUNDS):
        nearest = code_distances(part, codes).argmin(axis=1)
        sums = np.zeros_like(codes)
        np.add.at(sums, nearest, part)
        members = np.bincount(nearest, minlength=len(codes))
        codes[members > 0] = sums[members > 0] / members[members > 0, None]
    return codes


def multi_sequence(first: np.ndarray, second: np.ndarray, slack: float) -> list[tuple[int, int]]:
    """Cells (i, j) in the order of first[i] + second[j], to `slack` beyond the nearest one.

    A heap holds the front of the grid of both sorted lists: a cell enters once its neighbours
    below and to the left have left.
    """
    rows, columns = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[rows].tolist(), second[columns].tolist()
    limit = a[0] + b[0] + slack
    heap, left, seen = [(a[0] + b[0], 0, 0)], set(), []
    while heap:
        cost, i, j = heapq.heappop(heap)
        if cost > limit:
            break
        seen.append((int(rows[i]), int(columns[j])))
        left.add((i, j))
        if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in left):
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in left):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return seen


def learned_slack(units: np.ndarray, first: np.ndarray, second: np.ndarray, cosine: float, target: float, seed: int) -> float:
    """How much farther than the nearest cell a neighbour's cell lies, at the quantile `target`."""
    draw = np.random.default_rng(seed)
    asked = np.repeat(units[:_ASKED], _MADE, axis=0)
    noise = draw.standard_normal(asked.shape)
    noise -= (noise * asked).sum(axis=1, keepdims=True) * asked
    length = np.sqrt((noise * noise).sum(axis=1, keepdims=True))
    made = cosine * asked + np.sqrt(max(0.0, 1 - cosine * cosine)) * noise / np.where(length > 0, length, 1)
    extra = np.zeros(len(asked))
    for mine, theirs, codes in zip(halves(asked), halves(made), (first, second), strict=True):
        distances = code_distances(mine, codes)
        extra += distances[np.arange(len(mine)), code_distances(theirs, codes).argmin(axis=1)] - distances.min(axis=1)
    return float(np.quantile(extra, target))


class MultiIndex:
    """Codebooks and slack for each vector length; other lengths have one cell."""

    def __init__(self, sample: list[bytes], vectors: int, cosine: float = COSINE, target: float = TARGET, occupancy: int = OCCUPANCY):
        self.books: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        by_length: dict[int, list[bytes]] = {}
        for one in sample:
            by_length.setdefault(len(one) // 8, []).append(one)
        for length, own in by_length.items():
            share = vectors * len(own) / len(sample)
            count = min(MAX_CODES, max(1, round((share / occupancy) ** 0.5)))
            units = unit_vectors(own)
            first, second = (fit_codes(part, count, seed) for seed, part in enumerate(halves(units)))
            self.books[length] = (first, second, learned_slack(units, first, second, cosine, target, 2))

    def visits(self, packed: list[bytes]) -> list[list[int]]:
        """The cells of each vector in the order of its traversal; the first is its own."""
        out: list[list[int]] = [[] for _ in packed]
        by_length: dict[int, list[int]] = {}
        for i, one in enumerate(packed):
            by_length.setdefault(len(one) // 8, []).append(i)
        for length, own in by_length.items():
            base = length * _GRID
            if length not in self.books:
                for i in own:
                    out[i] = [base]
                continue
            first, second, slack = self.books[length]
            a, b = halves(unit_vectors([packed[i] for i in own]))
            for i, x, y in zip(own, code_distances(a, first), code_distances(b, second), strict=True):
                out[i] = [base + p * MAX_CODES + q for p, q in multi_sequence(x, y, slack)]
        return out


# --- meeting in cells --------------------------------------------------------------------------------

_MET = "cell long, block int, visits_in boolean, rep long, copies long, home long, cells array<long>, vector binary"


def _indexed(index: MultiIndex):
    """Tasks that add the cells each vector visits."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _STEP):
                rep, copies, vector = batch.slice(start, _STEP).columns
                cells = index.visits(vector.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rep, copies, vector, pa.array([c[0] for c in cells], pa.int64()), pa.array(cells, pa.list_(pa.int64()))],
                    ["rep", "copies", "vector", "home", "cells"],
                )

    return rows


def _dealt(cells: np.ndarray, blocks: np.ndarray):
    """Tasks that send each vector to its own block, and as a visitor to all blocks it has to meet.

    `cells` (sorted) are those cut into several blocks. Of one cell, a vector visits the blocks
    after its own.
    """

    def blocks_of(cell: int) -> int:
        at = int(np.searchsorted(cells, cell))
        return int(blocks[at]) if at < len(cells) and cells[at] == cell else 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _STEP):
                part = batch.slice(start, _STEP)
                source, cell, block, visits_in = [], [], [], []
                homes, visited = part.column(3).to_pylist(), part.column(4).to_pylist()
                for i, rep in enumerate(part.column(0).to_pylist()):
                    home = homes[i]
                    own = rep % blocks_of(home)
                    meets = [(home, own, False), *((home, b, True) for b in range(own + 1, blocks_of(home)))]
                    meets += [(c, b, True) for c in visited[i] if c != home for b in range(blocks_of(c))]
                    for c, b, v in meets:
                        source.append(i)
                        cell.append(c)
                        block.append(b)
                        visits_in.append(v)
                for low in range(0, len(source), 4 * _STEP):
                    at = slice(low, low + 4 * _STEP)
                    take = pa.array(source[at])
                    none = [None if v else visited[i] for i, v in zip(source[at], visits_in[at], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cell[at], pa.int64()), pa.array(block[at], pa.int32()), pa.array(visits_in[at], pa.bool_()),
                            part.column(0).take(take), part.column(1).take(take), part.column(3).take(take),
                            pa.array(none, pa.list_(pa.int64())), part.column(2).take(take),
                        ],
                        ["cell", "block", "visits_in", "rep", "copies", "home", "cells", "vector"],
                    )

    return rows


class _Block:
    """The vectors that lie in one block of a cell, and what visitors find among them."""

    def __init__(self, cell: int, rows: list[tuple], cosine: float):
        self.cell, self.cosine = cell, cosine
        self.rep = np.array([r[0] for r in rows], dtype=np.int64)
        self.copies = np.array([r[1] for r in rows], dtype=np.int64)
        self.units = unit_vectors([r[3] for r in rows])
        self.owner = np.repeat(np.arange(len(rows)), [len(r[2]) for r in rows])
        self.cells = np.array([c for r in rows for c in r[2]], dtype=np.int64)
        self.links = np.zeros(len(rows), dtype=np.int64)
        self.label = np.arange(len(rows))
        self.edges: list[tuple[int, int]] = []
        self.met: list[tuple[int, int]] = []
        self._masks: dict[int, np.ndarray] = {}
        self._among_themselves()

    def _merge(self, linked: np.ndarray) -> np.ndarray:
        """One of `linked` (places) for each component; these become one."""
        labels, where = np.unique(self.label[linked], return_index=True)
        if len(labels) > 1:
            self.label[np.isin(self.label, labels)] = labels[0]
        return linked[where]

    def _among_themselves(self) -> None:
        for low in range(0, len(self.rep), _STEP):
            near = self.units[low:low + _STEP] @ self.units.T >= self.cosine
            here = np.arange(len(near))
            near[here, here + low] = False
            self.links[low:low + _STEP] += near @ self.copies
            for i in np.flatnonzero(near.any(axis=1)):
                linked = np.append(np.flatnonzero(near[i]), low + i)
                first, *others = self._merge(linked).tolist()
                self.edges.extend((int(self.rep[first]), int(self.rep[o])) for o in others)

    def _not_here(self, home: int) -> np.ndarray:
        """Vectors that visit the cell `home` themselves: such pairs count in the smaller cell."""
        if home not in self._masks:
            mask = np.zeros(len(self.rep), dtype=bool)
            if self.cell > home:
                mask[self.owner[self.cells == home]] = True
            self._masks[home] = mask
        return self._masks[home]

    def visit(self, rep: np.ndarray, copies: np.ndarray, home: np.ndarray, packed: list[bytes]) -> None:
        near = unit_vectors(packed) @ self.units.T >= self.cosine
        hits = np.flatnonzero(near.any(axis=1))
        for i in hits:
            if home[i] != self.cell:
                near[i] &= ~self._not_here(int(home[i]))
        counts = near @ self.copies
        self.links += copies @ near
        for i in hits[counts[hits] > 0]:
            self.met.append((int(rep[i]), int(counts[i])))
            self.edges.extend((int(rep[i]), int(self.rep[o])) for o in self._merge(np.flatnonzero(near[i])))

    def taken(self) -> pa.RecordBatch:
        """What was found since the last call: rows (u, n) of links and (u, v) of the forest."""
        rows = self.met + [(int(self.rep[i]), int(self.links[i])) for i in np.flatnonzero(self.links)]
        out = pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows] + [e[0] for e in self.edges], pa.int64()),
                pa.array([None] * len(rows) + [e[1] for e in self.edges], pa.int64()),
                pa.array([r[1] for r in rows] + [None] * len(self.edges), pa.int64()),
            ],
            ["u", "v", "n"],
        )
        self.met, self.edges = [], []
        self.links[:] = 0
        return out


def _verified(cosine: float):
    """Tasks over rows sorted by cell, block and visits_in: those that lie there come first."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, lying, block = None, [], None
        for batch in batches:
            for start in range(0, batch.num_rows, _STEP):
                part = batch.slice(start, _STEP)
                cell, number = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                guest = part.column(2).to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (number[1:] != number[:-1]) | (guest[1:] != guest[:-1])) + 1
                for low, high in zip([0, *cuts], [*cuts, len(cell)], strict=True):
                    now = (int(cell[low]), int(number[low]))
                    if now != key:
                        if lying:
                            yield _Block(key[0], lying, cosine).taken()
                        key, lying, block = now, [], None
                    rep, copies, home, cells, vector = (part.column(i).slice(low, high - low) for i in range(3, 8))
                    if not guest[low]:
                        lying += zip(*(x.to_pylist() for x in (rep, copies, cells, vector)), strict=True)
                        continue
                    if lying:
                        block, lying = _Block(key[0], lying, cosine), []
                    if block:
                        block.visit(*(x.to_numpy(zero_copy_only=False) for x in (rep, copies, home)), vector.to_pylist())
                        yield block.taken()
        if lying:
            yield _Block(key[0], lying, cosine).taken()

    return rows


def links_of(reps: DataFrame, index: MultiIndex, cosine: float, block: int) -> DataFrame:
    """(u, v, n) of `reps` (rep, copies, vector): n links of u, or an edge of the spanning forest."""
    spark = reps.sparkSession
    indexed = materialise(
        reps.select("rep", "copies", "vector").mapInArrow(_indexed(index), "rep long, copies long, vector binary, home long, cells array<long>"), "indexed-vectors"
    )
    large = indexed.groupBy("home").agg(F.count("*").alias("n")).filter(F.col("n") > block).orderBy("home").collect()
    cells = np.array([r.home for r in large], dtype=np.int64)
    blocks = np.array([-(-r.n // block) for r in large], dtype=np.int64)
    met = indexed.mapInArrow(_dealt(cells, blocks), _MET).repartition(shuffle_partitions(spark), "cell", "block")
    return met.sortWithinPartitions("cell", "block", "visits_in").mapInArrow(_verified(cosine), "u long, v long, n long")


def near_duplicates(
    rows: DataFrame, cosine: float = COSINE, target: float = TARGET, sample: int = SAMPLE, occupancy: int = OCCUPANCY, block: int = BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of each row of `rows` (vec_id, embedding)."""
    packed = materialise(packed_vectors(rows).withColumn("digest", F.unhex(F.sha2("vector", 256))), "packed-vectors")
    linkable = packed.filter("vector IS NOT NULL")
    grouped = linkable.groupBy("digest").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"), F.first("vector").alias("vector"))
    # The ids are read from the table, so they stay as they were written.
    reps = materialise(grouped.withColumn("rep", F.monotonically_increasing_id()), "distinct-vectors")
    seen = [bytes(r.vector) for r in reps.orderBy("digest").select("vector").limit(sample).collect()]
    found = materialise(links_of(reps, MultiIndex(seen, reps.count(), cosine, target, occupancy), cosine, block), "embedding-links")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("others"))
    edges = found.filter("v IS NOT NULL").select("u", "v")
    # Equal vectors are one component without an edge.
    roots = components(edges).select(F.col("node").alias("rep"), "root")
    known = reps.select("rep", "digest", "copies", "first_id").join(roots, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    ids = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    judged = known.join(counts, "rep", "left").join(ids, "root").select(
        "digest", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    linked = packed.select("vec_id", "digest").join(judged, "digest", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


@register("op11_embedding_multi_index")
def op11_embedding_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))

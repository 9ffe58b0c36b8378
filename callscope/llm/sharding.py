"""Shards along a Hilbert curve over metadata.

Several metadata columns are quantised into cells of equal counts, the cells of a row are one
point of a grid, and rows are sorted by the point's index on the Hilbert curve. Runs of that
order are the shards, so that each shard, and each file of one, covers a small box of all the
dimensions and a reader's filter on any of them skips most files. Law `rows`: the counts of
shards are at most one apart.

Numbers are cut at quantiles, strings at equal steps of the rank among their distinct values.

Scale: the cuts of numbers come from mergeable quantile sketches, those of strings from the
distributed order of their distinct values: (2^bits - 1) of each come to the driver. Only narrow
rows of keys are ordered and numbered, dealt out by ranges of all keys, so that a cell with a third of
all rows is split between tasks; whole texts move once, to the task their key belongs to. One
count for each task comes to the driver.

Cases: null in a dimension sorts before every value; a null text has size 1 and the checksum of
the empty text; equal points are ordered by a hash of doc_id, then by doc_id and checksum (the stage:
by a hash of doc_id and text), and rows equal in all of these are interchangeable; an empty table gives an empty table; with fewer
rows than shards some shards are empty.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, ordered_rows, read_table, shuffle_partitions, spare_name
from callscope.llm.registry import register

SHARDS = 8
BITS = 5
#: Bytes of text one task of the stage writes, about.
TASK_BYTES = 128 << 20


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of each point; `cells` is (points, dimensions), below 2^bits.

    The points' coordinates are turned, from the highest bit down, into the frame of the
    sub-cube they lie in, and Gray decoded; the index reads the bits of all dimensions in turn.
    """
    x = cells.astype(np.uint64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    step = top
    while step > 1:
        low, one = np.uint64(step - 1), np.uint64(step)
        for d in range(dims):
            turned = (x[d] & one) != 0
            x[0] = np.where(turned, x[0] ^ low, x[0])
            swap = np.where(turned, np.uint64(0), (x[0] ^ x[d]) & low)
            x[0] ^= swap
            x[d] ^= swap
        step >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    step = top
    while step > 1:
        flip ^= np.where((x[dims - 1] & np.uint64(step)) != 0, np.uint64(step - 1), np.uint64(0))
        step >>= 1
    x ^= flip
    index = np.zeros(x.shape[1], dtype=np.uint64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            index = (index << np.uint64(1)) | ((x[d] >> np.uint64(bit)) & np.uint64(1))
    return index.astype(np.int64)


def number_cell(df: DataFrame, values: Column, cells: int) -> Column:
    """The cell of a number, cut at the quantiles of all rows' numbers."""
    shares = F.array(*[F.lit((i + 1) / cells) for i in range(cells - 1)])
    return _cell(values.cast("double"), df.agg(F.percentile_approx(values.cast("double"), shares, F.lit(10_000))).first()[0] or [])


def string_cell(df: DataFrame, values: Column, cells: int) -> Column:
    """The cell of a string, cut at equal steps of the rank among the distinct values.

    Up to `cells` values have a cell each, and common prefixes change nothing. Only the cuts
    come to the driver.
    """
    distinct = df.select(values.cast("string").alias("value")).filter("value IS NOT NULL").distinct()
    placed, n = ordered_rows(distinct, shuffle_partitions(df.sparkSession), F.col("value"))
    step = F.expr(f"(position * {cells}L) DIV {max(n, 1)}L != ((position - 1) * {cells}L) DIV {max(n, 1)}L")
    return _cell(values.cast("string"), sorted(r.value for r in placed.filter(step & (F.col("position") > 0)).select("value").collect()))


def _cell(value: Column, cuts: list) -> Column:
    """How many of the cuts the value has reached; 0 for null."""
    reached = F.lit(0)
    for cut in cuts:
        reached = reached + (value >= F.lit(cut)).cast("int")
    return F.coalesce(reached, F.lit(0))


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def dimensions_of(size: Column) -> dict[str, Column]:
    return {"source": string_number(F.col("source")), "lang": string_number(F.col("lang")), "size": size.cast("double")}


def curve_column(df: DataFrame, dimensions: dict[str, Column], bits: int = BITS) -> Column:
    """Hilbert index of each row of `df` over `dimensions`, numbers or strings, quantised each."""
    if not 0 < bits * len(dimensions) < 64:
        raise ValueError("bits times dimensions must be 1 to 63")
    kinds = dict(df.select(*[c.alias(n) for n, c in dimensions.items()]).dtypes)
    cells = [(string_cell if kinds[n] == "string" else number_cell)(df, c, 1 << bits) for n, c in dimensions.items()]

    @F.pandas_udf("long")
    def index(points: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(points.to_numpy(dtype=np.uint64), bits))

    return index(F.struct(*[c.alias(f"d{i}") for i, c in enumerate(cells)]))


def dimensions_of(size: Column) -> dict[str, Column]:
    return {"source": F.col("source"), "lang": F.col("lang"), "size": size}


def interval_of(cuts: list[tuple[int, int]], first: Column, second: Column) -> Column:
    """The last of the ascending `cuts` that (first, second) has reached; -1 before all of them."""
    at = np.array(cuts, dtype=np.int64).reshape(-1, 2)

    @F.pandas_udf("int")
    def intervals(one: pd.Series, two: pd.Series) -> pd.Series:
        high, low = np.concatenate((at[:, 0], one)), np.concatenate((at[:, 1], two))
        is_cut = np.arange(len(high)) < len(at)
        order = np.lexsort((~is_cut, low, high))
        reached = np.empty(len(high), dtype=np.int32)
        reached[order] = np.cumsum(is_cut[order]) - 1
        return pd.Series(reached[len(at):])

    return intervals(first, second)


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, task_bytes: int = TASK_BYTES) -> DataFrame:
    """`docs` in curve order with `shard` and `slot`, which replace columns of these names.

    `docs` has doc_id, text, lang and source. A narrow table of the rows' keys is numbered first;
    it gives the cuts between tasks and the rows before each of them, so that the texts move once,
    straight to their place, and are numbered where they lie.
    """
    spark = docs.sparkSession
    docs = docs.select(*[c for c in docs.columns if c.lower() not in ("shard", "slot")])
    names = curve, tie, size, task, row = [spare_name(docs, f"shard_{x}") for x in ("curve", "tie", "size", "task", "row")]
    tie_of = F.xxhash64("doc_id", "text")
    facts = materialise(docs.select("source", "lang", text_size(F.col("text")).alias(size), tie_of.alias(tie)), "shard-facts")
    curve_of = curve_column(facts, dimensions_of(F.col(size)), bits)
    placed, total = ordered_rows(facts.select(curve_of.alias(curve), tie, size), shuffle_partitions(spark), F.col(curve), F.col(tie))
    held = placed.agg(F.sum(size)).first()[0] or 0
    tasks = max(shuffle_partitions(spark), -(-held // task_bytes))
    at_cut = placed.filter(F.expr(f"position % {max(1, -(-total // tasks))}L = 0")).orderBy("position").select(curve, tie).collect()
    cuts = list(dict.fromkeys((r[0], r[1]) for r in at_cut)) or [(0, 0)]
    number = interval_of(cuts, F.col(curve), F.col(tie))
    counts = {r[0]: r[1] for r in placed.groupBy(number.alias("task")).agg(F.count("*")).collect()}
    before = np.concatenate(([0], np.cumsum([counts.get(i, 0) for i in range(len(cuts))]))).tolist()
    starts = F.create_map(*[F.lit(x) for pair in enumerate(before) for x in pair])
    keyed = docs.withColumns({size: text_size(F.col("text")), tie: tie_of}).withColumn(curve, curve_of).withColumn(task, number)
    dealt = keyed.repartitionById(len(cuts), F.col(task)).sortWithinPartitions(curve, tie).withColumn(row, F.monotonically_increasing_id())
    position = starts[F.col(task)] + F.col(row).bitwiseAND(F.lit((1 << 33) - 1))
    return _runs(dealt.withColumn(row, position), row, total, shards).drop(*names)


def _runs(rows: DataFrame, position: str, total: int, shards: int) -> DataFrame:
    """`shard` and `slot` of each position: runs whose counts are at most one apart."""
    total = max(total, 1)
    number = F.expr(f"CAST((({shards}L * ({position} + 1)) - 1) DIV {total}L AS INT)")
    return rows.withColumn("shard", number).withColumn("slot", F.expr(f"{position} - (CAST(shard AS BIGINT) * {total}L) DIV {shards}L"))


@register("op5_hilbert_sharding")
def op5_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    narrow = materialise(
        docs.select("doc_id", "source", "lang", text_size(F.col("text")).alias("size"), text_crc(F.col("text")).alias("text_crc32")), "shard-sizes"
    )
    curve = curve_column(narrow, dimensions_of(F.col("size")))
    keyed = narrow.select("doc_id", "size", "text_crc32", curve.alias("curve"), F.xxhash64("doc_id").alias("tie"))
    placed, total = ordered_rows(keyed, shuffle_partitions(spark), *[F.col(c) for c in ("curve", "tie", "doc_id", "text_crc32")])
    return _runs(placed, "position", total, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )

"""An index of event ids by day, to drop re-deliveries that come after any watermark."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.operators.envelopes import dedup_events
from callscope.session import scratch_dir

BLOCK_BITS = 32768  # the bits of one bitmap of Spark's
BLOCK_IDS = 2048  # 16 bits an id
BITS = tuple(range(1, 7))
SLOTS = 8


def append_ids(ids: DataFrame, path: str, id: str = "event_id", day: str = "day") -> None:
    """Add (id, day) rows to the index at `path`.

    `ids` holds them by day and slot of the id, `filters` a Bloom filter per day: blocks of 4 KB, one of
    which an id falls into, with six bits of it set. The blocks are sized by the fullest day
    added. Adding rows twice, as a job that starts again does, changes no answer. NULL ids
    and ids without a day are left out.
    """
    rows = ids.select(F.col(id).alias("id"), F.col(day).cast("date").alias("day")).dropna().distinct()
    kept = scratch_dir(ids.sparkSession, "ids-of-days")
    rows.write.parquet(kept)
    rows = ids.sparkSession.read.parquet(kept)
    most = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
    if most is None:
        return
    blocks = 1 << max(0, (most - 1) // BLOCK_IDS).bit_length()
    bits = rows.select("day", _block("id", F.lit(blocks)).alias("block"), F.explode(F.array(*[_bit("id", i) for i in BITS])).alias("bit"))
    filters = bits.groupBy("day", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    # The ids go first: an id whose filter is not there yet was never promised to be found.
    placed = rows.withColumn("part", _part("day", "id")).drop("day").hint("rebalance", "part")
    placed.write.mode("append").partitionBy("part").parquet(os.path.join(path, "ids"))
    filters.withColumn("blocks", F.lit(blocks)).write.mode("append").partitionBy("blocks").parquet(os.path.join(path, "filters"))


def candidate_days(ids: DataFrame, path: str) -> DataFrame:
    """Distinct `id` of `ids` with each `day` whose filter may hold it: all true ones, and about one in 1,000 others."""
    filters = ids.sparkSession.read.parquet(os.path.join(path, "filters"))
    sizes = [r.blocks for r in filters.select("blocks").distinct().collect()]  # powers of two: a few
    probes = ids.select("id").dropna().distinct().withColumn("blocks", F.explode(F.array(*[F.lit(s) for s in sizes])))
    met = probes.withColumn("block", _block("id", F.col("blocks"))).join(filters, ["blocks", "block"])
    for i in BITS:
        met = met.filter(_is_set("bits", _bit("id", i)))
    return met.select("id", "day").distinct()


def known_ids(ids: DataFrame, path: str) -> DataFrame:
    """`id` and the first `day` of those of `ids` (column `id`) that the index holds.

    The filters are read whole, the ids only in the parts that a filter points to. Those parts
    come to the driver by name: at most `SLOTS` a day of the index.
    """
    spark = ids.sparkSession
    if not _exists(spark, os.path.join(path, "filters")):
        return ids.select("id", F.lit(None).cast("date").alias("day")).limit(0)
    kept = scratch_dir(spark, "candidate-days")
    candidate_days(ids, path).withColumn("part", _part("day", "id")).write.parquet(kept)
    may = spark.read.parquet(kept)
    parts = [r.part for r in may.select("part").distinct().collect()]
    held = spark.read.schema("id string, part string").parquet(os.path.join(path, "ids")).filter(F.col("part").isin(parts))
    return may.join(held, ["part", "id"]).groupBy("id").agg(F.min("day").alias("day"))


def dedup_late(batch: DataFrame, path: str, order: list[str]) -> DataFrame:
    """The rows of `batch` whose event id is new: the first in `order` of each id that the index
    does not hold. Rows without an id count as one id that no index holds."""
    first = dedup_events(batch, order)
    known = known_ids(batch.select(F.col("event_id").alias("id")), path).select(F.col("id").alias("event_id"))
    return first.join(known, "event_id", "left_anti")


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _block(id: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(id), blocks.cast("long"))


def _bit(id: str, i: int) -> Column:
    return F.pmod(F.xxhash64(id, F.lit(i)), F.lit(BLOCK_BITS))


def _is_set(bits: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def _part(day: str, id: str) -> Column:
    return F.concat_ws("_", F.col(day).cast("string"), F.pmod(F.xxhash64(id, F.lit(0)), F.lit(SLOTS)))

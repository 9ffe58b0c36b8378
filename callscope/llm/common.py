"""Helpers the operators of this package share."""

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.session import scratch_dir, ship_package

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts of one Arrow batch are worked through in pieces of about so many bytes.
PIECE_BYTES = 1 << 20
MIN_LONG = -(1 << 63)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One table of a folder; the package is shipped to the Python workers as well."""
    ship_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back: lineage ends here.

    The files outlive executors, so nothing above is run again when one is lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_name(df: DataFrame, base: str) -> str:
    """A column name that `df` does not use yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), 0)), F.lit(0)).cast("long")


def ordered_rows(df: DataFrame, partitions: int, *keys: Column) -> tuple[DataFrame, int]:
    """`df` with its rows' position in the order of `keys`, in a column `position`, from 0.

    Rows are dealt out by ranges of all keys, so that equal leading keys are split as well,
    and numbered where they lie; only one count for each partition comes to the driver.
    `position` must not be a column of `df`. Also returns the number of rows.
    """
    at = spare_name(df, "row_in_partition")
    placed = materialise(
        df.repartitionByRange(partitions, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(at, F.monotonically_increasing_id()),
        "ordered",
    )
    part = F.shiftright(F.col(at), 33)
    counts = sorted((r.part, r.n) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    before, offsets = 0, []
    for number, n in counts:
        offsets.append((number, before))
        before += n
    first = F.create_map(*[F.lit(x) for pair in offsets for x in pair]) if offsets else F.lit(None).cast("map<bigint,bigint>")
    position = first[part] + F.col(at).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("position", position).drop(at), before


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(lengths: list[int], limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs (from, to) of consecutive items of about `limit` bytes; a longer item is alone."""
    start = held = 0
    for i, n in enumerate(lengths):
        if held and held + n > limit:
            yield start, i
            start = i
            held = 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)

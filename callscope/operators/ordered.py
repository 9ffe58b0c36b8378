"""Ordered windows that survive hot keys.

A plain window sorts all rows of one key in one task. `slice_hot` looks for keys
with more than `HOT_ROWS` rows first. Without any, the windows stay plain. With
some, the narrow (key, order) rows of those keys are numbered in their order, and the keys
are cut at every `hot_rows`-th place: slices hold equal numbers of rows, however the
rows lie in time, and rows of one place stay together. Every window then runs per key and
slice, and what a slice needs from earlier slices arrives as one small carried
row, joined on the hash layout the window already has. Key columns must not be
NULL.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callscope.session import scratch_dir

HOT_ROWS = 2_000_000
SLICE = "__slice"
#: Whole rows that one task sorts, so that its memory does not grow with the table.
TASK_ROWS = 100_000
#: Starts of one key that a row is compared with; beyond, rows find their slice by a join on their place.
_STARTS = 128


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` by way of the shared scratch folder: its size is known, its lineage ends."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_in_slices(df: DataFrame, name: str) -> DataFrame:
    """`written` for what windows over slices gave; their carries join on the layout of the slices.

    The rows lie by key and slice, and the joins ask for more columns than these, which would by default send
    whole rows across the network again for each join. The setting holds for this one job.
    """
    conf, setting = df.sparkSession.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(setting)
    conf.set(setting, "false")
    try:
        return written(df, name)
    finally:
        conf.set(setting, before)


def dealt(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """`df` by `keys` over as many tasks as `rows` rows need, and no fewer than the session's number.

    Tables of one task's rows are left to Spark. Larger ones are not: adaptive execution merges tasks by their
    compressed bytes, and rows that compress to a tenth would be sorted in a few tasks that spill.
    """
    tasks = max(-(-rows // TASK_ROWS), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df if rows <= TASK_ROWS else df.repartition(tasks, *keys)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """Keys with more than `hot_rows` rows; at most (rows / hot_rows) of them.

    Counting is pre-aggregated before its shuffle.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > hot_rows).select(*keys)


def numbered(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """`df` with the position of each row in the order of all columns of `order`, from 0.

    Rows are dealt out by ranges of all these columns and numbered where they lie; one
    count for each task comes to the driver.
    """
    rows, part = f"__{name}_row", F.shiftright(F.col(f"__{name}_row"), 33)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(rows, F.monotonically_increasing_id())
    placed = written(dealt, "numbered")
    counts = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, [F.lit(-1), F.lit(0)]
    for number in sorted(counts):
        offsets += [F.lit(number), F.lit(before)]
        before += counts[number]
    at = F.create_map(*offsets)[part] + F.col(rows).bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(name, at.cast("bigint")).drop(rows)


def placed_rows(df: DataFrame, keys: list[str], order: list[str], hot: DataFrame, hot_rows: int) -> DataFrame:
    """The narrow rows of the hot keys: keys, `__place`, and `__number`, the slice at their position."""
    narrow = df.select(*keys, F.struct(*order).alias("__place")).join(hot, keys, "left_semi")
    placed = numbered(narrow, [*keys, "__place"], "__position")
    first = placed.groupBy(*keys).agg(F.min("__position").alias("__first"))
    behind = F.col("__position") - F.col("__first")
    return placed.join(first, keys).select(
        *keys, "__place", F.floor(behind / hot_rows).cast("bigint").alias("__number"), (behind % hot_rows == 0).alias("__starts_slice")
    )


@dataclass
class Sliced:
    """A table ready for ordered windows; `hot` is None when every key is ordinary."""

    df: DataFrame
    keys: list[str]
    hot: DataFrame | None = None

    def replace(self, df: DataFrame) -> "Sliced":
        return Sliced(df, self.keys, self.hot)

    def window_keys(self, keys: list[str]) -> list[str]:
        return keys if self.hot is None else [*keys, SLICE]

    def hot_rows(self) -> DataFrame:
        return self.df.join(self.hot, self.keys, "left_semi")

    def done(self) -> DataFrame:
        return self.df if self.hot is None else self.df.drop(SLICE)


def slice_hot(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int | None = HOT_ROWS, once: bool = False
) -> Sliced:
    """Measure the keys with one narrow aggregation, then cut the hot ones by rank.

    `hot_rows=None` skips the measurement. The hot keys are written to the shared
    scratch folder, so their size is known to the optimizer, which broadcasts them
    below its threshold and joins them by shuffle above it. Where a key has few slices, each row is
    compared with their starts; where it has many, it joins its own place, so the work of a row does not
    grow with the key. With `once` the rows are written with their slices, for several windows: each carry reads
    them anew, and where there are many keys that join sends whole rows across the network.
    """
    if hot_rows is None:
        return Sliced(df, keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    if most <= hot_rows:
        return Sliced(dealt(df, keys, rows), keys)
    hot = written(hot_keys(df, keys, hot_rows), "hot-keys")
    placed = placed_rows(df, keys, order, hot, hot_rows)
    place = F.struct(*order)
    starts = placed.filter("__starts_slice")
    if starts.groupBy(*keys).count().agg(F.max("count")).first()[0] <= _STARTS:
        starts = starts.groupBy(*keys).agg(F.array_distinct(F.array_sort(F.collect_list("__place"))).alias("__starts"))
        number = F.size(F.filter("__starts", lambda s: s <= place)) - 1
        sliced = df.join(written(starts, "slice-starts"), keys, "left").withColumn(SLICE, F.coalesce(number.cast("bigint"), F.lit(0))).drop("__starts")
        return Sliced(dealt(written(sliced, "sliced") if once else sliced, [*keys, SLICE], rows), keys, hot)
    # Rows of one place go with the first of them.
    numbers = written(placed.groupBy(*keys, "__place").agg(F.min("__number").alias(SLICE)), "slices")
    sliced = df.withColumn("__place", place).join(numbers, [*keys, "__place"], "left").drop("__place")
    sliced = sliced.withColumn(SLICE, F.coalesce(SLICE, F.lit(0))).select(*df.columns, SLICE)
    return Sliced(dealt(written(sliced, "sliced") if once else sliced, [*keys, SLICE], rows), keys, hot)


def with_previous(
    sliced: Sliced, keys: list[str], order: list[str], columns: list[str]
) -> Sliced:
    """Add `prev_<column>`: the values of the row before this one in its key.

    `keys` holds at least the columns the table was sliced by. The added `prev_row`
    is false exactly for the first row of a key.
    """
    df = sliced.df
    window = Window.partitionBy(*sliced.window_keys(keys)).orderBy(*order)
    lags = {f"prev_{name}": F.lag(name).over(window) for name in columns}
    local = df.withColumns({"prev_row": F.lag(F.lit(True), 1, False).over(window), **lags})
    if sliced.hot is None:
        return sliced.replace(local)

    # Last row of each slice of the hot keys, handed to their next slice.
    place = F.struct(*order)
    tails = sliced.hot_rows().groupBy(*keys, SLICE).agg(
        F.lit(True).alias("__carry_row"),
        *[F.max_by(name, place).alias(f"__carry_{name}") for name in columns],
    )
    forward = F.lead(SLICE).over(Window.partitionBy(*keys).orderBy(SLICE))
    carry = tails.withColumn(SLICE, forward).filter(F.col(SLICE).isNotNull())

    out = local.join(carry, [*keys, SLICE], "left")
    merged = {
        f"prev_{name}": F.when(~F.col("prev_row"), F.col(f"__carry_{name}"))
        .otherwise(F.col(f"prev_{name}"))
        for name in columns
    }
    merged["prev_row"] = F.col("prev_row") | F.coalesce("__carry_row", F.lit(False))
    out = out.withColumns(merged).drop("__carry_row", *[f"__carry_{n}" for n in columns])
    return sliced.replace(out)


def with_running(
    sliced: Sliced,
    keys: list[str],
    order: list[str],
    *,
    last: dict[str, Column] | None = None,
    first: dict[str, Column] | None = None,
    sums: dict[str, Column] | None = None,
) -> Sliced:
    """Add running columns over the rows of a key up to and including this one.

    `last` and `first` take the latest or earliest non-null value so far, `sums`
    the running total.
    """
    last, first, sums = last or {}, first or {}, sums or {}
    inputs = {f"__in_{name}": expr for name, expr in (last | first | sums).items()}
    base = sliced.df.withColumns(inputs)
    window = (
        Window.partitionBy(*sliced.window_keys(keys))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = {n: F.last(f"__in_{n}", ignorenulls=True).over(window) for n in last}
    local |= {n: F.first(f"__in_{n}", ignorenulls=True).over(window) for n in first}
    local |= {n: F.coalesce(F.sum(f"__in_{n}").over(window), F.lit(0)) for n in sums}
    out = base.withColumns(local)
    if sliced.hot is None:
        return sliced.replace(out.drop(*inputs))

    place = F.struct(*order)

    def placed(name: str) -> Column:
        return F.when(F.col(f"__in_{name}").isNotNull(), place)

    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = [F.max_by(f"__in_{n}", placed(n)).alias(f"__t_{n}") for n in last]
    totals += [F.min_by(f"__in_{n}", placed(n)).alias(f"__t_{n}") for n in first]
    totals += [F.sum(f"__in_{n}").alias(f"__t_{n}") for n in sums]
    carries = {f"__c_{n}": F.last(f"__t_{n}", ignorenulls=True).over(before) for n in last}
    carries |= {f"__c_{n}": F.first(f"__t_{n}", ignorenulls=True).over(before) for n in first}
    carries |= {f"__c_{n}": F.sum(f"__t_{n}").over(before) for n in sums}
    carry = (
        sliced.replace(base).hot_rows().groupBy(*keys, SLICE).agg(*totals)
        .withColumns(carries).select(*keys, SLICE, *carries)
    )
    out = out.join(carry, [*keys, SLICE], "left")
    merged = {n: F.coalesce(F.col(n), F.col(f"__c_{n}")) for n in last}
    merged |= {n: F.coalesce(F.col(f"__c_{n}"), F.col(n)) for n in first}
    merged |= {n: F.col(n) + F.coalesce(F.col(f"__c_{n}"), F.lit(0)) for n in sums}
    return sliced.replace(out.withColumns(merged).drop(*carries, *inputs))


def keep_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key.

    The rank limit is applied before the shuffle as well as after it, so a key that
    holds a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")

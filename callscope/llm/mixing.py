"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. What the target holds of whole multiples of the
source is allocated first, as certain whole copies of every document. The rest is a sample of
fixed size without replacement and with unequal probabilities: a document's inclusion
probability is `min(1, c * measure)`, where `c` makes the expected words equal to the rest. A
document's rank is its random odds u / (1 - u) divided by its inclusion odds p / (1 - p); the
documents of lowest rank are taken, until the words taken are as near to the rest as they get.
`u` is a hash of doc_id, so reruns agree.

The measure is the share of distinct words in a text, in hundredths: text that repeats itself
is taken less often.

Scale: the text is read once into a narrow table. All per-source sums are pre-aggregated, over
100 measure levels, then over 2^14 bins of the rank; only the one bin of a source in which the
cut falls is ordered. One row a source comes to the driver, at most `MAX_SOURCES`.

Cases: a null source is a source of its own, last in order; null and empty texts have no words
and are never taken; an empty table gives an empty table. Rows with one doc_id and measure share
their rank, and are taken or left together, as repeated rows are; the cut then lands as near as
it can. A null doc_id is treated like an empty one. Very long texts count whole.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from callscope.llm.common import WORD, materialise, read_table, spare_name
from callscope.llm.registry import register

#: One row for each source comes to the driver.
MAX_SOURCES = 1_000_000
LEVELS = 100
BINS = 1 << 14
SEED = "mix-1"

_SCALE = float(1 << 52)


def spread_targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...], total: float, cap: float) -> list[float]:
    """Shares of `total` by weight, none above `cap` times its size; the excess goes to the others by weight.

    `sizes` are in order; the weights repeat along them.
    """
    entries = [(weights[i % len(weights)], n, i) for i, (_, n) in enumerate(sizes)]
    targets = [0.0] * len(sizes)
    full, open_weight = 0, sum(w for w, _, _ in entries)
    order = sorted(entries, key=lambda e: (e[1] / e[0], e[2]))
    for at, (weight, size, _) in enumerate(order):
        level = (total - cap * full) / open_weight
        if cap * size > weight * level:
            for w, _, i in order[at:]:
                targets[i] = w * level
            break
        targets[order[at][2]] = float(cap * size)
        full += size
        open_weight -= weight
    return targets


def text_measures(text: Column) -> Column:
    """struct<size, level>: words, and 1 to LEVELS for the share of distinct ones."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)
    return F.transform(
        F.array(words),
        lambda w: F.struct(
            F.size(w).cast("long").alias("size"),
            F.greatest(F.lit(1), F.ceil(F.size(F.array_distinct(w)) * LEVELS / F.greatest(F.size(w), F.lit(1)))).cast("int").alias("level"),
        ),
    )[0]


def _uniform(doc_id: Column, seed: str) -> Column:
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("/" + seed)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(_SCALE)


def _rank(doc_id: Column, level: Column, factor: Column, seed: str) -> Column:
    """Random odds over inclusion odds; 0 for documents that are certain."""
    u, p = _uniform(doc_id, seed), factor * level
    return F.when(p >= 1, F.lit(0.0)).when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2, seed: str = SEED) -> DataFrame:
    """`docs` with `size`, `source_size`, `target` (both of the source) and `copies`.

    Columns of these names in `docs` are replaced. No document gets more than `cap` copies.
    """
    spark = docs.sparkSession
    added = ("size", "source_size", "target", "copies")
    rows = docs.select(*[c for c in docs.columns if c.lower() not in added])
    narrow = materialise(
        rows.select("doc_id", "source", text_measures(F.col("text")).alias("m")).select("doc_id", "source", "m.size", "m.level"), "mix-sizes"
    )

    by_level = materialise(narrow.groupBy("source", "level").agg(F.sum("size").alias("words")), "mix-levels")
    found = by_level.groupBy("source").agg(F.sum("words").alias("source_size"))
    totals = found.limit(MAX_SOURCES + 1).collect()
    if len(totals) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # Code point order is the order of the UTF-8 bytes; null comes last.
    sizes = sorted(((r.source, r.source_size) for r in totals), key=lambda s: (s[0] is None, (s[0] or "").encode("utf-8", "surrogatepass")))
    targets = spread_targets(sizes, weights, share * sum(n for _, n in sizes), cap)
    plan = spark.createDataFrame(
        [(s, n, t, int(t // n) if n else 0, t - (t // n) * n if n else 0.0) for (s, n), t in zip(sizes, targets, strict=True)],
        "source string, source_size long, target double, whole int, rest double",
    )

    # The factor c of the inclusion probabilities: levels above some level are certain.
    falling = W.partitionBy("source").orderBy(F.desc("level"))
    rising = W.partitionBy("source").orderBy("level")
    same = F.col("l.source").eqNullSafe(F.col("p.source"))
    levels = (
        by_level.alias("l").join(plan.alias("p"), same).select("l.source", "level", "words", "rest")
        .withColumn("certain", F.sum("words").over(falling) - F.col("words"))
        .withColumn("weighted", F.sum(F.col("words") * F.col("level")).over(rising))
        .withColumn("factor", (F.col("rest") - F.col("certain")) / F.col("weighted"))
    )
    factors = levels.filter("weighted > 0 AND factor > 0 AND factor * level <= 1").groupBy("source").agg(F.max_by("factor", "level").alias("factor"))
    plan = materialise(
        plan.alias("p").join(factors.alias("l"), same, "left").select("p.*", F.coalesce("l.factor", F.when(F.col("rest") > 0, 1.0).otherwise(0.0)).alias("factor")), "mix-plan"
    )

    # The cut: words by bin of the rank, then the order inside the bin where the rest is reached.
    same = F.col("l.source").eqNullSafe(F.col("p.source"))
    ranked = (
        narrow.filter("size > 0").alias("l").join(plan.filter("rest > 0").alias("p"), same)
        .select("l.source", "size", "rest", _rank(F.col("doc_id"), F.col("level"), F.col("factor"), seed).alias("rank"))
        .filter("rank IS NOT NULL")
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS).cast("int"))
    )
    along = W.partitionBy("source").orderBy("bin")
    cut_bin = (
        ranked.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        .withColumn("before", F.sum("words").over(along) - F.col("words"))
        .filter("before < rest").groupBy("source").agg(F.max("bin").alias("bin"), F.max("before").alias("before"))
    )
    inside = (
        ranked.alias("r").join(cut_bin.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bin") == F.col("b.bin")))
        .groupBy("r.source", "rank").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("before").alias("before"))
    )
    upto = inside.withColumn("taken", F.col("before") + F.sum("words").over(W.partitionBy("source").orderBy("rank")))
    # A document is in if the words taken end nearer to the rest with it than without it.
    cuts = upto.filter("taken - rest <= rest - (taken - words)").groupBy("source").agg(F.max("rank").alias("last"))
    floors = cut_bin.select("source", (F.col("bin") / BINS).alias("floor"))
    final = (
        plan.alias("p").join(cuts.alias("l"), same, "left").select("p.*", "l.last").alias("p")
        .join(floors.alias("l"), same, "left").select("p.*", "l.floor")
    )
    final = materialise(final, "mix-cuts")

    size, level = spare_name(rows, "mix_size"), spare_name(rows, "mix_level")
    measured = rows.withColumn(size, text_measures(F.col("text"))).withColumn(level, F.col(f"{size}.level")).withColumn(size, F.col(f"{size}.size"))
    rank = _rank(F.col("d.doc_id"), F.col(f"d.{level}"), F.col("p.factor"), seed)
    below = F.floor(rank / (1 + rank) * BINS) < F.col("p.floor") * BINS
    taken = F.coalesce((F.col(f"d.{size}") > 0) & (F.col("p.rest") > 0) & (below | (rank <= F.col("p.last"))), F.lit(False))
    copies = F.when(F.col(f"d.{size}") > 0, F.col("p.whole") + taken.cast("int")).otherwise(0)
    return measured.alias("d").join(final.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))).select(
        *[F.col(f"d.`{c}`") for c in rows.columns], F.col(f"d.{size}").alias("size"), "p.source_size", "p.target", copies.alias("copies")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of `docs`."""
    names = [c for c in docs.columns if c.lower() not in ("size", "source_size", "target", "copies")]
    if len(names) < len(docs.columns):  # columns of the operator's own names come back under theirs
        keep = {c: spare_name(docs, f"kept_{c}") for c in docs.columns if c not in names}
        back = {v: k for k, v in keep.items()}
        return mixed_rows(docs.withColumnsRenamed(keep), **options).withColumnsRenamed(back).select(*docs.columns)
    repeated = mix(docs, **options).filter("copies > 0")
    copy = spare_name(docs, "copy")
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns)


_SQL = f"""WITH words AS (SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
narrow AS (SELECT doc_id, source, CAST(len(w) AS BIGINT) AS size,
    CAST(greatest(1, ceil(len(list_distinct(w)) * CAST({LEVELS} AS DOUBLE) / greatest(len(w), 1))) AS BIGINT) AS level FROM words),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END) AS weight FROM narrow GROUP BY source),
waters AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())
      - 2 * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sources),
flat AS (SELECT min_by(level, source_size / weight) AS level FROM waters WHERE 2 * source_size > weight * level),
plan AS (SELECT source, source_size, least(2 * source_size, coalesce(weight * (SELECT level FROM flat), 2 * source_size))::DOUBLE AS target FROM sources),
rests AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM plan),
rest AS (SELECT *, target - whole * source_size AS rest FROM rests),
levels AS (SELECT n.source, level, sum(size) AS words FROM narrow n GROUP BY ALL),
sums AS (SELECT l.source, level, rest, sum(words) OVER (PARTITION BY l.source ORDER BY level DESC) - words AS certain,
    sum(words * level) OVER (PARTITION BY l.source ORDER BY level) AS weighted FROM levels l JOIN rest r ON l.source IS NOT DISTINCT FROM r.source),
factors AS (SELECT source, max_by((rest - certain) / weighted, level) AS factor FROM sums
  WHERE weighted > 0 AND (rest - certain) / weighted > 0 AND (rest - certain) / weighted * level <= 1 GROUP BY source),
chances AS (SELECT n.*, source_size, target, whole, rest, coalesce(f.factor, CASE WHEN rest > 0 THEN 1.0 ELSE 0.0 END) * level AS p,
    (CAST('0x' || left(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/{SEED}'), 13) AS BIGINT) + 0.5::DOUBLE) / {_SCALE} AS u
  FROM narrow n JOIN rest r ON n.source IS NOT DISTINCT FROM r.source LEFT JOIN factors f ON n.source IS NOT DISTINCT FROM f.source),
ranks AS (SELECT *, CASE WHEN p >= 1 THEN 0.0 WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank FROM chances),
ties AS (SELECT source, rank, rest, sum(size) AS words FROM ranks WHERE size > 0 AND rest > 0 AND rank IS NOT NULL GROUP BY ALL),
sofar AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY rank) AS taken FROM ties),
cuts AS (SELECT source, max(rank) AS last FROM sofar WHERE taken - rest <= rest - (taken - words) GROUP BY source)
SELECT r.doc_id, r.size, r.source_size, r.target,
  CAST(r.size * (r.whole + CASE WHEN r.size > 0 AND r.rest > 0 AND r.rank <= c.last THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ranks r LEFT JOIN cuts c ON r.source IS NOT DISTINCT FROM c.source"""


@register("op1_pareto_mixing", _SQL)
def op1_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return mix(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

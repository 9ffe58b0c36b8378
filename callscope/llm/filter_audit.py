"""Filter interaction audit: what every order of five quality filters removes, step by step.

A document's failures of the filters A to E are one mask of five bits. Documents are counted by
(part, mask), the mask cells: 32 a part at most, whatever the number of documents. Each cell then
folds across the array of all orders: `transform` goes through the orders and `aggregate` through
the filters of one, and gives a struct for each of the 600 steps, weighted with the cell's
documents. The cells of a part are merged by sums of the arrays, element by element.

Filters (failure conditions): A fewer than 50 words; B fewer than 65 distinct words in 100;
C more than 5 capitals A-Z in 100 code points; D one of `#$%&*|`; E the text of a smaller doc_id.

Scale: the texts are read once, into a narrow table of (doc_id, part, mask, digest). The first
holder of a text is found by a pre-aggregated minimum, and looked up by (digest, doc_id), so that
a text that a third of all documents hold is spread over all tasks. What is folded, shuffled by
part and exploded does not grow with the documents.

Cases: a null text is empty and a null source the part ''; a null doc_id is never later than
another (E passes), has no label and makes no other document fail; several rows with one doc_id
are documents each, all with the first holder's right; several labels of one doc_id count as one
that has any of their marks; empty tables give an empty table; extra columns are ignored.
"""

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import WORD, materialise, read_table
from callscope.llm.registry import register

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT = 65
MAX_CAPITALS = 5
MARKS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column) -> dict[str, Column]:
    """The conditions on one text; E needs all the others."""
    words = F.regexp_extract_all(text, F.lit(WORD), 0)
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    return {
        "A": F.size(words) < MIN_WORDS,
        "B": F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * MIN_DISTINCT,
        "C": capitals.cast("long") * 100 > F.length(text).cast("long") * MAX_CAPITALS,
        "D": text.rlike(MARKS),
    }


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def masked(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest) of each document, without filter E."""
    text = F.coalesce("text", F.lit(""))
    bits = [F.when(fails, _bit(letter)).otherwise(0) for letter, fails in failures(text).items()]
    return docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), sum(bits[1:], bits[0]).alias("mask"), F.unhex(F.sha2(text, 256)).alias("digest")
    )


def mask_cells(narrow: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each mask, and those with labels."""
    known = narrow.filter("doc_id IS NOT NULL")
    first = known.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")
    )
    seen = known.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    mask = F.col("mask") + F.when(F.col("is_first"), 0).otherwise(_bit("E"))
    rows = seen.select("part", mask.alias("mask"), F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    nameless = narrow.filter("doc_id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return rows.union(nameless).groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))


def orders() -> list[str]:
    return ["".join(p) for p in permutations(FILTERS)]


def fold(cell: Column, order_array: Column) -> Column:
    """One struct of COUNTS for each step of each order, weighted with the cell's documents."""
    mask = cell["mask"]

    def step(state: Column, bit: Column) -> Column:
        fails = mask.bitwiseAND(bit) != 0
        gone = state["alive"] & fails

        def weighted(weight: str, condition: Column) -> Column:
            return F.when(condition, cell[weight]).otherwise(F.lit(0).cast("long"))

        now = F.struct(
            weighted("n", state["alive"] & ~fails).alias("kept"),
            weighted("n", gone).alias("removed"),
            weighted("n", fails & ~state["alive"]).alias("redundant"),
            weighted("n", mask == bit).alias("unique_fails"),
            weighted("good", gone).alias("good_lost"),
            weighted("toxic", gone).alias("toxic_lost"),
        )
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(now)).alias("steps"))

    steps = ", ".join(f"{c}: bigint" for c in COUNTS)
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<struct<{steps}>>").alias("steps"))
    return F.flatten(F.transform(order_array, lambda order: F.aggregate(order, start, step, lambda done: done["steps"])))


def merged(cells: Column, order_array: Column, steps: int) -> Column:
    """The folds of all cells of an array, summed element by element."""
    nothing = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in COUNTS]), steps)

    def add(a: Column, b: Column) -> Column:
        return F.struct(*[(a[c] + b[c]).alias(c) for c in COUNTS])

    return F.aggregate(cells, nothing, lambda total, cell: F.zip_with(total, fold(cell, order_array), add))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step, with COUNTS and each filter's `shapley` sum."""
    cells = mask_cells(materialise(masked(docs), "filter-masks"), labels)
    names = orders()
    spelled = F.array(*[F.lit(n) for n in names])
    by_letter = F.create_map(*[F.lit(x) for letter in FILTERS for x in (letter, _bit(letter))])
    bits = F.transform(spelled, lambda name: F.transform(F.split(name, ""), lambda letter: by_letter[letter]))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    width = len(FILTERS)
    folded = parts.select("part", merged(F.col("cells"), bits, len(names) * width).alias("sums"))
    rows = folded.select("part", "sums", F.posexplode("sums").alias("at", "step_counts")).select(
        "part", F.element_at(spelled, F.floor(F.col("at") / width).cast("int") + 1).alias("filter_order"), (F.col("at") % width + 1).alias("step"), "step_counts.*"
    )
    rows = rows.withColumn("letter", F.col("filter_order").substr(F.col("step"), F.lit(1)))
    # One row for each part and filter; both sides are 600 rows a part.
    shapley = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(shapley, ["part", "letter"]).select("part", "filter_order", "step", *COUNTS, "shapley")


_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
  firsts AS (SELECT text, min(doc_id) AS first_id FROM d GROUP BY text),
  marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
  f AS (SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
      100 * (length(d.text) - length(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 5 * length(d.text) AS c,
      regexp_matches(d.text, '[#$%&*|]') AS d, coalesce(d.doc_id > first_id, false) AS e, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM d JOIN firsts ON d.text = firsts.text LEFT JOIN marks ON d.doc_id = marks.doc_id),
  cells AS (SELECT part, [a, b, c, d, e] AS fails, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY ALL),
  letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
  orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
  steps AS (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders),
  judged AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic,
      fails[ascii(substr(filter_order, step, 1)) - 64] AS fail,
      len(list_filter(range(1, step), lambda i: fails[ascii(substr(filter_order, i::BIGINT, 1)) - 64])) > 0 AS gone,
      len(list_filter(fails, lambda x: x)) = 1 AS alone FROM cells, steps),
  summed AS (SELECT part, filter_order, step, letter, coalesce(sum(n) FILTER (WHERE NOT fail AND NOT gone), 0) AS kept,
      coalesce(sum(n) FILTER (WHERE fail AND NOT gone), 0) AS removed, coalesce(sum(n) FILTER (WHERE fail AND gone), 0) AS redundant,
      coalesce(sum(n) FILTER (WHERE fail AND alone), 0) AS unique_fails, coalesce(sum(good) FILTER (WHERE fail AND NOT gone), 0) AS good_lost,
      coalesce(sum(toxic) FILTER (WHERE fail AND NOT gone), 0) AS toxic_lost FROM judged GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM summed
"""


@register("op13_filter_audit", _SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))

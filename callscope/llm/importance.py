"""Importance resampling towards a target: hashed n-gram odds and Gumbel keys.

A text is brought to one line of words with single spaces, and one overlapped regex scan emits,
at each word, the spans of the n-grams that begin there. A span is counted by its CRC-32 without
being joined or sliced out: the checksum of "a b" continues that of "a". Buckets of the checksums
are counted over all documents and over the target texts; a bucket's gain is the log of the ratio
of their smoothed odds, a document's weight the mean gain of its features. Adding a Gumbel
variate to the weights and taking the highest scores draws without replacement with odds
proportional to the exponential of the weight.

Scale: every text is scanned once; the buckets of its features, two bytes each, are written to the
scratch folder and read again for the weights. Tasks count buckets in arrays of fixed size, so
that what crosses the network is one row for each bucket and task, and the driver gets one row
for each bucket. Scores are ranked by ranges of narrow rows, not in one task.

Cases: a null or empty text, and one without words, has no features and weight 0; texts are worked
through whole, in blocks; a null doc_id hashes like the empty string and comes last among equal
scores; rows with one doc_id are drawn each for itself, and equal ones are interchangeable; an
empty table gives an empty table; no target texts give gains of plain smoothing; extra columns
are ignored.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, ordered_rows, read_table, shuffle_partitions
from callscope.llm.registry import register

BUCKETS = 10_000
LENGTH = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
#: Features whose buckets are held at a time.
_BLOCK = 1 << 16

#: A-Z in lower case; ASCII but letters and digits to a space.
_TO_LINE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SPACES = regex.compile(rb" {2,}")


def one_line(text: str | None) -> bytes:
    """The words of a text with single spaces."""
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    return _SPACES.sub(b" ", raw.translate(_TO_LINE)).strip(b" ")


def ngram_pattern(length: int) -> regex.Pattern:
    """Matches at each word when overlapped; group i is what the i-th word adds to an n-gram."""
    more = b""
    for _ in range(length - 1):
        more = rb"(?:( [^ ]++)(?![^ ])" + more + rb")?"
    return regex.compile(rb"(?<![^ ])([^ ]++)(?![^ ])" + more)


def feature_buckets(line: bytes, pattern: regex.Pattern, buckets: int) -> Iterator[np.ndarray]:
    """The buckets of all n-grams of a line, in blocks."""
    crc, block = zlib.crc32, []
    for match in pattern.finditer(line, overlapped=True):
        code = 0
        for part in match.groups():
            if part is None:
                break
            code = crc(part, code)
            block.append(code)
        if len(block) >= _BLOCK:
            yield np.array(block, dtype=np.int64) % buckets
            block = []
    if block:
        yield np.array(block, dtype=np.int64) % buckets


def _scan(length: int, buckets: int):
    """Tasks from (id, text) to (id, n_words, features): buckets as two or four bytes each."""
    kind = _kind(buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = ngram_pattern(length)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                words, features = [], []
                for text in part.column(1):
                    line = one_line(text.as_py())
                    words.append(line.count(b" ") + 1 if line else 0)
                    features.append(b"".join([block.astype(kind).tobytes() for block in feature_buckets(line, pattern, buckets)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words, pa.int64()), pa.array(features, pa.binary())], ["doc_id", "n_words", "features"]
                )

    return rows


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def scanned(texts: DataFrame, doc_id: Column, length: int = LENGTH, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, features) of `texts` (text), in the scratch folder."""
    narrow = texts.select(doc_id.cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(narrow.mapInArrow(_scan(length, buckets), "doc_id long, n_words long, features binary"), "ngram-buckets")


def bucket_counts(features: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows."""
    kind = _kind(buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for cell in batch.column(0):
                total += np.bincount(np.frombuffer(cell.as_buffer(), dtype=kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, dtype=np.int64)
    for row in features.select("features").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target odds over source odds) of each bucket, in doubles."""
    n = float(len(source))
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain, 0 without features."""
    kind = _kind(len(gain))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(cell.as_buffer(), dtype=kind) for cell in batch.column(2)]
            weights = [int(gain[f].sum()) // len(f) if len(f) else 0 for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(f) for f in found], pa.int64()), pa.array(weights, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """1,000 times a Gumbel variate of the id, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, length: int = LENGTH, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of `docs` (doc_id, text); `target` has text.

    `percent` of the documents of `min_words` or more are drawn; the others' rank is null.
    """
    spark = docs.sparkSession
    features = scanned(docs, F.col("doc_id"), length, buckets)
    wanted = scanned(target, F.lit(None), length, buckets)
    gain = gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets))
    rows = materialise(weighted(features, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "resampling-scores")
    long_enough = rows.filter(F.col("n_words") >= min_words).withColumn("tie", F.monotonically_increasing_id())
    keys = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("tie")]
    placed, n = ordered_rows(long_enough, shuffle_partitions(spark), *keys)
    rank = F.when(F.col("position") < percent * n // 100, F.col("position") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    others = rows.filter(F.col("n_words") < min_words)
    return placed.select(*columns, rank.alias("rank")).union(others.select(*columns, F.lit(None).cast("long")))


_SQL = """
WITH nibbles AS (SELECT list(crc ORDER BY i) AS step FROM (SELECT i, list_reduce([i::UBIGINT, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS crc FROM range(16) r(i))),
  texts AS (SELECT 'd' AS side, doc_id, row_number() OVER () AS n, text FROM documents UNION ALL SELECT 'b', NULL, row_number() OVER (), text FROM benchmark),
  lines AS (SELECT side, doc_id, n, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
  grams AS (SELECT side, n, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS gram FROM lines),
  counted AS (SELECT side, n, gram, count(*) AS k FROM grams GROUP BY ALL),
  codes AS (SELECT gram, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(regexp_replace(hex(encode(gram)), '(.)(.)', '\\2\\1', 'g'), ''),
      lambda x: (strpos('0123456789ABCDEF', x) - 1)::UBIGINT)), lambda c, x: xor(c >> 4, step[(xor(c, x) & 15)::INTEGER + 1])), 4294967295::UBIGINT) % 10000 AS bucket
    FROM (SELECT DISTINCT gram FROM counted), nibbles),
  hashed AS (SELECT side, n, bucket, sum(k) AS k FROM counted JOIN codes USING (gram) GROUP BY ALL),
  buckets AS (SELECT bucket, coalesce(sum(k) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s, coalesce(sum(k) FILTER (WHERE side = 'b'), 0)::DOUBLE AS t FROM hashed GROUP BY bucket),
  gain AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM buckets) + 10000) / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000))))::BIGINT AS g FROM buckets),
  sums AS (SELECT n, sum(k)::BIGINT AS n_features, sum(k * g)::BIGINT AS total FROM hashed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY n),
  scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0) AS weight,
      ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM lines LEFT JOIN sums USING (n) WHERE side = 'd'),
  final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
  ranked AS (SELECT *, row_number() OVER (ORDER BY n_words < 20, score DESC, doc_id NULLS LAST, n_features) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS big FROM final)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * big // 100 THEN place END AS rank FROM ranked
"""


@register("op12_importance_resampling", _SQL)
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))

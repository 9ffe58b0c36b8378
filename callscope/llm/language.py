"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, runs of anything but letters become one space, and its character bigrams
and trigrams are hashed into `BUCKETS` features. For every label the model holds the logarithm of
its smoothed share of each feature; a text's score for a label is the log prior plus the sum of
its features' logarithms. The matrix is broadcast; a batch is scored as one sparse row of feature
indices a text, summed by `np.add.reduceat`. The score is the label's posterior probability.

Training reads a bounded sample: about `TRAIN_ROWS` labelled rows of each label, those with the
smallest hash of doc_id, whole texts; rarer labels are used in full. Counts are summed in each
task, then by Spark; `MAX_LABELS` times `BUCKETS` sums come to the driver at most.

Cases: null texts and texts without a letter are `und` with score 0, and so is everything if
there is nothing to learn from; rows without label or text are not learned from; equal scores go to the label
that sorts first; repeated rows are judged alike; an empty table gives an empty table; very long
texts are scored whole, in pieces. Extra columns stay.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import materialise, pieces, read_table, spare_name
from callscope.llm.registry import register

BUCKETS = 1 << 15
#: Labelled rows of one label that the model is fitted on, about.
TRAIN_ROWS = 12_000
MAX_LABELS = 300
SMOOTHING = 0.1
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}\p{M}]+")


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature indices of all texts one after the other, and where each text's begin.

    No n-gram crosses from one text to the next; each text has at least one.
    """
    padded = [f" {_OTHER.sub(' ', t.lower()).strip()} " for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(p) for p in padded], dtype=np.int64)
    ends = np.cumsum(lengths)
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(0xC2B2AE35) + codes[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    shift = np.uint32(32 - (BUCKETS.bit_length() - 1))
    # One slot a character: its bigram and its trigram, where they fit into the text.
    grams = np.full((len(codes), 2), -1, dtype=np.int32)
    grams[:-1, 0] = _mixed(two) >> shift
    grams[:-2, 1] = _mixed(three) >> shift
    grams[ends - 1, :] = -1
    grams[np.maximum(ends - 2, 0), 1] = -1
    flat = grams.ravel()
    fits = flat >= 0
    starts = np.concatenate(([0], np.cumsum(np.add.reduceat(fits, 2 * (ends - lengths)))))[:-1]
    return flat[fits], starts


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return x ^ (x >> np.uint32(13))


class Model:
    """Labels in order and the matrix of their features' log probabilities."""

    def __init__(self, labels: list[str], documents: list[int], counts: np.ndarray):
        self.labels = labels
        smooth = counts + SMOOTHING
        self.matrix = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        self.prior = np.log(np.array(documents, dtype=np.float64) / max(1, sum(documents)))

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Label and posterior of texts that have a letter."""
        if not self.labels:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        found, starts = features(texts)
        scores = np.stack([np.add.reduceat(row[found], starts) for row in self.matrix], axis=1) + self.prior
        best = scores.argmax(axis=1)
        posterior = 1.0 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.labels[b] for b in best], posterior.tolist()


COUNTS = "label string, bucket int, n long"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Feature counts by label of all rows of a task; bucket -1 counts the documents."""
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        labels, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for start, end in pieces([len(t) for t in texts]):
            found, starts = features(texts[start:end])
            sizes = np.diff(np.append(starts, len(found)))
            order = {}
            owner = np.repeat([order.setdefault(x, len(order)) for x in labels[start:end]], sizes)
            both = np.bincount(owner * BUCKETS + found, minlength=len(order) * BUCKETS)
            for label, k in order.items():
                held = totals.setdefault(label, np.zeros(BUCKETS + 1, dtype=np.int64))
                held[:BUCKETS] += both[k * BUCKETS:(k + 1) * BUCKETS]
                held[BUCKETS] += labels[start:end].count(label)
    for label, held in totals.items():
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([label] * len(used)), pa.array(np.where(used == BUCKETS, -1, used), pa.int32()), pa.array(held[used], pa.int64())],
            ["label", "bucket", "n"],
        )


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model from `labelled` (doc_id, text, lang); `rows` bounds the sample of each label."""
    spark = labelled.sparkSession
    usable = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    sizes = {r.lang: r.n for r in usable.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LABELS + 1).collect()}
    if len(sizes) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    if not sizes:
        return Model([], [], np.zeros((0, BUCKETS)))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, rows / n))])
    # 53 bits of a hash as a fraction: rows below their label's share are in the sample.
    fraction = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), "doc_id"), 11) / F.lit(float(1 << 53))
    sample = usable.filter(fraction < share[F.col("lang")]).select("lang", "text")
    counted = sample.mapInArrow(_count, COUNTS).groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    table = materialise(counted, "language-counts").toArrow()
    labels = sorted(set(table["label"].to_pylist()), key=lambda x: x.encode("utf-8", "surrogatepass"))
    place = {label: i for i, label in enumerate(labels)}
    at = np.array([place[x] for x in table["label"].to_pylist()], dtype=np.int64)
    bucket, n = table["bucket"].to_numpy(), table["n"].to_numpy()
    counts = np.zeros((len(labels), BUCKETS + 1), dtype=np.float64)
    counts[at, bucket] = n  # bucket -1 is the last column
    return Model(labels, [sizes[x] for x in labels], counts[:, :BUCKETS])


def identify(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with a struct column (lang_pred, score), and the column's name."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    column = spare_name(docs, "identified")

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        labels, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        usable = [(i, t) for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
        for start, end in pieces([len(t) for _, t in usable]):
            found = held.value.predict([t for _, t in usable[start:end]])
            for (i, _), label, score in zip(usable[start:end], *found, strict=True):
                labels[i], scores[i] = label, score
        return pd.DataFrame({"lang_pred": labels, "score": scores})

    return docs.withColumn(column, predict(F.col(text))), column


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5: 0 is held out of training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5


def fitted(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    return train(docs.filter(remainder(F.col("doc_id")) != 0), rows)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """`docs` without rows of unknown language or with a score below `least`."""
    found, at = identify(docs, model)
    return found.filter((F.col(f"{at}.lang_pred") != UNKNOWN) & (F.col(f"{at}.score") >= least)).select(*docs.columns)


@register("op6_language_bayes")
def op6_language_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found, at = identify(docs.select("doc_id", "text"), fitted(docs))
    return found.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), f"{at}.lang_pred", f"{at}.score")

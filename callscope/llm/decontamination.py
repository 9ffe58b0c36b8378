"""Benchmark decontamination with a broadcast hash set of normalised n-grams.

Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case. The
windows of an item are its runs of `WINDOW` consecutive words; a shorter item is one window. The
items' words are numbered, their windows are kept as sorted 64-bit hashes next to the windows
themselves, and all of it is broadcast. A task numbers the words of its texts (words that no
item has break windows), rolls the hash over them, looks all hashes of a text up at once, and
verifies every hit word by word. Words inside any occurrence of a window are hit.

Scale: documents are read in place, nothing is shuffled. What is broadcast is the benchmark,
which does not grow with the corpus, and its size is checked: a benchmark of more than `MAX_WINDOWS`
windows is refused, and can be run in parts, one after the other.

Cases: a null text or item has no words; an item without words has no windows; rows of the
benchmark that share an item_id are one item; windows of an item without id mark words, but the
item is neither listed nor counted. Repeated documents are judged alike. An empty table of
documents gives an empty table, an empty benchmark leaves all clean.
"""

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope.llm.common import read_table, spare_name
from callscope.llm.registry import register

WINDOW = 10
#: Windows that are broadcast at most: about 200 bytes each.
MAX_WINDOWS = 1_000_000
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.translate(_LOWER)) if text else []


def _hashes(numbers: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of `length` word numbers."""
    n = len(numbers) - length + 1
    out = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(length if n > 0 else 0):
        out = out * _BASE + numbers[i:i + n]
    out ^= out >> np.uint64(29)
    return out * _BASE


class WindowSet:
    """The windows of some items, by length."""

    def __init__(self, items: list[tuple[str | None, list[str]]], window: int = WINDOW):
        self.numbers: dict[str, int] = {}
        owners: dict[int, dict[tuple[int, ...], set[str | None]]] = {}
        for item, words in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]
            length = min(window, len(ids))
            for at in range(len(ids) - length + 1 if length else 0):
                owners.setdefault(length, {}).setdefault(tuple(ids[at:at + length]), set()).add(item)
        self.owners = owners
        self.hashes = {
            length: np.sort(_hashes(np.array([x for run in runs for x in run], dtype=np.uint64), length)[::length])
            for length, runs in owners.items()
        }
        # One bit for each value of the hashes' upper 22 bits: most words end here.
        self.maps = {}
        for length, hashes in self.hashes.items():
            seen = np.zeros(1 << 22, dtype=bool)
            seen[(hashes >> np.uint64(42)).astype(np.int64)] = True
            self.maps[length] = seen

    def mark(self, words: list[str]) -> tuple[np.ndarray, set[str | None]]:
        """Which words are hit, and the items of the windows found."""
        known = self.numbers.get
        numbers = np.fromiter((known(w, 0) for w in words), dtype=np.uint64, count=len(words))
        hit, items = np.zeros(len(words), dtype=bool), set()
        unknown = np.concatenate(([0], np.cumsum(numbers == 0)))
        for length, hashes in self.hashes.items():
            if len(words) < length:
                continue
            whole = np.flatnonzero(unknown[length:] == unknown[:-length])
            if not len(whole):
                continue
            found = _hashes(numbers, length)[whole]
            whole = whole[near := self.maps[length][(found >> np.uint64(42)).astype(np.int64)]]
            found = found[near]
            at = np.searchsorted(hashes, found)
            for start in whole[hashes[np.minimum(at, len(hashes) - 1)] == found].tolist():
                owner = self.owners[length].get(tuple(numbers[start:start + length].tolist()))
                if owner:
                    hit[start:start + length] = True
                    items |= owner
        return hit, items


def window_set(benchmark: DataFrame, window: int = WINDOW, most: int = MAX_WINDOWS) -> WindowSet:
    """The windows of the benchmark, streamed to the driver; more than `most` are refused."""
    held, n = [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).toLocalIterator():
        words = words_of(row.text)
        if words:
            held.append((row.item, words))
            n += max(1, len(words) - window + 1)
        if n > most:
            raise ValueError(f"more than {most} windows to broadcast: run the parts of this benchmark one after the other")
    return WindowSet(held, window)


RESULT = "n_words long, n_hit long, items array<string>, kept string"


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with a struct column of what the scan found, and the column's name.

    n_words, n_hit, items (sorted ids) and kept, the words that are not hit, joined by spaces.
    """
    context = docs.sparkSession.sparkContext
    held = context.broadcast(window_set(benchmark, window))
    column = spare_name(docs, "scan_")

    @F.pandas_udf(RESULT)
    def scan_texts(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for value in texts:
            words = words_of(value)
            hit, items = held.value.mark(words)
            n = int(hit.sum())
            kept = " ".join(w for w, h in zip(words, hit.tolist(), strict=True) if not h) if n else None
            rows.append((len(words), n, sorted((i for i in items if i is not None), key=lambda i: i.encode("utf-8", "surrogatepass")), kept))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "kept"])

    return docs.withColumn(column, scan_texts(F.col(text))), column


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """`docs` without contaminated documents, or (`spans`) with the hit words cut out of their texts.

    A text that loses words is left as its other words, normalised and joined by spaces.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove documents or spans")
    found, at = scan(docs, benchmark, window)
    if remove == "documents":
        return found.filter(F.col(f"{at}.n_hit") == 0).select(*docs.columns)
    text = F.when(F.col(f"{at}.n_hit") > 0, F.col(f"{at}.kept")).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*docs.columns)


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SQL = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, len(x.g) AS k, array_to_string(x.g, ' ') AS g
  FROM (SELECT item_id, unnest([{{'g': w[i + 1 : i + least({WINDOW}, len(w))]}} FOR i IN range(0, greatest(len(w) - {WINDOW}, 0) + 1)]) AS x FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, k, s, array_to_string(w[s + 1 : s + k], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS s FROM d, lens WHERE len(w) >= k)),
hits AS (SELECT doc_id, s, dw.k, item_id FROM dw JOIN bw USING (k, g)),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN found USING (doc_id)"""


@register("op7_decontamination", _SQL)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found, at = scan(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", f"{at}.n_words", f"{at}.n_hit", F.size(f"{at}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{at}.items", ","), 256).alias("items_sha256"), (F.col(f"{at}.n_hit") > 0).alias("contaminated"),
    )

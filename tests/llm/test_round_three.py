"""Embedding links, importance resampling and the filter audit against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from callscope.llm import embedding_links, filter_audit, importance
from callscope.llm.queries import QUERIES
from tests.llm.test_llm import ITEMS, VECTORS, _documents, _prose, hard  # noqa: F401  the fixture

# --- embedding links ---------------------------------------------------------------------------------


def plain_links(rows, cosine=0.95):
    """(vec_id, n_links, component_id, kept) of each row, by all pairs."""
    fits = [i for i, (_, x) in enumerate(rows) if x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by_length = defaultdict(list)
    for i in fits:
        by_length[len(rows[i][1])].append(i)
    for own in by_length.values():
        units = np.array([rows[i][1] for i in own], dtype=np.float64)
        units /= np.abs(units).max(axis=1, keepdims=True)
        units /= np.linalg.norm(units, axis=1)[:, None]
        for a, near in enumerate(units @ units.T >= cosine):
            for b in np.flatnonzero(near):
                if a != b:
                    links[own[a]] += 1
                    parent[top(own[a])] = top(own[b])
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[top(i)] = min(name, least.get(top(i), name))
    component = [least.get(top(i)) for i in range(len(rows))]
    return Counter((name, links[i], component[i], name is not None and name == component[i]) for i, (name, _) in enumerate(rows))


def clusters(seed, groups, size, dims=32):
    """Groups of vectors around a centre each, most of them 0.95 to 0.99 from their neighbours."""
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((groups, dims))
    spread = draw.uniform(0.05, 0.35, (groups, size, 1))
    noise = draw.standard_normal((groups, size, dims))
    return (centres[:, None] + spread * noise).reshape(-1, dims).astype(np.float32)


def as_frame(spark, vectors, ids=None):
    rows = [(int(i), v.tolist()) for i, v in zip(range(len(vectors)) if ids is None else ids, vectors, strict=True)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_hard_vectors(spark, hard):  # noqa: F811
    got = Counter(tuple(r) for r in QUERIES["op11_embedding_multi_index"](spark, hard).collect())
    assert got == plain_links([v[:2] for v in VECTORS])


@pytest.mark.parametrize("block", [4096, 40])
def test_links_through_a_fine_grid(spark, block):
    """Many cells, pairs at the threshold itself, and cells cut into blocks."""
    rows, frame = as_frame(spark, clusters(1, 60, 25))
    got = embedding_links.near_duplicates(frame, occupancy=30, block=block).collect()
    want = plain_links(rows)
    found, there = sum(r.n_links for r in got), sum(k[1] * n for k, n in want.items())
    assert found >= 0.98 * there > 1000
    right = sum((Counter(tuple(r) for r in got) & want).values())
    assert right >= 0.95 * len(rows)


def test_one_dense_cell_is_cut_and_linked_whole(spark):
    vectors = np.vstack([clusters(2, 1, 300), clusters(3, 5, 4)])
    rows, frame = as_frame(spark, np.vstack([vectors, vectors[:200]]))
    got = embedding_links.near_duplicates(frame, occupancy=10_000, block=16)
    assert Counter(tuple(r) for r in got.collect()) == plain_links(rows)


def test_traversal_visits_cells_in_order():
    draw = np.random.default_rng(4)
    a, b = draw.random(9), draw.random(7)
    slack = 0.4
    cost = {(i, j): a[i] + b[j] for i in range(9) for j in range(7)}
    want = sorted((c for c in cost if cost[c] <= min(cost.values()) + slack), key=cost.get)
    assert embedding_links.multi_sequence(a, b, slack) == want and 3 < len(want) < 63


def test_slack_follows_the_target():
    vectors = clusters(5, 400, 2)
    few = [embedding_links.MultiIndex([v.astype("<f8").tobytes() for v in vectors], 800, target=t, occupancy=8) for t in (0.5, 0.99)]
    visits = [np.mean([len(v) for v in index.visits([v.astype("<f8").tobytes() for v in vectors])]) for index in few]
    assert 1 <= visits[0] < visits[1] < 100


# --- importance resampling -----------------------------------------------------------------------------


def plain_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    grams = words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def plain_resample(docs, items):
    counts = [Counter(), Counter()]
    for side, texts in enumerate(([d[1] for d in docs], [i[1] for i in items])):
        for text in texts:
            counts[side].update(plain_features(text)[1])
    total = [sum(c.values()) for c in counts]
    rows = []
    for doc_id, text, *_ in docs:
        n_words, found = plain_features(text)
        gain = [math.floor(1000 * math.log((counts[1][b] + 1.0) * (total[0] + 10_000) / ((counts[0][b] + 1.0) * (total[1] + 10_000)))) for b in found]
        weight = math.floor(sum(gain) / len(gain)) if gain else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n_words])
    long_enough = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for place, row in enumerate(long_enough[:25 * len(long_enough) // 100]):
        row[4] = place + 1
    return Counter(tuple(r[:5]) for r in rows)


def test_resampling_against_a_plain_version(spark, hard):  # noqa: F811
    rows = QUERIES["op12_importance_resampling"](spark, hard).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert Counter(tuple(r) for r in rows) == plain_resample(_documents(), ITEMS)


@pytest.mark.parametrize("text", ["", "one", "Grüße, ÄÖ! x2-y", "a  b\tc--d", "word " * 70_000, "x" * 200_000 + " y", "中文 text 中文"])
def test_features_of_one_text(text):
    line = importance.one_line(text)
    blocks = list(importance.feature_buckets(line, importance.ngram_pattern(2), 10_000))
    assert Counter(int(b) for block in blocks for b in block) == Counter(plain_features(text)[1])


def test_longer_ngrams():
    line = importance.one_line("a b c d")
    got = [int(b) for block in importance.feature_buckets(line, importance.ngram_pattern(3), 1 << 32) for b in block]
    assert got == [zlib.crc32(g.encode()) for g in ("a", "a b", "a b c", "b", "b c", "b c d", "c", "c d", "d")]


def test_target_like_documents_are_drawn_more_often(spark):
    docs = spark.createDataFrame([(i, _prose(i, 40, ["red", "blue", "green"] if i % 2 else ["one", "two", "three"])) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([(_prose(9, 400, ["red", "blue", "green"]),)], "text string")
    drawn = importance.resample(docs, target).filter("rank IS NOT NULL").groupBy(F.col("doc_id") % 2).count().collect()
    assert sum(r["count"] for r in drawn) == 100 and {r[0]: r["count"] for r in drawn}[1] > 75


# --- filter audit ----------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    first, marks = {}, defaultdict(lambda: [False, False])
    for doc_id, text, *_ in docs:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            marks[doc_id] = [marks[doc_id][0] or quality == 1, marks[doc_id][1] or toxic == 1]
    judged = defaultdict(list)
    for doc_id, text, _, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and doc_id > first[text],
        }
        judged[source or ""].append((fails, *(marks[doc_id] if doc_id is not None else (False, False))))
    want = {}
    for part, rows in judged.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            alive = rows
            for step, letter in enumerate(order, 1):
                gone = [r for r in alive if r[0][letter]]
                kept = [r for r in alive if not r[0][letter]]
                failing = [r for r in rows if r[0][letter]]
                want[part, order, step] = [
                    len(kept), len(gone), len(failing) - len(gone), sum(sum(r[0].values()) == 1 for r in failing), sum(r[1] for r in gone), sum(r[2] for r in gone),
                ]
                shapley[letter] += len(gone)
                alive = kept
        for order in map("".join, permutations("ABCDE")):
            for step, letter in enumerate(order, 1):
                want[part, order, step].append(shapley[letter])
    return want


def test_audit_against_a_plain_version(spark, hard):  # noqa: F811
    rows = QUERIES["op13_filter_audit"](spark, hard).collect()
    docs = [*_documents()]
    labels = [(d[0], i % 2, int(i % 3 == 0)) for i, d in enumerate(docs[::2])]
    got = {(r.part, r.filter_order, r.step): [r[c] for c in (*filter_audit.COUNTS, "shapley")] for r in rows}
    assert got == plain_audit(docs, labels) and len(rows) == len(got) == 600 * len({r.part for r in rows})


def test_audit_of_marks_capitals_and_copies(spark):
    prose = " ".join(f"w{i}" for i in range(60))
    docs = [(5, prose, "en", "s"), (4, prose, "en", "t"), (None, prose, "en", "s"), (6, prose + " #", "en", "s"), (7, prose.upper(), "en", None), (8, "w " * 60, "en", ""), (4, prose, "en", "s")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    labels = [(4, 1, 0), (4, 0, 1), (5, 1, 1), (None, 1, 1)]
    rows = filter_audit.audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    got = {(r.part, r.filter_order, r.step): [r[c] for c in (*filter_audit.COUNTS, "shapley")] for r in rows}
    assert got == plain_audit(docs, labels)
    assert got["s", "EABCD", 1][:2] == [3, 1]  # of four, only the copy with the larger id goes


def test_hot_texts_are_spread(spark):
    """A third of all rows with one text: what is shuffled for it is one row a task."""
    frame = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'same', concat('text ', id)) AS text", "'s' AS source")
    cells = filter_audit.mask_cells(filter_audit.masked(frame), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    assert {r.mask: r.n for r in cells} == {1: 2001, 17: 999}

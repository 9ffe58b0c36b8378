"""The as-of join against a plain one."""

import random
from datetime import datetime, timedelta

import pytest

from callscope.operators.as_of import as_of_join

START = datetime(2024, 1, 1)


def plain(left, right):
    out = []
    for key, at, n, name in left:
        before = [
            ((t, m if m is not None else -1), value) for k, t, m, value in right
            if key is not None and at is not None and k == key and t is not None and (t, m if m is not None else -1) <= (at, n if n is not None else -1)
        ]
        out.append((name, max(before, key=lambda b: b[0])[1] if before else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot_rows", [None, 1_000, 7])
def test_against_a_plain_join(spark, hot_rows):
    draw = random.Random(5)

    def place():
        return START + timedelta(seconds=draw.randrange(40)) if draw.random() > 0.05 else None

    def key():
        return draw.choice(["a", "a", "a", "b", "", None])

    left = [(key(), place(), draw.choice([None, 0, 4, 8]), f"call {i}") for i in range(150)]
    # Of one key, places are unlike, so that the last one is one row.
    right = list({(k, t, n): (k, t, n, draw.choice(["x", "y", None])) for k, t, n in [(key(), place(), draw.choice([None, 1, 4, 6])) for _ in range(60)]}.values())
    columns = "key string, at timestamp, n long, "
    got = as_of_join(
        spark.createDataFrame(left, columns + "name string"), spark.createDataFrame(right, "key string, since timestamp, m long, value string"),
        ["key"], ("at", "n"), ("since", "m"), ["value"], hot_rows,
    )
    assert got.columns == ["key", "at", "n", "name", "value"]
    assert sorted(((r.name, r.value) for r in got.collect()), key=str) == plain(left, right)


def test_empty_sides(spark):
    left = spark.createDataFrame([("a", START, 1)], "key string, at timestamp, n long")
    none = spark.createDataFrame([], "key string, since timestamp, m long, value string")
    rows = as_of_join(left, none, ["key"], ("at", "n"), ("since", "m"), ["value"])
    assert [tuple(r) for r in rows.select("key", "value").collect()] == [("a", None)]
    assert as_of_join(left.limit(0), none, ["key"], ("at", "n"), ("since", "m"), ["value"]).isEmpty()

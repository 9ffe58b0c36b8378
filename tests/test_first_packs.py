"""Session starts and identities cross into their state once a key and task, and their marks are read in one go."""

import json
import zlib

import pyarrow as pa

from callscope.streaming import keyed

NAMES = ["bucket", "server_id", "actor_id", "role", "about", "micros", "seq", "row"]
SCHEMA = pa.schema([(n, pa.int64() if n in ("bucket", "micros", "seq") else pa.string()) for n in NAMES])


def batch(*rows):
    return pa.RecordBatch.from_pylist([dict(zip(NAMES, r, strict=True)) for r in rows], SCHEMA)


def row(about, micros, seq=0):
    return (len(about) % 2, "s", "a", "init", about, micros, seq, f"{about}@{micros}")


def read(packs):
    return [r for b in packs for p in b.to_pylist() for r in json.loads(zlib.decompress(p["pack"]))]


def test_a_task_sends_the_first_row_of_a_key():
    given = [batch(*[row(f"k{n % 10}", 1000 - n) for n in range(500)]), batch(*[row(f"k{n % 10}", 400 + n) for n in range(500)])]
    assert sorted(r[6] for r in read(keyed.first_rows(iter(given)))) == sorted(f"k{n % 10}@{1000 - n}" if 1000 - n < 400 + (n % 10) else f"k{n % 10}@{400 + n % 10}" for n in range(490, 500))


def test_a_task_holds_few_keys_at_once(monkeypatch):
    monkeypatch.setattr(keyed, "_HELD_ROWS", 10)
    assert len(list(keyed.first_rows(iter([batch(*[row(f"k{n}", n) for n in range(25)])])))) == 3


class Marks:
    def __init__(self):
        self.held, self.asked = {}, 0

    def getValue(self, name):
        self.asked += 1
        return self.held.get(name)

    def iterator(self):
        yield from self.held.items()

    def updateValue(self, name, value):
        self.held[name] = value


def test_a_mark_ends_later_rows():
    one = keyed.FirstOfKey(None)
    one.sent = Marks()

    def shown(*rows):
        packs = [(p["bucket"], p["pack"]) for r in rows for b in keyed.first_rows(iter([batch(r)])) for p in b.to_pylist()]
        return sorted(f[6] for made in one.handleInputRows((0,), iter(packs), None) for f in made.firsts)

    assert shown(row("aa", 5), row("bb", 7), row("aa", 3), row("aa", 3, 1)) == ["aa@3", "bb@7"]
    assert shown(row("aa", 9), row("cc", 8)) == ["cc@8"]
    assert shown() == [] and one.sent.asked == 0

"""Rows cross into the keyed stream and back in packs, and the state is read in one go."""

import json

import pyarrow as pa

from callscope.streaming import keyed


def batch(*rows):
    names = ["bucket", "micros", "row"]
    return pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([("bucket", pa.int64()), ("micros", pa.int64()), ("row", pa.string())]))


def row(micros, seq, what="begin", name="c"):
    return json.dumps(["s", name, micros, seq, what, "1", None, None, "é", None, "{}"])


def test_a_pack_holds_the_rows_of_a_bucket_whole():
    given = [(n % 3, n, row(str(n), str(n))) for n in range(900)]
    packs = [p for b in keyed.packed_rows(iter([batch(*given[:500]), batch(*given[500:])])) for p in b.to_pylist()]
    assert [(p["bucket"], p["low"]) for p in packs] == [(0, 0), (1, 1), (2, 2)]
    assert sorted(r[2] for p in packs for r in keyed.unpacked(p["pack"])) == list(range(900))
    assert sum(len(p["pack"]) for p in packs) * 4 < sum(len(r[2]) for r in given)


def test_a_task_holds_few_rows_at_once(monkeypatch):
    monkeypatch.setattr(keyed, "_HELD_ROWS", 10)
    packs = [p for b in keyed.packed_rows(iter([batch(*[(0, n, row(str(n), "1")) for n in range(25)])])) for p in b.to_pylist()]
    assert [len(keyed.unpacked(p["pack"])) for p in packs] == [10, 10, 5]


def test_a_row_without_time_leaves_its_pack_without_lowest():
    (pack,) = next(keyed.packed_rows(iter([batch((0, 5, row("5", "1")), (0, None, row(None, "2")))]))).to_pylist()
    assert pack["low"] is None and [r[2] for r in keyed.unpacked(pack["pack"])] == [5, None]


class Entries:
    """A map of the state store that counts its calls."""

    def __init__(self, held):
        self.held, self.asked, self.read = held, 0, 0

    def getValue(self, name):
        self.asked += 1
        return self.held.get(name)

    def iterator(self):
        for item in self.held.items():
            self.read += 1
            yield item


def state(held):
    one = keyed.LogState({"abandon": None, "forget": None, "keep_first_client": False})
    one.known = Entries({("s", str(n)): (None, str(n), None, True, None) for n in range(held)})
    return one


def test_known_connections_are_read_in_one_go():
    one = state(30)
    found = one._known_of(dict.fromkeys(("s", str(n)) for n in range(20, 40)))
    assert one.known.asked == 0 and {n: v and v[1] for n, v in found.items()} == {("s", str(n)): str(n) if n < 30 else None for n in range(20, 40)}


def test_the_work_follows_what_is_asked_for_and_not_what_is_held():
    one = state(10_000)
    found = one._known_of({("s", "2"): [], ("s", "9999"): [], ("s", "none"): []})
    assert [found[n] and found[n][1] for n in (("s", "2"), ("s", "9999"), ("s", "none"))] == ["2", "9999", None]
    assert one.known.read <= 12 and one.known.asked == 2


def test_decided_rows_leave_in_packs():
    sizes = [len(r.decided) for r in keyed.in_packs(iter([("s",)] * 600))]
    assert sizes == [256, 256, 88]

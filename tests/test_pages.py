"""Entries of the keyed state share pages, so that calls to the store are few."""

import pytest

from callscope.streaming import keyed
from callscope.streaming.keyed import _PAGE, FirstOfKey, Pages
from tests.test_first_packs import batch, row


class Store:
    """A map and a value of the state store that count their calls."""

    def __init__(self):
        self.held, self.value, self.calls = {}, None, 0

    def getValue(self, name):
        self.calls += 1
        return self.held.get(name)

    def updateValue(self, name, value):
        self.calls += 1
        self.held[name] = value

    def removeKey(self, name):
        self.calls += 1
        self.held.pop(name, None)

    def iterator(self):
        yield from list(self.held.items())

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def names(count):
    return [("s", str(n)) for n in range(count)]


def test_pages_are_a_map():
    store = Store()
    pages, want = Pages(store, store), {}
    for turn in range(4):
        for n, name in enumerate(names(500)):
            if n % 5 == turn:
                pages.removeKey(name)
                want.pop(name, None)
            elif n % 3 == turn % 3:
                pages.updateValue(name, (f"é{turn}", None, True, n))
                want[name] = (f"é{turn}", None, True, n)
        pages.save()
        assert dict(pages.iterator()) == want
        assert {name: pages.getValue(name) for name in names(500)} == {name: want.get(name) for name in names(500)}
    for name in list(want):
        pages.removeKey(name)
    pages.save()
    assert store.held == {}


def test_calls_to_the_store_are_few_and_an_entry_costs_a_page():
    store = Store()
    pages = Pages(store, store)
    for name in names(6400):
        pages.updateValue(name, (True,))
    pages.save()
    assert store.calls * 10 < 6400 and len(list(Pages(store, store).iterator())) == 6400
    store.calls = 0
    one = Pages(store, store)
    one.updateValue(("s", "7"), (False,))
    one.save()
    assert store.calls == 2 and len(one._page(one._number(("s", "7")))) <= _PAGE
    assert one.getValue(("s", "7")) == (False,) and one.getValue(("s", "8")) == (True,)


def test_marks_end_after_their_time():
    store = Store()
    pages = Pages(store, store, ttl=100)
    for now, name in ((0, "a"), (60, "b")):
        pages.now = now
        pages.updateValue((name,), (True,))
        pages.save()
    pages.now = 120
    assert pages.getValue(("a",)) is None and pages.getValue(("b",)) == (True,)


@pytest.mark.parametrize("forget", [None, 5])
def test_first_rows_write_a_page_once(forget):
    class Handle:
        def getMapState(self, name, key, value, ttl=None):
            return store

        def getValueState(self, name, schema):
            return store

    class Timer:
        def getCurrentProcessingTimeInMs(self):
            return 1000

    store, one = Store(), FirstOfKey(forget)
    one.init(Handle())
    given = [(p["bucket"], p["pack"]) for b in keyed.first_rows(iter([batch(*[row(f"k{n}", n) for n in range(1000)])])) for p in b.to_pylist()]
    shown = [f[6] for made in one.handleInputRows((0,), iter(given), Timer()) for f in made.firsts]
    assert len(shown) == 1000 and store.calls < 100
    assert not list(one.handleInputRows((0,), iter(given), Timer()))

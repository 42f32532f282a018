"""State is read and written by the page, and rows cross to the processors packed."""

import pickle

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from brickrow.streaming.state import PAGE_ENTRIES, Best, Latest, Pages, _arrays, rows_of, values_of


class Kept(dict):
    """Map state of one bucket, as processors use it; counts accesses."""

    accesses = passes = 0

    def getValue(self, key):
        self.accesses += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.accesses += 1
        self[key] = value

    def iterator(self):
        self.passes += 1
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.states = {}

    def getMapState(self, name, *_):
        return self.states.setdefault(name, Kept())


def struct(**kinds):
    return T.StructType([T.StructField(name, kind()) for name, kind in kinds.items()])


KEYS, ROW = struct(url=T.StringType), struct(url=T.StringType, page_id=T.LongType)


def test_many_keys_take_few_accesses_and_one_key_takes_its_page():
    latest, handle = Latest(KEYS, ROW, "page_id"), Handle()
    latest.init(handle)
    n = 5000
    told = list(latest.changes([((f"u{i}",), (f"u{i}", i)) for i in range(n)]))
    kept = handle.states["latest"]
    assert len(told) == n and kept.accesses < n / 10
    kept.accesses = 0
    assert list(latest.changes([(("u7",), ("u7", 9000))])) == [(("u7",), 2, ("u7", 7), ("u7", 9000))]
    assert kept.accesses <= 3 and kept.passes == 0
    assert sorted(v for _, _, packed in kept.values() for v in pickle.loads(packed).values()) == sorted(
        [(f"u{i}", i, 1) for i in range(n) if i != 7] + [("u7", 9000, 2)]
    )


def test_pages_hold_what_a_map_holds():
    state, whole = Kept(), {}
    pages = Pages(state)
    for call in range(6):
        pages.open()
        for i in range(call * 150, call * 150 + 400):
            key = (None if i % 97 == 0 else f"ké{i % 450}", i % 3)
            if key in whole and i % 5 == 0:
                pages.remove(key)
                del whole[key]
            else:
                pages.put(key, (i, None))
                whole[key] = (i, None)
            assert pages.get(key) == whole.get(key)
        assert dict(pages.items()) == whole
        pages.flush()
    assert len(whole) > PAGE_ENTRIES
    pages.open()
    assert dict(pages.items()) == whole and all(pages.get(k) == v for k, v in whole.items()) and pages.n == len(whole)


def test_a_best_that_falls_finds_the_next_one_on_another_page():
    keys, row = struct(code=T.StringType), struct(url=T.StringType, price=T.DoubleType)
    best, handle = Best(keys, row, "price", ["url"]), Handle()
    best.init(handle)
    n = 1000
    event = lambda i, version, price: (("c",), f"u{i}", version, None if price is None else (f"u{i}", price))
    assert [c[3] for c in best.changes([event(i, 1, float(i)) for i in range(n)])] == [("u999", 999.0)]
    assert handle.states["members"].accesses < n / 10
    assert list(best.changes([event(999, 2, None)])) == [(("c",), 2, ("u999", 999.0), ("u998", 998.0))]
    assert handle.states["members"].passes == 1


@pytest.mark.parametrize("values, kind", [(["a", None, "é"], pa.string()), ([1, None, 2**62 + 1], pa.int64()), ([1.5, None], pa.float64()), ([], pa.string()), ([True, None], pa.bool_())])
def test_values_come_back_as_they_were(values, kind):
    assert values_of(pa.array(values, kind)) == values
    assert values_of(pa.array([*values, *values], kind).slice(len(values))) == values


def test_rows_of_a_column_and_back():
    kind = pa.struct([("a", pa.string()), ("b", pa.int64())])
    rows = [("x", 1), None, (None, None), ("y", 2**60 + 1)]
    column = _arrays([(row,) for row in rows], pa.schema([("now", kind)]))[0]
    assert rows_of(column, ["a", "b"]) == rows
    assert rows_of(column.slice(1, 2), ["b", "a"]) == [None, (None, None)]

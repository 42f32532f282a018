"""Keyed state of Spark's own state store: the latest row of a key, and the best of its members.

Both processors emit changes, so that a later step sees only what a run changed: ``version`` counts the
changes of a key, ``was`` and ``now`` are its row before and after, null where there is none.

Between Spark and Python every group, every row with its columns and every access to state has a cost of its
own, far more than that of comparing rows. So Spark hands the processors many keys at once, those of a bucket;
rows go in and out packed (``changes``); and a bucket keeps its keys in pages (``Pages``), of which only those
are read and written that hold what a run names, but for a best that falls (see ``Best``).

The module is pickled by value, so executors do not need the package installed.
"""

from __future__ import annotations

import pickle
import sys
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import MapState, StatefulProcessor, StatefulProcessorHandle

from brickrow.sources import files

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Groups that the keys of a step are dealt to.
BUCKETS = 16_384
BUCKET = "_bucket"
#: Entries of a page of state, on average, at most.
PAGE_ENTRIES = 64
#: Changes that leave a processor in one row, at most.
TOLD_AT_ONCE = 1000
#: Rows of an Arrow batch, unless one packed value has more.
BATCH_ROWS = 4000

_PACKED = T.StructType([T.StructField(BUCKET, T.IntegerType()), T.StructField("packed", T.BinaryType())])
_TOLD = T.StructType([T.StructField("packed", T.BinaryType())])
_PAGE = T.StructType([T.StructField("page", T.IntegerType())])
_ENTRIES = T.StructType(
    [T.StructField("pages", T.IntegerType()), T.StructField("entries", T.LongType()), T.StructField("packed", T.BinaryType())]
)
#: Key, version, row before and row after.
Change = tuple[tuple, int, tuple | None, tuple | None]

_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A run writes what it changed, not what is kept.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def state_settings(spark: SparkSession) -> Iterator[None]:
    """The state store that keyed state needs, for the queries that start inside; they keep it."""
    before = {key: spark.conf.get(key, None) for key in _SETTINGS}
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def state_rows(spark: SparkSession, checkpoint: str, name: str, row: T.StructType) -> DataFrame | None:
    """The values of one state after the last run that is complete; none before the first."""
    if not files.names(spark, f"{checkpoint}/commits"):
        return None
    stored = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
    return stored.select("user_map_value.packed").mapInArrow(_entries(row), row)


def _entries(row: T.StructType) -> Callable:
    schema = to_arrow_schema(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches((list(pickle.loads(packed).values()) for packed in _in_turn(batches)), schema)

    return run


def changes(rows: DataFrame, of: Latest | Best) -> DataFrame:
    """The changes of a run that the processor ``of`` finds; ``rows`` have the columns it ``takes``.

    Keys are dealt to buckets, whose number must stay the same over runs.
    """
    bucket = F.pmod(F.xxhash64(*of.keys.names), F.lit(BUCKETS)).cast("int").alias(BUCKET)
    packed = rows.select(bucket, *of.takes()).mapInArrow(_packing(of), _PACKED)
    told = packed.groupBy(BUCKET).transformWithState(Packed(of), _TOLD, "append", "none")
    return told.mapInArrow(_unpacking(of.keys, of.row), changes_of(of.keys, of.row))


def changes_of(keys: T.StructType, row: T.StructType) -> T.StructType:
    """What the processors emit."""
    return T.StructType([*keys, T.StructField("version", T.LongType()), T.StructField("was", row), T.StructField("now", row)])


def _in_batches(lists: Iterable[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """All rows, those of several short lists in one batch."""
    rows: list[tuple] = []
    for some in lists:
        rows += some
        if len(rows) >= BATCH_ROWS:
            yield pa.RecordBatch.from_arrays(_arrays(rows, schema), schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays(_arrays(rows, schema), schema=schema)


def _in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """The packed rows one after the other."""
    for batch in batches:
        for packed in batch.column(batch.num_columns - 1):
            yield packed.as_py()


def values_of(column: pa.Array) -> list:
    """As ``to_pylist``, which makes a scalar of each value first."""
    if not (pa.types.is_string(column.type) or pa.types.is_integer(column.type) or pa.types.is_floating(column.type)):
        return column.to_pylist()
    if pa.types.is_string(column.type) or not column.null_count:
        return column.to_numpy(zero_copy_only=False).tolist()
    return [v if ok else None for v, ok in zip(column.fill_null(0).to_numpy(zero_copy_only=False).tolist(), _there(column))]


def _there(column: pa.Array) -> list[bool]:
    return column.is_valid().to_numpy(zero_copy_only=False).tolist()


def rows_of(column: pa.StructArray, names: Sequence[str]) -> list[tuple | None]:
    """The rows of a column, null ones as None."""
    parts = dict(zip((f.name for f in column.type), column.flatten()))
    rows = zip(*[values_of(parts[n]) for n in names])
    return [row if ok else None for row, ok in zip(rows, _there(column))] if column.null_count else list(rows)


def _packing(of: Latest | Best) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            events = of.events(batch)
            buckets = batch.column(0).take(pa.array(events.keys(), pa.int64()))
            packed = pa.array([pickle.dumps(e, 5) for e in events.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([buckets, packed], names=_PACKED.names)

    return run


def _unpacking(keys: T.StructType, row: T.StructType) -> Callable:
    schema = to_arrow_schema(changes_of(keys, row))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = (pickle.loads(packed) for packed in _in_turn(batches))
        return _in_batches(([(*key, version, was, now) for key, version, was, now in some] for some in told), schema)

    return run


def _arrays(rows: Sequence[tuple], fields: Iterable[pa.Field]) -> list[pa.Array]:
    """One column for each field; of a struct, rows may be None."""
    return [_array(column, field.type) for column, field in zip(zip(*rows), fields)]


def _array(column: Sequence, kind: pa.DataType) -> pa.Array:
    if not pa.types.is_struct(kind):
        return pa.array(column, kind)
    blank = (None,) * kind.num_fields
    parts = _arrays([blank if row is None else row for row in column], kind)
    return pa.StructArray.from_arrays(parts, fields=list(kind), mask=pa.array([row is None for row in column], pa.bool_()))


class Pages:
    """A map in the map state of a bucket, whose entries are read and written by the page.

    An entry lies in the page that its key's checksum names. Their number doubles as entries grow; page 0
    tells it, and how many entries there are. ``open`` comes before a call's first access, ``flush`` after its
    last.
    """

    def __init__(self, state: MapState) -> None:
        self.state = state

    def open(self) -> None:
        first = self.state.getValue((0,))
        self.n_pages, self.n, packed = first or (1, 0, None)
        self.told = (self.n_pages, self.n)
        self.pages: dict[int, dict] = {0: pickle.loads(packed) if packed else {}}
        self.changed: set[int] = set()

    def _number(self, key: tuple) -> int:
        return zlib.crc32(ascii(key).encode()) & self.n_pages - 1

    def _page(self, number: int) -> dict:
        page = self.pages.get(number)
        if page is None:
            found = self.state.getValue((number,))
            page = self.pages[number] = pickle.loads(found[2]) if found else {}
        return page

    def get(self, key: tuple) -> tuple | None:
        return self._page(self._number(key)).get(key) if self.n else None

    def put(self, key: tuple, row: tuple) -> None:
        number = self._number(key)
        page = self._page(number)
        self.n += key not in page
        page[key] = row
        self.changed.add(number)
        if self.n > self.n_pages * PAGE_ENTRIES:
            self._grow()

    def remove(self, key: tuple) -> None:
        number = self._number(key)
        del self._page(number)[key]
        self.n -= 1
        self.changed.add(number)

    def items(self) -> Iterator[tuple[tuple, tuple]]:
        """All entries, in one pass over the pages."""
        for (number,), (_, _, packed) in self.state.iterator():
            if number not in self.pages:
                self.pages[number] = pickle.loads(packed)
        for page in self.pages.values():
            yield from page.items()

    def _grow(self) -> None:
        entries = [e for number in range(self.n_pages) for e in self._page(number).items()]
        self.n_pages *= 2
        self.pages = {number: {} for number in range(self.n_pages)}
        for key, row in entries:
            self.pages[self._number(key)][key] = row
        self.changed = set(self.pages)

    def flush(self) -> None:
        if self.told != (self.n_pages, self.n):
            self.changed.add(0)
        for number in sorted(self.changed):
            self.state.updateValue((number,), (self.n_pages, self.n, pickle.dumps(self.pages[number], 5)))


class Latest(StatefulProcessor):
    """Per key the row that is greatest by ``order``, a column of it; a null is least, an equal one stays."""

    STATE = "latest"

    def __init__(self, keys: T.StructType, row: T.StructType, order: str) -> None:
        self.keys = keys
        self.row = row
        self.names = row.names
        self.place = row.names.index(order)

    def takes(self) -> list[Column]:
        return [F.struct(*self.keys.names).alias("key"), F.struct(*self.names).alias("row")]

    @staticmethod
    def kept_row(row: T.StructType) -> T.StructType:
        """What is kept of a key."""
        return T.StructType([*row, T.StructField("version", T.LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = Pages(handle.getMapState(self.STATE, _PAGE, _ENTRIES))

    def events(self, batch: pa.RecordBatch) -> dict[int, tuple]:
        """Key and row, by the place in the batch; of a key that comes often the newest row alone."""
        keys, rows = rows_of(batch.column(1), self.keys.names), rows_of(batch.column(2), self.names)
        newest: dict[tuple, int] = {}
        for i, key in enumerate(keys):
            if key not in newest or self._rank(rows[newest[key]]) < self._rank(rows[i]):
                newest[key] = i
        return {i: (key, rows[i]) for key, i in newest.items()}

    def _rank(self, row: tuple) -> tuple:
        value = row[self.place]
        return (value is not None, value or 0)

    def handleInputRows(self, bucket: tuple, rows: Iterable[Row], timers) -> Iterator[Row]:
        told = [(tuple(r[n] for n in self.keys.names), tuple(r[n] for n in self.names)) for r in rows]
        return _named(self, self.changes(told))

    def changes(self, events: Iterable[tuple]) -> Iterator[Change]:
        newest: dict[tuple, tuple] = {}
        for key, row in events:
            if key not in newest or self._rank(newest[key]) < self._rank(row):
                newest[key] = row
        self.kept.open()
        for key, new in newest.items():
            found = self.kept.get(key)
            was = None if found is None else found[:-1]
            if was is not None and self._rank(new) <= self._rank(was):
                continue
            version = 1 if found is None else found[-1] + 1
            self.kept.put(key, (*new, version))
            yield key, version, was, new
        self.kept.flush()

    def close(self) -> None:
        pass


class Best(StatefulProcessor):
    """Per key the best of its members, by descending ``price`` and then by all ``ties`` in order, nulls last.

    An input row names a ``member``, a ``version`` and ``now``, the member's row or null when it leaves; of
    several for one member the highest version counts, and at equal ones the row. When the best leaves or
    falls, the members that are left are compared again: one pass over the members of the bucket, for all
    its keys whose best fell and which have members that this run does not name.
    """

    STATE = "best"

    def __init__(self, keys: T.StructType, row: T.StructType, price: str, ties: list[str]) -> None:
        self.keys = keys
        self.row = row
        self.price = row.names.index(price)
        self.ties = [row.names.index(c) for c in ties]

    def takes(self) -> list[Column | str]:
        return [F.struct(*self.keys.names).alias("key"), "member", "version", "now"]

    @staticmethod
    def kept_row(row: T.StructType) -> T.StructType:
        """What is kept of a key. Without members the row is null, and the version outlives it."""
        nullable = [T.StructField(f.name, f.dataType) for f in row]
        numbers = [T.StructField("members", T.LongType()), T.StructField("version", T.LongType())]
        return T.StructType([*nullable, T.StructField("member", T.StringType()), *numbers])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = Pages(handle.getMapState(self.STATE, _PAGE, _ENTRIES))
        self.members = Pages(handle.getMapState("members", _PAGE, _ENTRIES))

    def events(self, batch: pa.RecordBatch) -> dict[int, tuple]:
        """Key, member, version and row, by the place in the batch."""
        _, keys, members, versions, now = batch.columns
        told = zip(rows_of(keys, self.keys.names), values_of(members), values_of(versions), rows_of(now, self.row.names))
        return dict(enumerate(told))

    def _rank(self, row: tuple) -> tuple:
        """Least for the best row."""
        ties = [(row[i] is None, "" if row[i] is None else row[i]) for i in self.ties]
        return (-row[self.price], ties)

    def handleInputRows(self, bucket: tuple, rows: Iterable[Row], timers) -> Iterator[Row]:
        def row(now) -> tuple | None:
            return None if now is None else tuple(now[c] for c in self.row.names)

        told = [(tuple(r[n] for n in self.keys.names), r["member"], r["version"], row(r["now"])) for r in rows]
        return _named(self, self.changes(told))

    def changes(self, told: Iterable[tuple]) -> Iterator[Change]:
        events: dict[tuple, dict[str, tuple]] = {}
        for key, member, version, now in told:
            last = events.setdefault(key, {})
            order = (version, now is not None)
            if member not in last or last[member][0] < order:
                last[member] = (order, now)
        self.best.open()
        self.members.open()
        fallen: dict[tuple, tuple | None] = {}
        later = []
        for key, last in events.items():
            *was, holder, n, version = self.best.get(key) or (None, 0, 0)
            was = None if holder is None else tuple(was)
            ranked_was = None if was is None else self._rank(was)
            best = None if was is None or holder in last else (ranked_was, holder, was)
            here = 0
            for member, (_, now) in last.items():
                place = (*key, member)
                there = n > 0 and self.members.get(place) is not None
                if now is None:
                    if there:
                        self.members.remove(place)
                        here -= 1
                    continue
                self.members.put(place, now)
                here += not there
                ranked = (self._rank(now), member, now)
                if best is None or ranked[:2] < best[:2]:
                    best = ranked
            after = n + here
            others = after > sum(now is not None for _, now in last.values())
            # Unless the holder itself got better, or no other member can have got ahead of it.
            if holder in last and others and (best is None or best[0] > ranked_was):
                fallen[key] = best
                later.append((key, was, holder, n, version, after))
            else:
                yield from self._told(key, was, holder, n, version, after, best)
        if fallen:
            width = len(self.keys)
            for place, row in self.members.items():
                key = place[:width]
                if key in fallen:
                    ranked = (self._rank(row), place[width], row)
                    if fallen[key] is None or ranked[:2] < fallen[key][:2]:
                        fallen[key] = ranked
        for key, *before in later:
            yield from self._told(key, *before, fallen[key])
        self.best.flush()
        self.members.flush()

    def _told(self, key: tuple, was: tuple | None, holder: str | None, n: int, version: int, after: int, best: tuple | None) -> Iterator[Change]:
        """Keep the best of a key, and emit it if it is another row than before."""
        now = None if best is None else best[2]
        if now != was:
            version += 1
        elif (holder, n) == (best and best[1], after):
            return
        self.best.put(key, (*(now or (None,) * len(self.row)), best and best[1], after, version))
        if now != was:
            yield key, version, was, now

    def close(self) -> None:
        pass


def _named(of: Latest | Best, changes: Iterable[Change]) -> Iterator[Row]:
    """Changes as rows of :func:`changes_of`."""
    row, change = Row(*of.row.names), Row(*of.keys.names, "version", "was", "now")
    for key, version, was, now in changes:
        yield change(*key, version, was and row(*was), now and row(*now))


class Packed(StatefulProcessor):
    """A processor whose rows come and go packed, so that they cross between Spark and Python as one value."""

    def __init__(self, of: Latest | Best) -> None:
        self.of = of

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.of.init(handle)

    def handleInputRows(self, bucket: tuple, rows: Iterable[Row], timers) -> Iterator[Row]:
        told = list(self.of.changes([pickle.loads(r[1]) for r in rows]))
        row = Row(*_TOLD.names)
        for start in range(0, len(told), TOLD_AT_ONCE):
            yield row(pickle.dumps(told[start : start + TOLD_AT_ONCE], 5))

    def close(self) -> None:
        pass

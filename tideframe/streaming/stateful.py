"""Operators whose state Spark keeps by key, or by bucket of keys: what a batch costs follows from the batch and, in a
retraction, from the state of the buckets that it touches.

A record that changes is taken back from the group it was in and added to the one it is in now; snapshots pass a gate
that knows the last one let through; counts are held back until there are enough of them or time is up. State is in the
checkpoint with the offsets of the input, so a batch that is repeated after a failure finds the state that it began with.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tideframe.operators.snapshots import moved
from tideframe.session import state_by_key
from tideframe.sources.sinks import Table, retried
from tideframe.streaming import engine


def _ordered(values: Sequence) -> tuple:
    """Values that compare with one another, nulls first."""
    return tuple((v is not None, v) for v in values)


#: Rows and bytes that are gathered before they are packed, and before those of a bucket that don't count are left out.
_ROWS, _BYTES = 1_000_000, 64 << 20


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """_bucket and _rows, packed: a task's rows in a few packets for each bucket, in the order in which they came."""

    def packets(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        buckets = rows.column("_bucket").to_numpy()
        at = np.argsort(buckets, kind="stable")
        rows, buckets = rows.drop_columns("_bucket").take(at), buckets[at]
        starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
        ends = np.r_[starts[1:], len(buckets)]
        for i in range(0, len(starts), 256):
            data = [_packed(rows.slice(s, e - s)) for s, e in zip(starts[i : i + 256].tolist(), ends[i : i + 256].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(buckets[starts[i : i + 256]], pa.int32()), pa.array(data, pa.binary())], ["_bucket", "_rows"])

    own: list[pa.RecordBatch] = []
    for batch in batches:
        own.append(batch)
        if sum(b.num_rows for b in own) >= _ROWS or sum(b.nbytes for b in own) >= _BYTES:
            yield from packets(own)
            own = []
    if sum(b.num_rows for b in own):
        yield from packets(own)


def _rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0).to_pylist():
            yield from _unpacked(data).to_batches()


def _plain(column: pa.ChunkedArray, ordered: bool = False) -> pa.Array:
    """The column as one array that can be compared; of nested values a number for each, in their order if asked for."""
    if not pa.types.is_nested(column.type):
        return column.combine_chunks()
    values = column.to_pylist()
    known = {repr(v): v for v in values if v is not None}
    numbers = {r: i for i, r in enumerate(sorted(known, key=known.get) if ordered else known)}
    return pa.array([None if v is None else numbers[repr(v)] for v in values], pa.int64())


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Whether values are equal; nulls are, and NaN is NaN."""
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    if pa.types.is_floating(a.type):
        same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return same.to_numpy(zero_copy_only=False)


def _by_key(rows: pa.Table, keys: int, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows by key and then order (nulls first, of equal ones the first one last), and where in them each
    key begins. The first columns are the keys, those of the order follow."""
    own = [_plain(rows.column(i), i >= keys) for i in range(keys + order)]
    own = pa.RecordBatch.from_arrays([*own, pa.array(np.arange(rows.num_rows, 0, -1))], [str(i) for i in range(keys + order + 1)])
    at = pc.sort_indices(own, sort_keys=[(c, "ascending") for c in own.schema.names], null_placement="at_start")
    same = np.ones(max(rows.num_rows - 1, 0), bool)
    for i in range(keys):
        column = own.column(i).take(at)
        same &= _same(column[1:], column[:-1])
    return at.to_numpy().astype(np.int64), np.flatnonzero(np.r_[True, ~same])


class Retraction(StatefulProcessor):
    """Keeps the last record of each key. A later one gives -1 times the old record's numbers for its group and +1 times
    the new one's; one that is not later gives nothing; one marked as deleted only takes the old one back.

    Keys are dealt over buckets. State and rows of a bucket are Arrow tables, so that the calls to Spark's state and the
    steps in Python are some for a bucket, not for a key. Columns: keys, order, groups, numbers, whether it is deleted."""

    def __init__(self, keys: int, order: int, groups: int, numbers: int, out: Sequence[str]):
        self.keys, self.order, self.groups, self.numbers, self.out = keys, order, groups, numbers, list(out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "rows binary")

    def _changes(self, rows: pa.Table, sign: int) -> pa.Table:
        first = self.keys + self.order + self.groups
        groups = [rows.column(i) for i in range(first - self.groups, first)]
        numbers = [rows.column(i) if sign > 0 else pc.negate(rows.column(i)) for i in range(first, first + self.numbers)]
        return pa.table([*groups, pa.array(np.full(rows.num_rows, sign, np.int32)), *numbers], names=self.out)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        known = self.last.get()
        parts = [] if known is None else [_unpacked(known[0])]
        kept = parts[0].num_rows if parts else 0
        fresh: list[pa.Table] = []
        for row in rows:
            fresh.append(_unpacked(row["_rows"]))
            if sum(t.num_rows for t in fresh) >= _ROWS or sum(t.nbytes for t in fresh) >= _BYTES:
                table = pa.concat_tables(fresh).combine_chunks()
                at, starts = _by_key(table, self.keys, self.order)
                # in the order in which they came
                fresh = [table.take(np.sort(at[np.r_[starts[1:], len(at)] - 1]))]
        table = pa.concat_tables([*parts, *fresh], promote_options="default").combine_chunks()
        at, starts = _by_key(table, self.keys, self.order)
        ends = np.r_[starts[1:], len(at)] - 1
        last = at[ends]
        old = np.maximum.reduceat(np.where(at < kept, at, -1), starts)
        changed = last >= kept
        if not changed.any():
            return
        self.last.update((_packed(table.take(np.sort(last))),))
        last, old = last[changed], old[changed]
        gone = table.column(table.num_columns - 1).to_numpy().astype(bool)
        there, here = (old >= 0) & ~gone[old], ~gone[last]
        both = np.flatnonzero(there & here)
        same = np.ones(len(both), bool)
        for i in range(self.keys + self.order, table.num_columns - 1):
            column = _plain(table.column(i))
            same &= _same(column.take(pa.array(old[both])), column.take(pa.array(last[both])))
        there[both[same]] = here[both[same]] = False
        if there.any() or here.any():
            yield Row("_rows")(_packed(pa.concat_tables([self._changes(table.take(old[there]), -1), self._changes(table.take(last[here]), 1)])))


def _ddl(df: DataFrame, names: Sequence[str], prefix: str = "") -> str:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return ", ".join(f"`{prefix}{n}` {kinds[n]}" for n in names)


def changes(stream: DataFrame, keys: Sequence[str], order: Sequence[str], groups: Sequence[str], numbers: Sequence[str], deleted: Column | None = None, buckets: int = 1024) -> DataFrame:
    """groups, n (1 or -1) and numbers (whole ones): what the records of a stream add to and take from the sums of groups.

    Of a key's records the one of the greatest `order` counts, in whatever order they come; of equal ones the first. A
    batch reads and writes the state of the buckets that its keys are in: the more of them, the less a batch of few keys
    costs, and the more one of many. A checkpoint keeps their number.
    """
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    # columns need names of their own, though one may be key, order, group and number at once
    own = [F.col(c).alias(f"{p}_{i}") for p, named in (("k", keys), ("o", order), ("g", groups), ("n", numbers)) for i, c in enumerate(named)]
    rows = stream.select(*own, gone.alias("_deleted"), F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket"))
    out = StructType.fromDDL(f"{_ddl(stream, groups)}, n int, {_ddl(stream, numbers)}")
    packets = rows.mapInArrow(_by_bucket, "_bucket int, _rows binary")
    changed = packets.groupBy("_bucket").transformWithState(Retraction(len(keys), len(order), len(groups), len(numbers), out.names), "_rows binary", "Update", "None")
    return changed.mapInArrow(_rows_in, out)


def retracted(stream: DataFrame, keys: Sequence[str], order: Sequence[str], groups: Sequence[str], numbers: Sequence[str], at: str | None = None, deleted: Column | None = None) -> DataFrame:
    """groups, n (records) and the sums of numbers, of the last record of each key. Groups without a record go.

    A batch reads and writes the sums of the groups that its records leave and join, not the records in them. Sums and the
    number of the batch are one commit.
    """
    at = at or engine.folder(stream)
    table = Table(stream.sparkSession, f"{at}/sums", groups, nulls=True)
    sums = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("n", *numbers)}

    def each(batch: DataFrame, number: int) -> None:
        base, manifest = table.store.current()
        if manifest["batches"].get("stream", -1) >= number:
            return
        deltas = batch.groupBy(*groups).agg(*sums.values()).persist()
        try:
            table.store.commit({table.name: table.added(manifest, deltas, list(sums.values()), "n")}, base, ("stream", number))
        finally:
            deltas.unpersist()

    with state_by_key(stream.sparkSession):
        engine.run(changes(stream, keys, order, groups, numbers, deleted), lambda batch, number: retried(lambda: each(batch, number)), at)
    return table.read()


class Gate(StatefulProcessor):
    """Lets a key's first snapshot through and each that differs enough from the last one let through. What isn't later
    than the last snapshot seen comes too late and is dropped."""

    def __init__(self, keys: Sequence[str], order: Sequence[str], values: Sequence[str], schema: str):
        self.order, self.values, self.schema, self.out = list(order), list(values), schema, [*keys, *order, *values]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("stored", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        n, known = len(self.order), self.state.get() if self.state.exists() else None
        seen, stored = (tuple(known[:n]), tuple(known[n:])) if known is not None else (None, None)
        for row in sorted(rows, key=lambda r: _ordered([r[c] for c in self.order])):
            at = tuple(row[c] for c in self.order)
            if seen is not None and _ordered(at) <= _ordered(seen):
                continue
            seen, now = at, tuple(row[c] for c in self.values)
            if stored is None or moved(stored, now) is True:
                stored = now
                yield Row(*self.out)(*key, *at, *now)
        if seen is not None:
            self.state.update((*seen, *stored))


def gated_append(stream: DataFrame, keys: Sequence[str], order: str, relative: Sequence[str], absolute: str, tie: str, at: str | None = None) -> DataFrame:
    """The snapshots of a stream that pass the gate, appended as they come: what is stored is never read or changed again.

    For streams whose keys come in order (of `order`, then tie) it gives the batch query's rows. A snapshot that isn't
    after the last one seen of its key is late and left out, whether or not it would have passed; repeated ones are too.
    """
    at = at or engine.folder(stream)
    values = [*relative, absolute]
    rows = stream.select(*keys, order, tie, *values)
    out = StructType.fromDDL(_ddl(stream, [*keys, order, tie, *values]))
    passed = rows.groupBy(*keys).transformWithState(Gate(keys, [order, tie], values, _ddl(stream, [order, tie, *values])), out, "Append", "None")
    with state_by_key(stream.sparkSession):
        return engine.appended(passed, at)


class Held(StatefulProcessor):
    """Counts by key that are held back until there are `size` of them or `wait_ms` have passed since the first one; an
    empty row of a key (n null) lets go at once."""

    def __init__(self, size: int, wait_ms: int):
        self.size, self.wait = size, wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.count = handle, handle.getValueState("count", "n long")

    def _go(self, key, n: int) -> Iterator[Row]:
        self.count.clear()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if n:
            yield Row("key", "n")(key[0], n)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        held = self.count.get()[0] if self.count.exists() else 0
        n, now = held, False
        for row in rows:
            now = now or row["n"] is None
            n += row["n"] or 0
        if now or n >= self.size:
            yield from self._go(key, n)
            return
        if not held and n:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.wait)
        self.count.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._go(key, self.count.get()[0] if self.count.exists() else 0)


def held(stream: DataFrame, key: str, n: Column, size: int, wait_ms: int) -> DataFrame:
    """key, n: the sums of n by key, let go when they reach `size` or are `wait_ms` old. All that is let go adds up to all
    that has come but for what is still held; a row whose n is null lets its key's sum go at once, as when work ends."""
    rows = stream.select(F.col(key).alias("key"), n.cast("long").alias("n"))
    return rows.groupBy("key").transformWithState(Held(size, wait_ms), f"key {dict(rows.dtypes)['key']}, n long", "Update", "ProcessingTime")

"""Streams whose results equal those of the batch queries.

Running sums, counts, extremes and best records are streaming aggregations in update mode, upserted by key after each
micro-batch. What retracts (a sum over records that may still change, rows gated by the one kept before) is recomputed
for the groups that a batch touches, from the records stored so far. Records, results and the number of the batch are
one commit, so that a batch that is repeated after a failure changes nothing twice. Null keys are groups like others, as
in the batch queries. Without a watermark nothing late is lost and state grows with the keys; a watermark may bound it.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import timedelta
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tideframe.session import shared_folder
from tideframe.sources.sinks import Table, retried


def folder(df: DataFrame) -> str:
    return f"{shared_folder(df.sparkSession)}/streams/{uuid.uuid4().hex}"


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], at: str, mode: str = "update", every: str | None = None, name: str | None = None):
    """Work through all that is there, batch by batch, and go on from the checkpoint at the next call. With `every` (such
    as "3 seconds") what has come is written so often until the query, which is returned, is stopped."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{at}/checkpoint")
    writer = writer.queryName(name) if name else writer
    query = (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
    if not every:
        query.awaitTermination()
    return query


def once(table: Table, batch: DataFrame, number: int, name: str = "stream") -> None:
    """Upsert a micro-batch, unless its results are in already."""

    def write() -> None:
        if table.store.done(name) < number:
            table.upsert(batch, batch=(name, number))

    retried(write)


def running(stream: DataFrame, keys: Sequence[str], metrics: dict[str, Column], at: str | None = None) -> DataFrame:
    """The metrics of each group over all of a stream, as a keyed table after its last batch."""
    at = at or folder(stream)
    table = Table(stream.sparkSession, f"{at}/table", keys, nulls=True)
    totals = stream.groupBy(*keys).agg(*[m.alias(n) for n, m in metrics.items()])
    run(totals, lambda batch, number: once(table, batch, number), at)
    return table.read()


def best_records(stream: DataFrame, keys: Sequence[str], order: Sequence[Column], at: str | None = None) -> DataFrame:
    """The best record of each key over all of a stream, by `order` (greater is better)."""
    rest = [c for c in stream.columns if c not in keys]
    own = running(stream, keys, {"_best": F.max_by(F.struct(*rest), F.struct(*order))}, at)
    return own.select(*keys, "_best.*")


def regrouped(
    stream: DataFrame, keys: Sequence[str], better: Callable[[DataFrame], DataFrame], groups: Sequence[str], totals: Callable[[DataFrame], DataFrame], at: str | None = None,
    result: Sequence[str] | None = None, eligible: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Totals by group of the best record of each key. A record that moves from one group to another leaves the first:
    after each batch all groups of records old and new are computed afresh, and groups without a record go.

    `better` leaves one row of each key; `result` is the key of the totals, if that is more than the groups; `eligible`
    chooses among the best records those that count, so that a record that is no longer eligible leaves its group too.
    """
    at = at or folder(stream)
    spark = stream.sparkSession
    records, sums = Table(spark, f"{at}/store", keys, "records", nulls=True), Table(spark, f"{at}/store", result or groups, "sums", by=groups, nulls=True)
    eligible = eligible or (lambda df: df)

    def each(batch: DataFrame, number: int) -> None:
        base, manifest = records.store.current()
        if manifest["batches"].get("stream", -1) >= number:
            return
        entry = records._entry(manifest)
        old = None if entry is None else records._frame(entry)
        own = batch.select(*keys).distinct()
        met = None if old is None else _within(old, own, keys)
        new = better(batch if met is None else batch.unionByName(met)).persist()
        try:
            touched = new.select(*groups) if met is None else new.select(*groups).unionByName(met.select(*groups))
            touched = touched.distinct().persist()
            fresh_records = records.upserted(manifest, new)
            fresh = totals(eligible(_within(records._frame(fresh_records), touched, groups)))
            changes = {"records": fresh_records, "sums": sums.replaced(manifest, fresh, touched, groups)}
            records.store.commit(changes, base, ("stream", number))
            touched.unpersist()
        finally:
            new.unpersist()

    run(stream, lambda batch, number: retried(lambda: each(batch, number)), at, "append")
    return sums.read()


def _within(df: DataFrame, keys: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of df whose key is among the keys; null keys are equal."""
    right = keys.select(*[F.col(f"`{k}`").alias(f"_in_{i}") for i, k in enumerate(names)])
    return df.join(right, [F.col(f"`{k}`").eqNullSafe(F.col(f"_in_{i}")) for i, k in enumerate(names)], "left_semi")


def gated(stream: DataFrame, key: str, order: str, relative: Sequence[str], absolute: str, tie: str, at: str | None = None) -> DataFrame:
    """The change-gated snapshots of a stream, as the batch query gives them, whatever the order in which records come.

    Records are known by key, order and tie. A late one may change which later ones stay, so a key that a batch touches
    is folded afresh from all its records.
    """
    from tideframe.operators.snapshots import change_gated

    rows = stream.select(key, order, tie, *relative, absolute)
    whole = [F.col(c).desc_nulls_last() for c in [*relative, absolute]]
    from tideframe.operators.ranking import latest

    return regrouped(rows, [key, order, tie], lambda df: latest(df, [key, order, tie], whole), [key], lambda df: change_gated(df, [key], order, relative, absolute, tie), at, result=[key, order, tie])


def appended(stream: DataFrame, at: str | None = None) -> DataFrame:
    """All rows of a stream, each once: a batch that is repeated after a failure is left out if it is in already."""
    at = at or folder(stream)
    table = Table(stream.sparkSession, f"{at}/table", stream.columns, nulls=True)

    def each(batch: DataFrame, number: int) -> None:
        if table.store.done("stream") < number:
            table.append(batch, ("stream", number))

    run(stream, lambda batch, number: retried(lambda: each(batch, number)), at, "append")
    return table.read()


def merged(streams: Sequence[DataFrame]) -> DataFrame:
    """All rows of several streams; columns that one lacks are null in it."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def pinned(side: Table, at: str, number: int) -> DataFrame | None:
    """The table in the version that a micro-batch saw first: the batch's number and the version are noted under `at`, so
    that a batch that is repeated after a failure sees the same rows, whatever has become of the table since."""
    note = side.store._hadoop(f"{at}/pins/{number}")
    fs = side.store._fs
    if not fs.exists(note):
        version = side.store.current()[0]
        part = side.store._hadoop(f"{at}/pins/.{number}-{uuid.uuid4().hex}")
        stream = fs.create(part, False)
        try:
            stream.write(bytearray(str(version).encode()))
        finally:
            stream.close()
        fs.rename(part, note)  # one query runs its batches one by one: nobody else is at this note
    stream = fs.open(note)
    try:
        version = int(side.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return side.read(version)


def joined_with(stream: DataFrame, side: Callable[[], DataFrame] | Table, keys: Sequence[str], each: Callable[[DataFrame, int], None], at: str, how: str = "left") -> None:
    """Each micro-batch joined with a table that is read anew for it, so that the table may change while the stream runs.

    A Table is read in the version that the batch saw first; while it isn't there yet, nothing matches. The table's side is
    broadcast only if Spark finds it small enough.
    """

    def joined(batch: DataFrame, number: int) -> None:
        other = pinned(side, at, number) if isinstance(side, Table) else side()
        if other is None:  # no table yet
            other = stream.sparkSession.createDataFrame([], stream.select(*keys).schema)
        each(batch.join(other, list(keys), how), number)

    run(stream, joined, at, "append")


def without_trending(stream: DataFrame, rankings: Table, key: str, side: str, rank: str, top: int, sides: int, at: str | None = None) -> DataFrame:
    """The rows of a stream, appended once each, but for those whose key ranks among the first `top` on so many sides in
    the rankings as they were when the row's micro-batch came."""
    from tideframe.operators.aggregates import without_trending as without

    at = at or folder(stream)
    table = Table(stream.sparkSession, f"{at}/table", stream.columns, nulls=True, unique=False)

    def each(batch: DataFrame, number: int) -> None:
        if table.store.done("stream") < number:
            ranked = pinned(rankings, at, number)
            table.append(batch if ranked is None else without(batch, ranked, key, side, rank, top, sides), ("stream", number))

    run(stream, lambda batch, number: retried(lambda: each(batch, number)), at, "append")
    return table.read()


def against_history(stream: DataFrame, keys: Sequence[str], day: str, value: str, days: int, at: str | None = None, places: int = 6) -> DataFrame:
    """keys, day, score (mean value of the day, to so many places), how many of so many `days` before are stored, and
    `growth` against their mean, of all of a stream; within each micro-batch.

    Sums by key and day are stored in parts by day. A batch changes those of its own days and reads, besides, only the days
    that its days are compared with or that are compared with them, so that late rows correct what came after them. Sums,
    results and the number of the batch are one commit.
    """
    from tideframe.operators.aggregates import against_history as compared

    at = at or folder(stream)
    spark, own = stream.sparkSession, [*keys, day]
    sums = Table(spark, f"{at}/store", own, "sums", by=[day], nulls=True, parted=True)
    result = Table(spark, f"{at}/store", own, "result", by=[day], nulls=True, parted=True)
    totals = stream.filter(F.col(value).isNotNull() & F.col(day).isNotNull()).select(*own, F.col(value).cast("double").alias("total"), F.lit(1).cast("long").alias("n"))
    added = [F.sum("total").alias("total"), F.sum("n").alias("n")]

    def each(batch: DataFrame, number: int) -> None:
        base, manifest = sums.store.current()
        if manifest["batches"].get("stream", -1) >= number:
            return
        fresh = batch.groupBy(*own).agg(*added).persist()
        try:
            touched = [r[0] for r in fresh.select(day).distinct().collect()]  # the days of one batch
            if not touched:
                return
            stored = sums.added(manifest, fresh, added, "n")
            near = {d + timedelta(k) for d in touched for k in range(-days, days + 1)}
            seen = sums._frame(stored, {str(d) for d in near})
            seen = _within(seen, fresh.select(*keys).distinct(), keys).select(*own, F.round(F.col("total") / F.col("n"), places).alias("score"))
            changed = fresh.select(*keys, F.explode(F.sequence(day, F.date_add(day, days))).alias(day)).distinct()
            rows = _within(compared(seen, keys, day, "score", days), changed, own)
            sums.store.commit({"sums": stored, "result": result.upserted(manifest, rows)}, base, ("stream", number))
        finally:
            fresh.unpersist()

    run(totals, lambda batch, number: retried(lambda: each(batch, number)), at, "append")
    return result.read()


def chained(first: Callable[[], Any], then: Sequence[Callable[[], Any]]) -> list[Any]:
    """Queries of which each reads, as a stream of files, what the one before has written, one after the other."""
    return [first(), *[f() for f in then]]


def supervised(spark: SparkSession, starts: Sequence[Callable[[], StreamingQuery]], done: Callable[[], bool] | None = None, poll: float = 0.2) -> None:
    """Queries that run at once, of which one may read what another one writes, until `done` (all have ended, by default).

    When one fails, the others are stopped and its error is raised; when `done` says so, each works through what has come
    and is stopped. starts: functions that start a query with a trigger that goes on.
    """
    queries: list[StreamingQuery] = []
    try:
        for start in starts:
            queries.append(start())
        while True:
            failed = [q for q in queries if not q.isActive and q.exception() is not None]
            if failed:
                raise failed[0].exception()
            if all(not q.isActive for q in queries):
                return
            if done is not None and done():
                for q in queries:
                    close(q)
                return
            time.sleep(poll)
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def close(query: StreamingQuery, poll: float = 0.2) -> None:
    """Stop a query after it has worked through what is there; what its state holds back stays in the checkpoint.

    A query with timers by the clock runs batches all the time and never says that it is through: it is once a batch
    without rows has ended that began after the call.
    """
    last = query.lastProgress
    first = last["batchId"] if last else -1
    through = threading.Thread(target=lambda: query.isActive and query.processAllAvailable(), daemon=True)
    through.start()
    while through.is_alive() and query.isActive:
        last = query.lastProgress
        if last and last["batchId"] >= first + 2 and not last["numInputRows"]:
            break
        time.sleep(poll)
    query.stop()


class Windows(StatefulProcessor):
    """For each key the mean of the last days against that of as many before, from the daily sums that it keeps.

    Days older than two windows go with each batch; with `every` a timer repeats the result by the wall clock, also for
    keys that nothing comes for.
    """

    def __init__(self, days: int, as_of: int | None = None, every_ms: int | None = None):
        self.days, self.as_of, self.every = days, as_of, every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", "day int", "total double, n long")

    def _row(self, key, as_of: int) -> Iterator[pd.DataFrame]:
        recent, prior = [0.0, 0], [0.0, 0]
        for (day,), (total, n) in list(self.sums.iterator()):
            age = as_of - day
            if age >= 2 * self.days:
                self.sums.removeKey((day,))
            elif age >= 0:
                side = recent if age < self.days else prior
                side[0] += total / n
                side[1] += 1
        if recent[1] and prior[1]:
            r, p = recent[0] / recent[1], prior[0] / prior[1]
            yield pd.DataFrame({"key": [key[0]], "as_of": [as_of], "recent_avg": [r], "prior_avg": [p], "growth_rate": [(r - p) / p if p > 0 else 0.0]})

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:
        new: dict[int, tuple[float, int]] = {}
        for part in rows:
            for day, value, count in zip(part["day"].tolist(), part["total"].tolist(), part["n"].tolist()):
                if not count or day is None or day != day:
                    continue
                total, n = new.get(int(day), (0.0, 0))
                new[int(day)] = total + value, n + int(count)
        for day, (value, count) in new.items():
            total, n = self.sums.getValue((day,)) if self.sums.containsKey((day,)) else (0.0, 0)
            self.sums.updateValue((day,), (total + value, n + count))
        if self.every:
            self.handle.registerTimer(timers.getCurrentProcessingTimeInMs() + self.every)
        anchor = self.as_of if self.as_of is not None else max((d for (d,), _ in self.sums.iterator()), default=None)
        if anchor is not None:
            yield from self._row(key, anchor)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.every)
        anchor = self.as_of if self.as_of is not None else max((d for (d,), _ in self.sums.iterator()), default=None)
        if anchor is not None:
            yield from self._row(key, anchor)


#: Rows of sums that a task gathers before it adds them up again.
_GATHERED = 50_000


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums and numbers of values by key and day of what a task reads. NaN counts as null; keys without a value stay,
    with n = 0."""

    def again(parts: list[pa.Table]) -> pa.Table:
        sums = pa.concat_tables(parts).group_by(["key", "day"]).aggregate([("total", "sum"), ("n", "sum")])
        return sums.rename_columns({"total_sum": "total", "n_sum": "n"}).select(["key", "day", "total", "n"])

    own: list[pa.Table] = []
    for batch in batches:
        values = batch.column("value")
        values = pc.if_else(pc.is_nan(values), pa.scalar(None, pa.float64()), values)
        n = pc.cast(pc.is_valid(values), pa.int64())
        own = [again([*own, pa.table({"key": batch.column("key"), "day": batch.column("day"), "total": values, "n": n})])]
        if own[0].num_rows > _GATHERED:
            yield from own.pop().to_batches()
    if own:
        yield from own[0].to_batches()


def growth_state(stream: DataFrame, key: str, day: Column, value: Column, days: int = 3, as_of: int | None = None, every_ms: int | None = None) -> DataFrame:
    """key, as_of, recent_avg, prior_avg, growth_rate after each batch for the keys that it touches, from state that a
    processor keeps and trims. day: a number of days; as_of: the day that counts as the last one, else the greatest of
    each key. Each task sums what it reads by key and day, so that a key, however frequent, costs its task a few rows."""
    rows = stream.select(F.col(key).alias("key"), day.cast("int").alias("day"), value.cast("double").alias("value"))
    kind = dict(rows.dtypes)["key"]
    schema = StructType.fromDDL(f"key {kind}, as_of int, recent_avg double, prior_avg double, growth_rate double")
    sums = rows.mapInArrow(_summed, StructType.fromDDL(f"key {kind}, day int, total double, n long"))
    return sums.groupBy("key").transformWithStateInPandas(Windows(days, as_of, every_ms), schema, "Update", "ProcessingTime" if every_ms else "None")


class Watch(StreamingQueryListener):
    """What queries did: the rows of every batch, observed counters, and how they ended. Ends the others if one fails."""

    def __init__(self, spark: SparkSession, stop_all: bool = False):
        self.spark, self.stop_all = spark, stop_all
        self.rows: dict[str, int] = {}
        self.counters: dict[str, int] = {}
        self.failed: dict[str, str] = {}
        self.ended: list[str] = []

    def onQueryStarted(self, event) -> None:
        self.rows[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:
        own = event.progress
        self.rows[str(own.runId)] = self.rows.get(str(own.runId), 0) + own.numInputRows
        for name, row in (own.observedMetrics or {}).items():
            for field, n in row.asDict().items():
                self.counters[f"{name}.{field}"] = self.counters.get(f"{name}.{field}", 0) + (n or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.append(str(event.runId))
        if event.exception:
            self.failed[str(event.runId)] = event.exception
            if self.stop_all:
                for q in self.spark.streams.active:
                    q.stop()


def counted(df: DataFrame, name: str, reasons: dict[str, Column]) -> DataFrame:
    """df, with a counter of the rows for each reason, which observers and listeners get under `name`."""
    return df.observe(name, *[F.count(F.when(c, 1)).alias(n) for n, c in reasons.items()])

"""Streams with state, over several micro-batches, replays and restarts."""

import random
import time
import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import DATA
from oracle import connect, same
from tideframe.operators import aggregates, snapshots
from tideframe.plans import batches, registry  # noqa: F401
from tideframe.session import STATE_STORE, shared_folder
from tideframe.sources import readers
from tideframe.sources.sinks import Table
from tideframe.streaming import engine, stateful


def at(spark, name):
    return f"{shared_folder(spark)}/tests/{name}-{uuid.uuid4().hex}"


def feed(spark, path, schema, *rows):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)


def tail(spark, path, schema, **more):
    return readers.tail(spark, path, StructType.fromDDL(schema), **more)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


RECORD = "id int, version int, channel string, day int, views long, deleted boolean"


def test_retraction_by_change(spark):
    """Moves, changes, deletes, late, repeated and null records in shuffled batches against sums of the last records."""
    draw = random.Random(4)
    messages = [(i, v, draw.choice(["a", "b", None]), draw.randrange(3), draw.choice([None, 0, 5, 7]), draw.random() < 0.2) for i in [*range(12), None] for v in range(4)]
    messages += draw.sample(messages, 15)  # repeated ones
    messages.append((50, None, "a", 1, 3, None))
    draw.shuffle(messages)
    src, state = at(spark, "src"), at(spark, "state")
    for k in range(4):
        feed(spark, src, RECORD, *messages[k::4])
        got = stateful.retracted(tail(spark, src, RECORD, files=1), ["id"], ["version"], ["channel", "day"], ["views"], state, F.col("deleted"))
        last = {}
        for m in (x for j in range(k + 1) for x in messages[j::4]):
            order = (m[1] is not None, m[1] or 0)
            if m[0] not in last or order > last[m[0]][0]:
                last[m[0]] = order, m
        want = {}
        for _, (i, v, channel, day, views, deleted) in last.values():
            if not deleted:
                n, total = want.get((channel, day), (0, 0))
                want[channel, day] = n + 1, total + (views or 0)
        assert rows_of(got) == sorted(((*g, *x) for g, x in want.items()), key=repr)


def test_retraction_sends_only_changes(spark):
    """What leaves the first stage follows from the batch, not from the records that its groups have already."""
    src, state = at(spark, "src"), at(spark, "state")
    sent = []

    def go(*rows):
        feed(spark, src, RECORD, *rows)
        sent.clear()
        stream = stateful.changes(tail(spark, src, RECORD), ["id"], ["version"], ["channel"], ["views"], F.col("deleted"))
        engine.run(stream, lambda batch, n: sent.extend(map(tuple, batch.collect())), state)
        return sorted(sent)

    assert len(go(*[(i, 1, "a", 1, 10, False) for i in range(100)])) == 100
    assert go((7, 2, "b", 1, 11, False)) == [("a", -1, -10), ("b", 1, 11)]
    assert go((7, 1, "c", 1, 99, False), (8, 2, "a", 1, 10, False)) == []  # late, and a change of nothing
    assert go((7, 3, "b", 1, 11, True), (9, 2, "a", 1, 12, False)) == [("a", -1, -10), ("a", 1, 12), ("b", -1, -11)]
    assert go((7, 4, "c", 1, 1, False)) == [("c", 1, 1)]


def test_retraction_keeps_buckets_of_keys(spark):
    """State and calls are by bucket, not by key."""
    src = at(spark, "src")
    feed(spark, src, RECORD, *[(i, 1, "a", 1, 10, False) for i in range(300)])
    stream, sent = stateful.changes(tail(spark, src, RECORD), ["id"], ["version"], ["channel"], ["views"], buckets=4), []
    query = engine.run(stream, lambda batch, n: sent.extend(map(tuple, batch.collect())), at(spark, "state"))
    assert sent == [("a", 1, 10)] * 300 and query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4


class State:
    """A value of Spark's state, and the handle that gives it."""

    def __init__(self):
        self.value = None

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("gathered", [3, 1000])
def test_changes_of_a_bucket(monkeypatch, gathered):
    """What a bucket sends adds up to the last records after each batch, for keys and groups of every kind."""
    monkeypatch.setattr(stateful, "_ROWS", gathered)
    draw, nan = random.Random(11), float("nan")
    keys = [(a, b, c) for a in (0.5, nan, None, -1.0) for b in ([1], [1, None], None) for c in (True, None)]
    kinds = pa.schema([("a", pa.float64()), ("b", pa.list_(pa.int32())), ("c", pa.bool_()), ("v", pa.int32()), ("o", pa.list_(pa.int32())), ("g", pa.list_(pa.string())), ("n", pa.int64()), ("gone", pa.bool_()), ("_bucket", pa.int32())])
    own = stateful.Retraction(3, 2, 1, 1, ["g", "n", "x"])
    own.init(state := State())
    last, sums = {}, {}
    for _ in range(5):
        rows = [(*draw.choice(keys), draw.choice([None, 1, 2, 3]), draw.choice([None, [1], [1, 2]]), draw.choice([["p"], ["p", "q"], None]), draw.choice([2**60 + 1, 5, None]), draw.random() < 0.2, draw.choice([0])) for _ in range(draw.choice([1, 40]))]
        for row in rows:
            key, order = repr(row[:3]), stateful._ordered([row[3], row[4] or []])[:1] + ((row[4] is not None, row[4] or []),)
            if key not in last or order > last[key][0]:
                last[key] = order, row
        batches = [pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in rows[i : i + 7]], kinds) for i in range(0, len(rows), 7)]
        packets = [{"_rows": x} for b in stateful._by_bucket(iter(batches)) for x in b.column("_rows").to_pylist()]
        sent = [r["_rows"] for r in own.handleInputRows((0,), iter(packets), None)]
        for batch in stateful._rows_in([pa.RecordBatch.from_arrays([pa.array(sent, pa.binary())], ["_rows"])]):
            for g, n, x in zip(*batch.to_pydict().values()):
                old = sums.get(repr(g), (0, 0))
                sums[repr(g)] = old[0] + n, old[1] + (x or 0)
        want = {}
        for _, row in last.values():
            if not row[7]:
                old = want.get(repr(row[5]), (0, 0))
                want[repr(row[5])] = old[0] + 1, old[1] + (row[6] or 0)
        assert {g: x for g, x in sums.items() if x != (0, 0)} == want


def test_fed_batches_are_several_files(spark):
    """Each part is one micro-batch of as many files as cores, also one of few rows or none."""
    df = spark.range(1000)
    part = F.when(F.col("id") < 900, 0).when(F.col("id") < 901, 2).otherwise(3)
    stream, got = batches.fed(df, part, 4).withColumn("file", F.input_file_name()), {}
    engine.run(stream, lambda batch, n: got.update({n: batch.collect()}), at(spark, "state"), "append")
    assert {n: sorted(r.id for r in rows) for n, rows in got.items()} == {0: [*range(900)], 1: [], 2: [900], 3: [*range(901, 1000)]}
    assert len({r.file for r in got[0]}) == spark.sparkContext.defaultParallelism > 1


SNAPSHOT = "k int, t int, id int, views int, score double"


def test_gate_as_state(spark):
    """Over ordered batches the batch query's rows, appended only; late and repeated ones are left out."""
    draw = random.Random(6)
    rows = [(draw.choice([1, 2, 3, None]), t, i, draw.choice([None, 0, 100, 103, 104, 109, 115]), draw.choice([None, 0.0, 0.1, 0.3])) for i, t in enumerate(sorted(draw.choices(range(40), k=120)))]
    src, state = at(spark, "src"), at(spark, "state")
    files = []
    for k in range(0, 120, 40):
        part = rows[k : k + 40]
        draw.shuffle(part)
        cut = max(r[1] for r in rows[:k]) if k else -1
        rows[k : k + 40] = part = [(a, b + (b == cut), *c) for a, b, *c in part]
        feed(spark, src, SNAPSHOT, *part)
        got = stateful.gated_append(tail(spark, src, SNAPSHOT, files=1), ["k"], "t", ["views"], "score", "id", state)
        want = snapshots.change_gated(spark.createDataFrame(rows[: k + 40], SNAPSHOT), ["k"], "t", ["views"], "score", "id")
        assert rows_of(got) == rows_of(want)
        assert set(files) <= set(got.inputFiles())  # nothing that was stored is written anew
        files = got.inputFiles()
    before = rows_of(got)
    feed(spark, src, SNAPSHOT, (1, 0, 999, 10**6, 9.0), *rows[-3:])
    assert rows_of(stateful.gated_append(tail(spark, src, SNAPSHOT), ["k"], "t", ["views"], "score", "id", state)) == before


def test_a_side_table_that_changes_between_batches_and_a_replay(spark):
    src, state = at(spark, "src"), at(spark, "state")
    ranks = Table(spark, at(spark, "ranks"), ["side", "key"])
    ranked = lambda *r: spark.createDataFrame([(s, k, n) for s, k, n in r], "side string, key string, rank int")

    def go():
        return rows_of(engine.without_trending(tail(spark, src, "key string, v int"), ranks, "key", "side", "rank", 2, 2, state))

    feed(spark, src, "key string, v int", ("x", 1), ("y", 1))
    assert go() == [("x", 1), ("y", 1)]  # no rankings yet
    ranks.overwrite(ranked(("yt", "x", 1), ("tt", "x", 2), ("yt", "y", 2), ("tt", "y", 3)))
    feed(spark, src, "key string, v int", ("x", 2), ("y", 2))
    assert go() == [("x", 1), ("y", 1), ("y", 2)]

    # a batch fails after it has seen the table; before it is repeated the table changes
    store, append = engine.Table, engine.Table.append

    def dies(self, df, batch=None):
        df.count()
        raise RuntimeError("gone")

    feed(spark, src, "key string, v int", ("x", 3), ("y", 3))
    store.append = dies
    try:
        with pytest.raises(Exception, match="gone"):
            go()
    finally:
        store.append = append
    ranks.overwrite(ranked(("yt", "y", 1), ("tt", "y", 1)))
    assert go() == [("x", 1), ("y", 1), ("y", 2), ("y", 3)]
    feed(spark, src, "key string, v int", ("x", 4), ("y", 4))
    assert go() == [("x", 1), ("x", 4), ("y", 1), ("y", 2), ("y", 3)]


def test_a_pinned_table_joined(spark):
    src, state = at(spark, "src"), at(spark, "state")
    names = Table(spark, at(spark, "names"), ["key"])
    out = []

    def go():
        engine.joined_with(tail(spark, src, "key string, v int"), names, ["key"], lambda batch, n: out.append((n, rows_of(batch))), state)

    feed(spark, src, "key string, v int", ("x", 1))
    go()
    names.upsert(spark.createDataFrame([("x", "one")], "key string, name string"))
    feed(spark, src, "key string, v int", ("x", 2))
    go()
    assert out == [(0, [("x", 1)]), (1, [("x", 2, "one")])]
    assert engine.pinned(names, state, 0) is None and engine.pinned(names, state, 1).count() == 1


def test_history_within_batches(spark):
    """Late rows, nulls and restarts; only the parts of the days that matter are read."""
    import datetime

    draw = random.Random(9)
    day = lambda n: datetime.date(2024, 1, 1) + datetime.timedelta(n)
    schema, rows = "k string, d date, v double", []
    src, state = at(spark, "src"), at(spark, "state")
    for days in ((10, 11, 12), (13, 11), (30,), (9, 14, 31)):
        new = [(draw.choice(["a", "b", None]), day(draw.choice(days)), draw.choice([None, 1.0, 2.5, 4.0, 0.0])) for _ in range(12)] + [("a", None, 1.0)]
        rows += new
        feed(spark, src, schema, *new)
        read = []
        frame = Table._frame

        def watched(self, entry, buckets=None):
            out = frame(self, entry, buckets)
            if self.name == "sums":
                read.append({f.split("_bucket=")[1].split("/")[0] for f in out.inputFiles()})
            return out

        Table._frame = watched
        try:
            got = engine.against_history(tail(spark, src, schema, files=1), ["k"], "d", "v", 3, state)
        finally:
            Table._frame = frame
        near = {str(day(d + k)) for d in days for k in range(-3, 4)}
        assert read and all(r <= near for r in read)
        means = spark.createDataFrame(rows, schema).filter("v IS NOT NULL AND d IS NOT NULL").groupBy("k", "d").agg(F.round(F.avg("v"), 6).alias("score"))
        assert rows_of(got) == rows_of(aggregates.against_history(means, ["k"], "d", "score", 3))


def test_timers_let_go_what_nothing_comes_for(spark):
    """A key that gets no more rows is let go by the clock; another by its size; a third when work ends."""
    src, state = at(spark, "src"), at(spark, "state")
    feed(spark, src, "k string, n long", ("slow", 2), ("big", 3), ("last", 1))
    out = []
    query = engine.run(stateful.held(tail(spark, src, "k string, n long"), "k", F.col("n"), 5, 6_000), lambda batch, n: out.extend(map(tuple, batch.collect())), state, every="500 milliseconds")

    def until(want, seconds=90):
        end = time.time() + seconds
        while time.time() < end and not want() and query.isActive:
            time.sleep(0.2)
        assert want(), out

    try:
        feed(spark, src, "k string, n long", ("big", 4))
        until(lambda: ("slow", 2) in out and ("last", 1) in out)
        feed(spark, src, "k string, n long", ("last", 3))
        feed(spark, src, "k string, n long", ("last", None))  # work ends
        engine.close(query)
    finally:
        query.stop()
    sums = {}
    for k, n in out:
        sums[k] = sums.get(k, 0) + n
    assert sums == {"slow": 2, "big": 7, "last": 4}


def test_windows_by_the_clock(spark):
    """A result is repeated by the clock for a key that nothing more comes for."""
    src, state = at(spark, "src"), at(spark, "state")
    schema = "k string, d int, v double"
    feed(spark, src, schema, ("a", 1, 1.0), ("a", 2, 3.0))
    grown = engine.growth_state(tail(spark, src, schema), "k", F.col("d"), F.col("v"), 1, every_ms=1_000)
    seen = []
    query = engine.run(grown, lambda batch, n: seen.append(rows_of(batch)), state, every="500 milliseconds")
    try:
        end = time.time() + 90
        while time.time() < end and sum(map(bool, seen)) < 3:
            time.sleep(0.2)
    finally:
        query.stop()
    assert sum(map(bool, seen)) >= 3 and {tuple(x) for x in seen if x} == {(("a", 2, 3.0, 1.0, 2.0),)}


def test_queries_at_once(spark):
    """One reads what the other writes while both run; all are stopped when done."""
    src, mid, state = at(spark, "src"), at(spark, "mid"), at(spark, "state")
    feed(spark, src, "v int", (1,), (2,))
    feed(spark, mid, "v int", (0,))
    got = []

    def first():
        return engine.run(tail(spark, src, "v int"), lambda b, n: b.selectExpr("v * 10 AS v").write.mode("append").parquet(mid), f"{state}/1", "append", "300 milliseconds", "first")

    def second():
        return engine.run(tail(spark, mid, "v int"), lambda b, n: got.extend(r.v for r in b.collect()), f"{state}/2", "append", "300 milliseconds", "second")

    fed = []

    def done():
        if not fed and 20 in got:
            fed.append(feed(spark, src, "v int", (3,)))
        return 30 in got

    engine.supervised(spark, [first, second], done)
    assert sorted(got) == [0, 10, 20, 30] and not spark.streams.active


def test_one_that_fails_stops_all(spark):
    src, state = at(spark, "src"), at(spark, "state")
    feed(spark, src, "v int", (1,))
    started = []

    def fails(batch, n):
        time.sleep(1)
        raise RuntimeError("broken")

    def start(name, each):
        def f():
            started.append(engine.run(tail(spark, src, "v int"), each, f"{state}/{name}", "append", "300 milliseconds"))
            return started[-1]

        return f

    with pytest.raises(Exception, match="broken"):
        engine.supervised(spark, [start("bad", fails), start("good", lambda b, n: None)])
    assert len(started) == 2 and not any(q.isActive for q in started)
    started.clear()
    with pytest.raises(ValueError):  # one that can't even start
        engine.supervised(spark, [start("well", lambda b, n: None), lambda: (_ for _ in ()).throw(ValueError("no"))])
    assert not any(q.isActive for q in started)


@pytest.mark.parametrize("name", ["stream_channel_timeline_by_change", "stream_snapshot_gate_by_state"])
def test_state_by_key_in_a_session_with_the_default_store(spark, name):
    """The setting that processors by key need isn't asked of the session, and the session's own one stays."""
    before, default = spark.conf.get(STATE_STORE), "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(STATE_STORE, default)
    try:
        same(registry.QUERIES[name](spark, f"{DATA}/sf0.001"), connect(f"{DATA}/sf0.001"), registry.ORACLE[name])
        assert spark.conf.get(STATE_STORE) == default
    finally:
        spark.conf.set(STATE_STORE, before)


def test_growth_state_gets_sums(spark):
    """A task sums what it reads: the processor gets a row for each key and day, NaN and nulls count nothing."""
    seen = engine._summed(iter([pa.RecordBatch.from_pydict({"key": ["a", "a", None, "a", "b"] * 2, "day": [1, 1, 2, None, 3] * 2, "value": [1.0, float("nan"), 2.5, 4.0, None] * 2}) for _ in range(3)]))
    rows = sorted((tuple(r.values()) for b in seen for r in b.to_pylist()), key=repr)
    assert rows == sorted([("a", 1, 6.0, 6), (None, 2, 15.0, 6), ("a", None, 24.0, 6), ("b", 3, None, 0)], key=repr)

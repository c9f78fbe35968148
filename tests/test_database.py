"""Merging into a database (Derby, which comes with Spark), in memory."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideframe.session import shared_folder
from tideframe.sources import database, readers
from tideframe.streaming import engine

TYPES = {"platform": "VARCHAR(5)", "day": "INTEGER", "views": "BIGINT", "score": "DOUBLE"}
KEYS = ["platform", "day"]


@pytest.fixture
def base(spark):
    db = database.Database(spark, f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert db.ensure("totals", TYPES, KEYS) and not db.ensure("totals", TYPES, KEYS)
    return db


def rows(spark, *own):
    return spark.createDataFrame(list(own), "platform string, day int, views long, score double")


def stored(db, table="totals"):
    return sorted(map(tuple, db.read(table).select(*TYPES).collect()))


def test_rows_are_merged(spark, base):
    assert [(f.name, f.nullable, f.length) for f in base.fields("totals")] == [("platform", False, 5), ("day", False, None), ("views", True, None), ("score", True, None)]
    for _ in range(2):  # twice the same
        base.upsert(rows(spark, ("a", 1, 10, 0.5), ("b", 1, 5, None)).repartition(3), "totals", KEYS)
        assert stored(base) == [("a", 1, 10, 0.5), ("b", 1, 5, None)]
    base.upsert(rows(spark, ("a", 1, 0, 0.0), ("c", 2, 0, 0.0), ("b", 1, 6, 1.0), ("d", 1, None, 2.0)), "totals", KEYS, gone='s."views" = 0')
    assert stored(base) == [("b", 1, 6, 1.0)]  # what is open in SQL is neither deleted nor inserted
    base.overwrite(rows(spark, ("z", 9, 9, 9.0)), "totals")
    assert stored(base) == [("z", 9, 9, 9.0)] and [f.nullable for f in base.fields("totals")] == [False, False, True, True]


def test_rows_that_do_not_fit_are_set_aside(spark, base):
    bad = base.upsert(rows(spark, ("a", 1, 1, 1.0), ("too long", 1, 1, 1.0), (None, 1, 1, 1.0), ("b", 1, 1, float("nan")), ("c", 1, 1, float("inf"))), "totals", KEYS)
    assert stored(base) == [("a", 1, 1, 1.0)]
    assert sorted(r.reason for r in bad.collect()) == ["platform has more than 5 characters", "platform is null", "score is not a number", "score is not a number"]
    with pytest.raises(ValueError, match="unique"):
        base.upsert(rows(spark, ("a", 1, 1, 1.0), ("a", 1, 2, 1.0)), "totals", KEYS)
    with pytest.raises(ValueError, match="no columns"):
        base.upsert(rows(spark, ("a", 1, 1, 1.0)).withColumn("more", F.lit(1)), "totals", KEYS)
    assert base.upsert(rows(spark), "totals", KEYS).count() == 0 and stored(base) == [("a", 1, 1, 1.0)]


def test_a_failed_transaction_leaves_the_table_as_it_was(spark, base):
    base.upsert(rows(spark, ("a", 1, 1, 1.0)), "totals", KEYS)
    with pytest.raises(Exception, match="truncation"):  # the statement after the merge fails
        base.upsert(rows(spark, ("a", 1, 2, 1.0), ("b", 1, 500, 1.0), ("c", 1, 3, 1.0)), "totals", KEYS, stream=("s" * 300, 0))
    assert stored(base) == [("a", 1, 1, 1.0)] and base.done("s" * 300) == -1
    names = base.transaction(lambda c: [x for r in [c.getMetaData().getTables(None, None, "totals%", None)] for x in iter(lambda: r.getString("TABLE_NAME") if r.next() else None, None)])
    assert names == ["totals"]  # no staging table is left


def test_lost_connections_are_tried_again(spark, base, monkeypatch):
    waits = []
    monkeypatch.setattr(database, "retried", lambda f, again: __import__("tideframe.sources.sinks", fromlist=["x"]).retried(f, wait=waits.append, again=again))
    execute, lost = base.execute, iter([True, True, False])

    def flaky(*statements):
        if statements[0].startswith("MERGE") and next(lost):
            raise OSError("gone")
        return execute(*statements)

    monkeypatch.setattr(base, "execute", flaky)
    base.upsert(rows(spark, ("a", 1, 1, 1.0)), "totals", KEYS)
    assert stored(base) == [("a", 1, 1, 1.0)] and waits == [1, 2]
    try:
        execute('INSERT INTO "totals" VALUES (\'a\', 1, 1, 1)')
    except Exception as e:
        assert not database.passing(e)


def test_a_repeated_batch_changes_nothing(spark, base):
    src = f"{shared_folder(spark)}/tests/db-{uuid.uuid4().hex}"
    rows(spark, ("a", 1, 1, 1.0), ("b", 1, 2, 1.0)).coalesce(1).write.parquet(src)
    stream = readers.tail(spark, src, StructType.fromDDL("platform string, day int, views long, score double"))
    calls = []

    def each(batch, number):
        base.upsert(batch, "totals", KEYS, stream=("totals", number))
        calls.append(number)
        if calls == [0]:
            raise RuntimeError("after the commit")

    with pytest.raises(Exception, match="after the commit"):
        engine.run(stream, each, f"{src}-state", "append")
    base.execute('UPDATE "totals" SET "views" = 77')  # would be overwritten if the batch came again
    engine.run(stream, each, f"{src}-state", "append")
    assert calls == [0, 0] and [r[2] for r in stored(base)] == [77, 77] and base.done("totals") == 0


def test_embedded_database_is_reached_by_the_driver_alone(spark):
    """Executors only see files: neither staging nor reading opens a connection in a task. Texts come back as they were."""
    db = database.Embedded(spark, f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    db.ensure("odd", {"k": "BIGINT", "s": "VARCHAR(20)", "d": "DOUBLE", "b": "BOOLEAN"}, ["k"])
    texts = ["", None, 'a "q", b', " c ", "x\ny", "š,", "'", "\\", '"']
    rows = [(i, t, None if i == 1 else i / 3, i % 2 == 0) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "k long, s string, d double, b boolean").repartition(3)
    bad = db.upsert(df.select("s", "k", "d", "b"), "odd", ["k"])
    assert bad.count() == 0 and sorted(map(tuple, db.read("odd").collect())) == rows
    assert "JDBC" not in db.read("odd")._jdf.queryExecution().executedPlan().toString()
    db.upsert(df.limit(0), "odd", ["k"])
    db.overwrite(df.filter("k < 2"), "odd")
    assert sorted(map(tuple, db.read("odd").collect())) == rows[:2] and db.count("odd") == 2

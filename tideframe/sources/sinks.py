"""Writing: keyed tables with versions, upserts, replacement by key, appends, checked loads, retries.

A store is a folder of data and a log of numbered manifests; each names the folders that make up every table of the
store. A writer adds data and then the next manifest, which is created only if no other writer was first. So a reader
sees all of a write or nothing of it, also of one to several tables, a failed write leaves the last version in place, and
of two writers one is told. Tables are dealt by a hash of their key, so that a write rewrites only the buckets it touches.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Manifests that stay, with the data that they name: older readers go on undisturbed for so many writes.
KEPT = 10
#: Seconds after which a manifest that isn't whole counts as left behind.
GRACE = 60.0
#: Bytes of a bucket from which on a table is dealt out among more of them.
BUCKET = 256 << 20


class Conflict(Exception):
    """Another writer committed first; read again and repeat."""


class Store:
    """The log of a folder: what the current version consists of."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._log = self._hadoop(f"{self.path}/_log")
        self._fs = self._log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def numbers(self) -> list[int]:
        if not self._fs.exists(self._log):
            return []
        return sorted(int(s.getPath().getName()[:-5]) for s in self._fs.listStatus(self._log) if s.getPath().getName().endswith(".json"))

    def _file(self, number: int):
        return self._hadoop(f"{self.path}/_log/{number:012d}.json")

    def manifest(self, number: int) -> dict | None:
        """What a version consists of; None if its writer broke off in the middle."""
        stream = self._fs.open(self._file(number))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        except ValueError:
            return None
        finally:
            stream.close()

    def current(self) -> tuple[int, dict]:
        """The last whole manifest and its number; 0 and an empty one if there is none."""
        for n in reversed(self.numbers()):
            found = self.manifest(n)
            if found is not None:
                return n, found
        return 0, {"tables": {}, "batches": {}}

    def at(self, number: int) -> dict:
        """A version that vacuum() has not dropped yet."""
        found = self.manifest(number) if number else {"tables": {}, "batches": {}}
        if found is None:
            raise ValueError(f"{self.path} has no whole version {number}")
        return found

    def commit(self, tables: dict[str, dict], base: int, batch: tuple[str, int] | None = None) -> int:
        """The next version: these tables are new, the others as in version `base`, the one that the writer has read; its
        number.

        A manifest that isn't whole is one that another writer is at, so that this one has lost, or, if it is older than
        GRACE, one whose writer broke off. Such a writer, if it comes back, finds a version that was not built on its own.
        """
        number, now = self.current()
        if number != base:
            raise Conflict(f"{self.path} went from version {base} to {number}")
        last = max(self.numbers(), default=0)
        if last != number and self._age(last) < GRACE:
            raise Conflict(f"{self.path} gets a version {last} at the moment")
        now["tables"] |= tables
        now["parent"] = number
        if batch:
            now["batches"][batch[0]] = batch[1]
        try:
            stream = self._fs.create(self._file(last + 1), False)
        except Py4JJavaError as e:
            raise Conflict(f"{self.path} has a version {last + 1} already") from e
        try:
            stream.write(bytearray(json.dumps(now).encode()))
        finally:
            stream.close()
        later = [m for n in self.numbers() if n > last + 1 and (m := self.manifest(n))]
        if any(m["parent"] <= number for m in later):
            raise Conflict(f"{self.path} went on without version {last + 1}")
        if last % KEPT == 0:
            self.vacuum()
        return last + 1

    def _age(self, number: int) -> float:
        return time.time() - self._fs.getFileStatus(self._file(number)).getModificationTime() / 1000

    def done(self, name: str) -> int:
        """The last micro-batch of a stream whose results are in; -1 if there is none."""
        return self.current()[1]["batches"].get(name, -1)

    def vacuum(self, kept: int = KEPT) -> None:
        """Drop all manifests but the last ones, and data that none of these names and that is older than all of them."""
        numbers = self.numbers()
        keep = numbers[-kept:]
        found = [m for m in map(self.manifest, keep) if m is not None]
        if not found:
            return
        first = min(self._fs.getFileStatus(self._file(n)).getModificationTime() for n in keep)
        named = {folder for m in found for t in m["tables"].values() for folders in t["buckets"].values() for folder in folders}
        data = self._hadoop(f"{self.path}/data")
        for s in self._fs.listStatus(data) if self._fs.exists(data) else ():
            if s.getPath().getName() not in named and s.getModificationTime() < first:
                self._fs.delete(s.getPath(), True)
        for n in numbers[:-kept]:
            self._fs.delete(self._file(n), False)


class Table:
    """A table of a store, known by its natural key. Null keys are keys like others where `nulls` allows them; without
    `unique` rows of one key may be several, as in a log.

    Rows are dealt by a hash of `by`, the key or a part of it, to a number of buckets that grows with the table; with
    `parted` each value of by (one column) has a part of its own instead, which suits days. A write rewrites the buckets or
    parts that it touches.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], name: str = "table", buckets: int = 8, by: Sequence[str] | None = None, nulls: bool = False, parted: bool = False, unique: bool = True
    ):
        self.spark, self.keys, self.name, self.buckets, self.nulls, self.parted, self.unique = spark, list(keys), name, buckets, nulls, parted, unique
        self.store, self.path = Store(spark, path), path.rstrip("/")
        self.by = list(by or keys)

    def _bucket(self, n: int) -> Column:
        if self.parted:
            return F.coalesce(F.col(self.by[0]).cast("string"), F.lit("none"))
        return F.pmod(F.xxhash64(*self.by), F.lit(n)).cast("string")

    def _entry(self, manifest: dict | None = None) -> dict | None:
        return (manifest or self.store.current()[1])["tables"].get(self.name)

    def _frame(self, entry: dict, buckets: Sequence[str] | None = None) -> DataFrame:
        schema = StructType.fromJson(entry["schema"])
        paths = [f"{self.path}/data/{folder}/_bucket={b}" for b, folders in entry["buckets"].items() if buckets is None or b in buckets for folder in folders]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        entry = self._entry(None if version is None else self.store.at(version))
        return None if entry is None else self._frame(entry)

    def parts(self, values: Sequence, manifest: dict | None = None) -> DataFrame | None:
        """Rows of those values of a parted table, of whose parts alone files are read."""
        entry = self._entry(manifest)
        return None if entry is None else self._frame(entry, {"none" if v is None else str(v) for v in values})

    def stage(self, df: DataFrame, n: int | None = None) -> dict:
        """df as data that no version names yet, in n buckets."""
        n, folder = n or self.buckets, uuid.uuid4().hex
        rows = df.withColumn("_bucket", self._bucket(n))
        rows = rows.repartition("_bucket") if self.parted else rows.repartition(n, "_bucket")
        rows.write.partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
        parts = [s.getPath() for s in self.store._fs.listStatus(self.store._hadoop(f"{self.path}/data/{folder}"))]
        parts = {p.getName().split("=")[1]: self.store._fs.getContentSummary(p).getLength() for p in parts if p.getName().startswith("_bucket=")}
        schema = StructType.fromJson(df.schema.jsonValue())
        for f in schema.fields:
            f.nullable = True
        return {"schema": schema.jsonValue(), "n": n, "bytes": parts, "buckets": {b: [folder] for b in parts}}

    def _wider(self, staged: dict) -> dict:
        """A staged table again, with as many buckets as its size asks for."""
        n, size = staged["n"], sum(staged["bytes"].values())
        while not self.parted and size > n * BUCKET:
            n *= 2
        return staged if n == staged["n"] else self.stage(self._frame(staged), n)

    def overwrite(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        base, _ = self.store.current()
        new = self.stage(df)
        self.checked(self._frame(new))
        self.store.commit({self.name: self._wider(new)}, base, batch)

    def ensure(self, df: DataFrame) -> bool:
        """Write df if the table isn't there yet; whether it was written."""
        if self._entry() is not None:
            return False
        self.overwrite(df)
        return True

    def like(self, other: Table) -> None:
        """An empty table with the columns of another one."""
        self.overwrite(other.read().limit(0))

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> None:
        """More rows, whatever their key: for logs, where a repeated write repeats its rows unless its batch says which it is."""
        base, manifest = self.store.current()
        old = self._entry(manifest)
        new = self.stage(df, old and old["n"])
        if old is not None:
            both = {**old["buckets"], **new["buckets"]}
            new["bytes"] = {b: old["bytes"].get(b, 0) + new["bytes"].get(b, 0) for b in both}
            new["buckets"] = {b: [*old["buckets"].get(b, []), *new["buckets"].get(b, [])] for b in both}
        self.store.commit({self.name: self._wider(new)}, base, batch)

    def load(self, df: DataFrame) -> int:
        """Overwrite and check that all rows have come, before any reader sees them; how many they are."""
        base, _ = self.store.current()
        new = self.stage(df)
        want, got = df.count(), self._frame(new).count()
        if want != got:
            raise ValueError(f"{want} rows were to come, {got} came")
        self.checked(self._frame(new))
        self.store.commit({self.name: self._wider(new)}, base)
        return got

    def checked(self, df: DataFrame) -> None:
        """Keys may not be twice in df, nor null unless the table allows it."""
        if not self.unique:
            return
        rules = ["_n > 1", *([] if self.nulls else [f"`{k}` IS NULL" for k in self.keys])]
        if not df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).filter(" OR ".join(rules)).isEmpty():
            raise ValueError(f"keys {self.keys} are null or not unique")

    def _typed(self, entry: dict, df: DataFrame) -> DataFrame:
        """The columns of df that the table has, with its types, as a key's hash depends on them."""
        kinds = {f.name: f.dataType for f in StructType.fromJson(entry["schema"]).fields}
        return df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in df.columns if c in kinds])

    def _rewritten(self, entry: dict, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> dict:
        """The table with the buckets that the keys fall in changed, the others as they were."""
        touched = {r[0] for r in keys.select(self._bucket(entry["n"]).alias("b")).distinct().collect()}  # as many as there are buckets at most
        new = self.stage(change(self._frame(entry, touched)), entry["n"])
        for what in ("buckets", "bytes"):
            new[what] = {b: x for b, x in entry[what].items() if b not in touched} | new[what]
        return self._wider(new)

    def upserted(self, manifest: dict, df: DataFrame, update: bool = True) -> dict:
        """The table as an upsert makes it, not committed."""
        self.checked(df)
        entry = self._entry(manifest)
        if entry is None:
            return self._wider(self.stage(df))
        df = self._typed(entry, df)
        return self._rewritten(entry, df, lambda old: _without(old, df, self.keys).unionByName(df) if update else old.unionByName(_without(df, old, self.keys)))

    def upsert(self, df: DataFrame, update: bool = True, batch: tuple[str, int] | None = None) -> None:
        """Rows of df replace those of their key (or, without update, only come where the key is new)."""
        base, manifest = self.store.current()
        self.store.commit({self.name: self.upserted(manifest, df, update)}, base, batch)

    def added(self, manifest: dict, df: DataFrame, sums: Sequence[Column], count: str) -> dict:
        """The table with df's numbers added to those of its keys, not committed; rows whose count comes to 0 go."""
        entry = self._entry(manifest)

        def change(old: DataFrame) -> DataFrame:
            return old.unionByName(df).groupBy(*self.keys).agg(*sums).filter(F.col(count) != 0)

        if entry is None:
            return self._wider(self.stage(df.filter(F.col(count) != 0)))
        df = self._typed(entry, df)
        return self._rewritten(entry, df, change)

    def replaced(self, manifest: dict, df: DataFrame, processed: DataFrame, source: Sequence[str]) -> dict:
        """The table as a replacement makes it, not committed."""
        entry = self._entry(manifest)
        if entry is None:
            return self._wider(self.stage(df))
        df, processed = self._typed(entry, df), self._typed(entry, processed)
        if set(self.by) <= set(source):
            return self._rewritten(entry, processed.select(*self.by).unionByName(df.select(*self.by)), lambda old: _without(old, processed, source).unionByName(df))
        return self._wider(self.stage(_without(self._frame(entry), processed, source).unionByName(df), entry["n"]))

    def replace(self, df: DataFrame, processed: DataFrame, source: Sequence[str]) -> None:
        """Rows of every processed source go, those of df come, in one step."""
        base, manifest = self.store.current()
        self.store.commit({self.name: self.replaced(manifest, df, processed, source)}, base)

    def delete(self, keys: DataFrame) -> None:
        base, manifest = self.store.current()
        entry = self._entry(manifest)
        if entry is not None:
            keys = self._typed(entry, keys)
            self.store.commit({self.name: self._rewritten(entry, keys, lambda old: _without(old, keys, self.keys))}, base)


def _without(df: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose key isn't in gone; null keys are equal."""
    right = gone.select(*[F.col(f"`{k}`").alias(f"_gone_{i}") for i, k in enumerate(keys)]).distinct()
    on = [F.col(f"`{k}`").eqNullSafe(F.col(f"_gone_{i}")) for i, k in enumerate(keys)]
    return df.join(right, on, "left_anti")


def publish(tables: dict[Table, DataFrame]) -> None:
    """Several tables of one store in one step, their keys checked: a reader sees all of them new or none."""
    first = next(iter(tables))
    if len({t.path for t in tables}) > 1 or len({t.name for t in tables}) != len(tables):
        raise ValueError("the tables must be different ones of one store")
    base, _ = first.store.current()
    staged = {t: t.stage(df) for t, df in tables.items()}
    for t, new in staged.items():
        t.checked(t._frame(new))
    first.store.commit({t.name: t._wider(new) for t, new in staged.items()}, base)


def overwrite(df: DataFrame, path: str, kind: str = "parquet", mode: str = "overwrite", **options: str) -> None:
    """df in any format that Spark knows; mode "ignore" leaves alone what is there already."""
    df.write.format(kind).mode(mode).options(**options).save(path)


def as_messages(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """key and value as text, as a topic takes them: the key's columns and all columns, each as JSON."""
    return df.select(F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def transient(error: Exception) -> bool:
    """Whether a repetition may help: lost writers' races and files or connections that failed, not wrong data."""
    if isinstance(error, (Conflict, OSError)):
        return True
    if isinstance(error, (Py4JJavaError, PySparkException)):
        text = str(error)
        return any(w in text for w in ("IOException", "SQLTransient", "SQLRecoverable", "ConnectException", "SocketTimeout", "ExecutorLost", "FetchFailed"))
    return False


def retried(action: Callable[[], None], attempts: int = 8, longest: float = 30, wait: Callable[[float], None] = time.sleep, again: Callable[[Exception], bool] = transient) -> None:
    """Do it, and again after 1, 2, 4, ... seconds if it fails in a way that may pass, so many times."""
    for n in range(attempts):
        try:
            return action()
        except Exception as e:
            if n == attempts - 1 or not again(e):
                raise
            wait(min(longest, 2.0**n))

"""Tables of a database: rows merged by key, in one transaction, and what doesn't fit set aside.

Executors write a staging table, in as many connections as the frame has partitions; the driver then merges it into the
target with one statement, so that a reader sees all of a write or nothing, and a write that fails leaves the table as it
was. The statements are those of the SQL standard (MERGE), not of one database.
"""

from __future__ import annotations

import glob
import os
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideframe.session import shared_folder
from tideframe.sources.sinks import retried, transient

#: Classes of SQLSTATE for which a repetition may help (connection lost, transaction rolled back, no
#: resources, shut down by an operator), and java.sql.Types of texts.
PASSING = ("08", "40", "53", "57")
_TEXTS = (1, 12, -1, -15, -9, -16)


def quoted(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


@dataclass(frozen=True)
class Field:
    """A column of a table: whether it takes nulls, and the most characters, if it is a text."""

    name: str
    nullable: bool
    length: int | None


def passing(error: Exception) -> bool:
    """Whether a repetition may help: the cause is a lost connection or transaction, not the data."""
    cause = getattr(error, "java_exception", None)
    while cause is not None:
        state = cause.getSQLState() if hasattr(cause, "getSQLState") and "SQL" in cause.getClass().getName() else None
        if state:
            return state[:2] in PASSING
        cause = cause.getCause()
    return transient(error)


class Database:
    """A database by its JDBC URL and properties (user, password, driver). Executors must reach it too."""

    def __init__(self, spark: SparkSession, url: str, **properties: str):
        self.spark, self.url, self.properties = spark, url, properties

    def transaction(self, work: Callable[[Any], Any]) -> Any:
        """What work(connection) gives, committed; rolled back if it fails."""
        jvm = self.spark._jvm
        own = jvm.java.util.Properties()
        for k, v in self.properties.items():
            own.setProperty(k, v)
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        connection = jvm.java.sql.DriverManager.getConnection(self.url, own)
        try:
            connection.setAutoCommit(False)
            out = work(connection)
            connection.commit()
            return out
        except BaseException:
            connection.rollback()
            raise
        finally:
            connection.close()

    def execute(self, *statements: str) -> list[int]:
        """The statements in one transaction; how many rows each has changed."""

        def work(connection) -> list[int]:
            out, statement = [], connection.createStatement()
            for sql in statements:
                out.append(statement.executeUpdate(sql))
            return out

        return self.transaction(work)

    def fields(self, table: str) -> list[Field]:
        """The columns of a table; none if it isn't there."""
        schema, _, name = table.rpartition(".")

        def work(connection) -> list[Field]:
            rows, out = connection.getMetaData().getColumns(None, schema or None, name, None), []
            while rows.next():
                length = rows.getInt("COLUMN_SIZE") if rows.getInt("DATA_TYPE") in _TEXTS else None
                out.append(Field(rows.getString("COLUMN_NAME"), rows.getInt("NULLABLE") != 0, length))
            return out

        return self.transaction(work)

    def ensure(self, table: str, types: Mapping[str, str], keys: Sequence[str]) -> bool:
        """Create a table with a unique key if it isn't there; whether it was created. types: column -> database type."""
        if self.fields(table):
            return False
        columns = ", ".join(f"{quoted(c)} {t}{' NOT NULL' if c in keys else ''}" for c, t in types.items())
        self.execute(f"CREATE TABLE {quoted(table)} ({columns}, UNIQUE ({', '.join(map(quoted, keys))}))")
        return True

    def read(self, table: str) -> DataFrame:
        return self.spark.read.jdbc(self.url, quoted(table), properties=self.properties)

    def count(self, table: str) -> int:
        return self.read(table).count()

    def overwrite(self, df: DataFrame, table: str, truncate: bool = True, batch: int = 5000) -> None:
        """All rows anew, keeping the table's definition and indexes if it is only truncated. Not in one transaction."""
        df.write.option("truncate", truncate).option("batchsize", batch).jdbc(self.url, quoted(table), mode="overwrite", properties=self.properties)

    def append(self, df: DataFrame, table: str, batch: int = 5000) -> None:
        df.write.option("batchsize", batch).jdbc(self.url, quoted(table), mode="append", properties=self.properties)

    def fitting(self, df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
        """The rows of df that the table can take, and the others with the `reason`: a null where it takes none, a text
        that is too long, or a number that isn't one."""
        known = {f.name: f for f in self.fields(table)}
        missing = [c for c in df.columns if c not in known]
        if missing:
            raise ValueError(f"{table} has no columns {missing}")
        reasons: list[Column] = []
        for name, kind in df.dtypes:
            own, column = known[name], F.col(f"`{name}`")
            if not own.nullable:
                reasons.append(F.when(column.isNull(), F.lit(f"{name} is null")))
            if own.length and kind == "string":
                reasons.append(F.when(F.length(column) > own.length, F.lit(f"{name} has more than {own.length} characters")))
            if kind in ("double", "float"):
                reasons.append(F.when(F.isnan(column) | (F.abs(column) == float("inf")), F.lit(f"{name} is not a number")))
        why = F.coalesce(*reasons, F.lit(None).cast("string")) if reasons else F.lit(None).cast("string")
        marked = df.withColumn("reason", why)
        return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")

    def upsert(self, df: DataFrame, table: str, keys: Sequence[str], gone: str | None = None, stream: tuple[str, int] | None = None, batch: int = 5000) -> DataFrame:
        """Rows of df replace those of their key or come anew, all in one transaction; the rows that don't fit the table.

        gone: a condition over the columns of df (as SQL of the database, `s.` before each) under which a row's key is
        deleted instead. stream: the name and the number of a micro-batch, kept in the table stream_batches in the same
        transaction; a batch that is in already is left out. A null key doesn't fit; a key twice among the rows that do is
        an error. The target must be there (see ensure).
        """
        good, bad = self.fitting(df, table)
        if stream and self.done(stream[0]) >= stream[1]:
            return bad
        good = good.persist()
        try:
            twice = good.groupBy(*keys).count().filter("count > 1")
            if not twice.isEmpty():
                raise ValueError(f"keys {list(keys)} are not unique")
            self._merge(good, good.count(), table, keys, gone, stream, batch)
        finally:
            good.unpersist()
        return bad

    def _merge(self, df: DataFrame, n: int, table: str, keys: Sequence[str], gone: str | None, stream: tuple[str, int] | None, batch: int) -> None:
        columns = df.columns
        rest = [c for c in columns if c not in keys]
        names = ", ".join(map(quoted, columns))
        on = " AND ".join(f"t.{quoted(k)} = s.{quoted(k)}" for k in keys)
        update = ", ".join(f"{quoted(c)} = s.{quoted(c)}" for c in rest)
        staging = f"{table}_stage_{uuid.uuid4().hex[:12]}"
        clauses = [f"WHEN MATCHED AND {gone} THEN DELETE"] if gone else []
        if rest:
            clauses.append(f"WHEN MATCHED{f' AND NOT ({gone})' if gone else ''} THEN UPDATE SET {update}")
        clauses.append(f"WHEN NOT MATCHED{f' AND NOT ({gone})' if gone else ''} THEN INSERT ({names}) VALUES ({', '.join(f's.{quoted(c)}' for c in columns)})")
        merge = f"MERGE INTO {quoted(table)} t USING {quoted(staging)} s ON {on} {' '.join(clauses)}"
        if stream:
            self.ensure("stream_batches", {"name": "VARCHAR(200)", "batch": "BIGINT"}, ["name"])

        def staged() -> None:
            """A task that was repeated may have left its rows twice: then all are staged again."""
            self.execute(f"DELETE FROM {quoted(staging)}")
            self.append(df, staging, batch)
            got = self.count(staging)
            if got != n:
                raise OSError(f"{n} rows were to be staged, {got} were")

        def merged() -> None:
            own = []
            if stream:
                text = stream[0].replace("'", "''")
                own = [f"DELETE FROM {quoted('stream_batches')} WHERE {quoted('name')} = '{text}'", f"INSERT INTO {quoted('stream_batches')} ({quoted('name')}, {quoted('batch')}) VALUES ('{text}', {stream[1]})"]
            self.execute(merge, *own)

        self.execute(f"CREATE TABLE {quoted(staging)} AS SELECT {names} FROM {quoted(table)} WITH NO DATA")
        try:
            retried(staged, again=passing)
            retried(merged, again=passing)
        finally:
            self.execute(f"DROP TABLE {quoted(staging)}")

    def done(self, stream: str) -> int:
        """The last micro-batch of a stream that is in; -1 if there is none."""
        if not self.fields("stream_batches"):
            return -1
        text = stream.replace("'", "''")

        def work(connection) -> int:
            rows = connection.createStatement().executeQuery(f"SELECT {quoted('batch')} FROM {quoted('stream_batches')} WHERE {quoted('name')} = '{text}'")
            return rows.getLong(1) if rows.next() else -1

        return self.transaction(work)


class Embedded(Database):
    """A Derby database within the driver's process, which executors can't reach: they write and read files of the folder
    that they share with the driver (a local one), which the database itself loads and unloads. Binary columns aren't
    supported. A read gives the table as it is at the call."""

    def _folder(self) -> str:
        shared = shared_folder(self.spark)
        path = shared.removeprefix("file://") if shared.startswith("file://") else shared.removeprefix("file:")
        if not path.startswith("/"):
            raise ValueError(f"an embedded database loads files of a local folder, not of {shared}")
        return f"{path}/derby/{uuid.uuid4().hex}"

    def _named(self, table: str) -> tuple[str, str]:
        """The schema, or NULL, and the name as literals of SQL."""
        schema, _, name = table.rpartition(".")
        literal = lambda x: "'" + x.replace("'", "''") + "'"
        return literal(schema) if schema else "NULL", literal(name)

    def count(self, table: str) -> int:
        def work(connection) -> int:
            rows = connection.createStatement().executeQuery(f"SELECT COUNT(*) FROM {quoted(table)}")
            rows.next()
            return rows.getLong(1)

        return self.transaction(work)

    def append(self, df: DataFrame, table: str, batch: int = 5000) -> None:
        at, own = self._folder(), set(df.columns)
        names = [f.name for f in self.fields(table)]
        if own - set(names):
            raise ValueError(f"{table} has no columns {sorted(own - set(names))}")
        kinds = dict(df.dtypes)

        def field(name: str) -> Column:
            """Texts in quotes, so that blanks at their ends stay and an empty one isn't a null, which has no characters."""
            if name not in own:
                return F.lit("")
            text = F.col(f"`{name}`").cast("string")
            return F.coalesce(F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"')) if kinds[name] == "string" else text, F.lit(""))

        df.select(F.concat_ws(",", *[field(n) for n in names]).alias("value")).write.text(f"file://{at}")
        schema, name = self._named(table)
        files = [f for f in sorted(glob.glob(f"{at}/part-*")) if os.path.getsize(f)]
        for f in files:
            self.transaction(lambda c, f=f: c.createStatement().execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE({schema}, {name}, '{f}', ',', '\"', 'UTF-8', 0)"))

    def overwrite(self, df: DataFrame, table: str, truncate: bool = True, batch: int = 5000) -> None:
        """All rows anew in the table as it is defined, which must be there."""
        self.execute(f"DELETE FROM {quoted(table)}")
        self.append(df, table)

    def read(self, table: str) -> DataFrame:
        at = self._folder()
        os.makedirs(at)
        select = f"SELECT * FROM {quoted(table)}".replace("'", "''")
        self.transaction(lambda c: c.createStatement().execute(f"CALL SYSCS_UTIL.SYSCS_EXPORT_QUERY('{select}', '{at}/rows.csv', ',', '\"', 'UTF-8')"))
        schema = super().read(table).schema
        # with a mark for nulls of its own, a quoted empty text isn't one
        return self.spark.read.schema(schema).options(quote='"', escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS][.S]", multiLine="true", nullValue="\x01").csv(f"file://{at}/rows.csv")

"""Sessions and the folder that a cluster shares."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager
from typing import Any

from pyspark.sql import SparkSession

#: The store that keeps state with several columns of its own, as processors by key need; and its setting.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Whether a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "tideframe", **conf: str) -> SparkSession:
    """A session in UTC with adaptive plans, ANSI semantics and RocksDB for streaming state; conf wins."""
    builder = SparkSession.builder.appName(app)
    own = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        STATE_STORE: ROCKS_DB,
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    }
    for key, value in (own | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def _held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def state_by_key(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, queries that start keep their state in RocksDB, whatever the session says: a query takes the settings as
    they are when it starts, and a checkpoint keeps them."""
    return _held(spark, STATE_STORE, ROCKS_DB)


def shuffles_go(spark: SparkSession) -> AbstractContextManager[None]:
    """Within it, the shuffle files of a query go when it ends. For results that are stored: what reads a DataFrame again
    that has run within it, would shuffle anew."""
    return _held(spark, FILES_GO, "true")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see (spark.checkpoint.dir). Set here only in a session of one process without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tideframe-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settings(spark: SparkSession, kinds: Mapping[str, tuple[type, Any]], prefix: str = "spark.tideframe.") -> dict[str, Any]:
    """The session's settings under a prefix, each of its type: name -> (int, float, bool, str or list, default). A setting
    whose default is the type's own class, not a value, must be there."""
    out: dict[str, Any] = {}
    for name, (kind, default) in kinds.items():
        text = spark.conf.get(prefix + name, None)
        if text is None or not text.strip():
            if default is kind:
                raise ValueError(f"{prefix}{name} must be set")
            out[name] = default
        elif kind is bool:
            if text.strip().lower() not in ("true", "false"):
                raise ValueError(f"{prefix}{name} must be true or false, not {text}")
            out[name] = text.strip().lower() == "true"
        elif kind is list:
            out[name] = [x.strip() for x in text.split(",") if x.strip()]
        else:
            try:
                out[name] = kind(text.strip())
            except ValueError as e:
                raise ValueError(f"{prefix}{name} must be of type {kind.__name__}, not {text}") from e
    return out

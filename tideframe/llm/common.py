"""What the operators of this subpackage share: written tables, packed columns, words and rolling hashes."""

from __future__ import annotations

import ctypes
import gc
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideframe.session import shared_folder, shuffles_go

#: Bytes that part words: space and U+0009 to U+000D, which is what bytes.split() takes.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tideframe"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, which cuts its lineage; its shuffle files go at once."""
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    with shuffles_go(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that written() has made and that nothing will read any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession, hours: float) -> int:
    """Delete the tables of written() that are older than so many hours; how many there were. For the time between jobs:
    results that haven't been read or stored yet need their tables."""
    top = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(top) if s.getModificationTime() < (time.time() - 3600 * hours) * 1000] if fs.exists(top) else []
    for path in found:
        fs.delete(path, True)
    return len(found)


def quoted(name: str) -> Column:
    """A column by its name, whatever characters that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return memory that is free to the system: workers stay for later stages, and executors bear several."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


def frugal(f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """f for mapInArrow, which gives its memory back at the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def pack(data: bytes, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack_ints(a: np.ndarray) -> bytes:
    """Small numbers from 0, byte planes apart, which compresses them well."""
    return pack(np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(unpack(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def pack_strings(words: list[bytes]) -> bytes:
    return pack(np.array([len(words), *map(len, words)], "<u4").tobytes() + b"".join(words))


def unpack_strings(data: bytes) -> list[bytes]:
    raw = unpack(data)
    n = int.from_bytes(raw[:4], "little")
    at = 4 + 4 * n + np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", n, 4))]).astype(np.int64)
    ends = at.tolist()
    return [raw[s:e] for s, e in zip(ends, ends[1:])]


def ragged(flat: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """flat[start[i] : start[i] + length[i]] for each i, end to end."""
    ends = np.cumsum(length)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    return flat[np.arange(ends[-1]) + np.repeat(start - ends + length, length)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


#: An odd base; its powers and a random number for each byte make hashes of byte ranges from prefix sums.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(20240229).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_UP = _DOWN = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, for i below n."""
    global _UP, _DOWN
    if len(_UP) < n:
        m = 1 << n.bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        one = np.ones(1, np.uint64)
        _UP = np.concatenate([one, np.cumprod(np.full(m - 1, _BASE))])
        _DOWN = np.concatenate([one, np.cumprod(np.full(m - 1, inverse))])
    return _UP[:n], _DOWN[:n]


class Rolling:
    """64-bit hashes of any ranges of one byte string; equal ranges have equal hashes wherever they stand."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, np.uint8)
        up, self.down = _powers(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """The least of each w numbers in a row; len(a) - w + 1 of them."""
    out, have = a, 1
    while have < w:
        step = min(have, w - have)
        out, have = np.minimum(out[: len(out) - step], out[step:]), have + step
    return out


def sliding_max(a: np.ndarray, w: int) -> np.ndarray:
    out, have = a, 1
    while have < w:
        step = min(have, w - have)
        out, have = np.maximum(out[: len(out) - step], out[step:]), have + step
    return out


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]

"""Windows of a fixed number of units (bytes or words) that stand in more than one place of a corpus.

Each window has an anchor: the least hash of its short grams. Equal windows have equal anchors, so only texts around
anchors that recur are ever compared. The stretch of consecutive windows of one anchor is a context; contexts travel to
where all others of their anchor are, and are compared there. What is shuffled of the whole corpus is one anchor in
about half a window of text, the texts themselves once, and the contexts of what recurs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideframe.llm.common import Rolling, frugal, pack, partitions, quoted, sliding_max, sliding_min, unpack, written

#: An anchor of more occurrences than this is resolved window by window in Spark's own aggregation: at this number one
#: task holds at most so many contexts, a few MB of text if all of them differ, and a few numbers for each copy.
HOT = 20_000
#: Tasks that share the rows of one hot window.
SALTS = 32
#: Windows of one document that leave a task at once.
STEP = 50_000
#: Bytes of contexts that are compared at once, if they are of several anchors.
BATCH = 1_000_000

Units = Callable[[bytes], tuple[bytes, np.ndarray, np.ndarray]]


def byte_units(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    at = np.arange(len(text) + 1)
    return text, at[:-1], at[1:]


def word_units(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words joined by one space, and where each starts and ends there."""
    data = b" ".join(text.split())
    if not data:
        return data, np.zeros(0, np.int64), np.zeros(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    return data, np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(data)]])


class Context:
    """A stretch of n windows of one anchor, and where it stands: document, hash of its text, first window."""

    __slots__ = ("anchor", "n", "data", "places")

    def __init__(self, anchor: int, n: int, data: bytes):
        self.anchor, self.n, self.data = anchor, n, data
        self.places: list[tuple[int | None, int, int]] = []


class Windows:
    """Hashes of the grams of a text and the anchor of each of its windows."""

    def __init__(self, text: bytes, units: Units, width: int, gram: int):
        self.data, self.starts, self.ends = units(text)
        self.n, self.width, self.gram = len(self.starts), width, gram
        self.count = max(0, self.n - width + 1)
        if self.count:
            self.rolling = Rolling(self.data)
            self.grams = self.hashes(0, self.n - gram + 1, gram)
            self.anchors = sliding_min(self.grams, width - gram + 1)

    def hashes(self, lo: int, hi: int, units: int) -> np.ndarray:
        """Of the stretches of so many units that start at lo, lo + 1, ..., hi - 1."""
        return self.rolling.of(self.starts[lo:hi], self.ends[lo + units - 1 : hi + units - 1])

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct anchors, and how many grams that are the anchor of a window have that hash."""
        w = self.width - self.gram + 1
        edge = np.zeros(w - 1, np.uint64)
        best = sliding_max(np.concatenate([edge, self.anchors, edge]), w)
        return np.unique(self.grams[best == self.grams], return_counts=True)

    def contexts(self, anchors: np.ndarray) -> Iterator[tuple[int, int]]:
        """First and last window, exclusive, of each stretch of windows with the same one of these anchors."""
        inside = np.isin(self.anchors, anchors)
        change = np.flatnonzero(np.diff(self.anchors)) + 1
        bounds = np.concatenate([[0], change, [self.count]])
        own = inside[bounds[:-1]]
        return zip(bounds[:-1][own].tolist(), bounds[1:][own].tolist())

    def bytes_of(self, lo: int, hi: int) -> bytes:
        """The text of the windows lo to hi - 1."""
        return self.data[self.starts[lo] : self.ends[hi + self.width - 2]]


def signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def keyed(df: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """doc_id, h (a hash of the text) and data (its bytes): rows that agree in both are alike in all that follows.

    carry names columns to take along, as fields of the struct `carry`.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    extra = [F.struct(*[quoted(c) for c in carry]).alias("carry")] if carry else []
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("data"), *extra)


def mapped(f: Callable[[dict], Iterator[tuple]], schema: pa.Schema, rows: int = 20_000):
    """A function for mapInArrow that gives the rows of f for each row of the input."""

    def flush(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[] for _ in schema]
        return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            names = batch.schema.names
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                out.extend(f(dict(zip(names, row))))
                if len(out) >= rows:
                    yield flush(out)
                    out = []
        yield flush(out)

    return frugal(run)


def recurring(docs: DataFrame, units: Units, width: int, gram: int, condition: Column) -> DataFrame:
    """doc_id, h, anchor, total: the anchors of each document whose totals over the corpus meet the condition.

    The condition may use total (occurrences), low and high (least and greatest doc_id; a null id counts as greatest).
    """

    def anchors(row: dict) -> Iterator[tuple]:
        w = Windows(row["data"], units, width, gram)
        if w.count:
            found, times = w.places()
            for a, n in zip(signed(found).tolist(), times.tolist()):
                yield a, n, row["doc_id"], row["h"]

    schema = pa.schema([("anchor", pa.int64()), ("n", pa.int32()), ("doc_id", pa.int64()), ("h", pa.int64())])
    places = written(docs.select("doc_id", "h", "data").mapInArrow(mapped(anchors, schema), "anchor long, n int, doc_id long, h long"))
    last = F.coalesce("doc_id", F.lit(2**63 - 1))
    totals = places.groupBy("anchor").agg(F.sum("n").alias("total"), F.min(last).alias("low"), F.max(last).alias("high")).filter(condition)
    return written(places.select("anchor", "doc_id", "h").join(totals.select("anchor", "total"), "anchor"))


def compare(
    docs: DataFrame, found: DataFrame, units: Units, width: int, gram: int,
    batch: Callable[[list[Context]], Iterator[tuple]], verdict: Callable[[DataFrame], DataFrame], out: str, out_schema: pa.Schema,
) -> tuple[DataFrame, DataFrame]:
    """The documents parted by their key, with `data` packed, and what was found in them: doc_id, h, spot (an array of structs `out`).

    batch gets all distinct contexts of each anchor in it, and gives rows of out_schema (doc_id, h and the fields of `out`). verdict gets one row for each window of hot anchors (a, b: a hash
    of 128 bits; doc_id, h, start) and gives those of them that count; neighbours among them are one spot.
    """
    spark = docs.sparkSession
    n = max(partitions(spark), 8)
    # packed, as all texts cross here
    texts = docs.mapInArrow(_packed, docs.schema).repartition(n, "doc_id", "h")  # one exchange, read for the contexts and again for the result
    schema = pa.schema([("anchor", pa.int64()), ("ctx", pa.int64()), ("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("data", pa.binary())])

    def contexts(row: dict) -> Iterator[tuple]:
        w = Windows(unpack(row["data"]), units, width, gram)
        for lo, hi in w.contexts(np.array(row["anchors"], np.int64).view(np.uint64)):
            data = w.bytes_of(lo, hi)
            ctx = w.hashes(lo, lo + 1, hi - lo + width - 1)
            yield int(w.anchors[lo : lo + 1].view(np.int64)[0]), int(ctx.view(np.int64)[0]), row["doc_id"], row["h"], lo, hi - lo, data

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for row in zip(*(table.column(c).to_pylist() for c in ("doc_id", "h", "data", "anchors"))):
                w = Windows(unpack(row[2]), units, width, gram)
                for low, high in w.contexts(np.array(row[3], np.int64).view(np.uint64)):
                    for lo in range(low, high, STEP):
                        n = min(STEP, high - lo)
                        keys = [pa.array(signed(w.hashes(lo, lo + n, k))) for k in (width, width // 2)]
                        same = [pa.array([x] * n, pa.int64()) for x in row[:2]]
                        yield pa.RecordBatch.from_arrays([*keys, *same, pa.array(np.arange(lo, lo + n, dtype=np.int32))], names=["a", "b", "doc_id", "h", "start"])

    def with_anchors(which: Column) -> DataFrame:
        own = found.filter(which).groupBy("doc_id", "h").agg(F.collect_set("anchor").alias("anchors"))
        return texts.join(own.withColumnsRenamed({"doc_id": "_d", "h": "_h"}), F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h"))).drop("_d", "_h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Context] = []
        size, last = 0, None
        for table in batches:
            columns = [table.column(c).to_pylist() for c in ("anchor", "ctx", "doc_id", "h", "start", "n")]
            data = table.column("data")
            for i, (anchor, ctx, doc, h, start, n) in enumerate(zip(*columns)):
                if (anchor, ctx) != last:
                    if size >= BATCH and anchor != last[0]:
                        yield _batch(batch(held), out_schema)
                        held, size = [], 0
                    held.append(Context(anchor, n, data[i].as_py()))
                    size += len(held[-1].data)
                    last = anchor, ctx
                held[-1].places.append((doc, h, start))
        if held:
            yield _batch(batch(held), out_schema)

    calm = with_anchors(F.col("total") <= HOT).mapInArrow(mapped(contexts, schema, 5000), "anchor long, ctx long, doc_id long, h long, start int, n int, data binary")
    spots = calm.repartition(n, "anchor").sortWithinPartitions("anchor", "ctx").mapInArrow(frugal(run), f"doc_id long, h long, {out}")
    if not found.filter(F.col("total") > HOT).isEmpty():
        hot = with_anchors(F.col("total") > HOT).mapInArrow(frugal(windows), "a long, b long, doc_id long, h long, start int")
        spots = spots.unionByName(_joined_up(verdict(hot), width, n))
    fields = [c for c in spots.columns if c not in ("doc_id", "h")]
    return texts, spots.groupBy("doc_id", "h").agg(F.collect_set(F.struct(*fields)).alias("spots"))


def _joined_up(windows: DataFrame, width: int, parts: int) -> DataFrame:
    """doc_id, h, start, n: windows (doc_id, h, start) as runs, put together where one reaches the next, so that a document
    has at most one for each `width` units. A document's windows stream by in order; none are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # document, hash, first and last start of the run at hand
        for table in batches:
            if not table.num_rows:
                continue
            doc, h = table.column("doc_id"), table.column("h").to_numpy()
            none = doc.is_null().to_numpy(zero_copy_only=False)
            key, start = doc.fill_null(0).to_numpy(), table.column("start").to_numpy().astype(np.int64)
            new = np.ones(len(start), bool)
            new[1:] = (key[1:] != key[:-1]) | (none[1:] != none[:-1]) | (h[1:] != h[:-1]) | (start[1:] > start[:-1] + width)
            first = np.flatnonzero(new)
            rows = [[None if none[i] else int(key[i]), int(h[i]), int(start[i]), int(start[j - 1])] for i, j in zip(first.tolist(), [*first[1:].tolist(), len(start)])]
            if last and last[:2] == rows[0][:2] and rows[0][2] <= last[3] + width:
                rows[0][2] = last[2]
            elif last:
                rows.insert(0, last)
            last = rows.pop()
            yield _batch(((d, x, a, b - a + 1) for d, x, a, b in rows), _RUN)
        if last:
            yield _batch(iter([(*last[:3], last[3] - last[2] + 1)]), _RUN)

    rows = windows.select("doc_id", "h", "start").repartition(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "start")
    return rows.mapInArrow(frugal(run), "doc_id long, h long, start int, n int")


_RUN = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("data")
        yield batch.set_column(at, "data", pa.array([pack(x.as_py(), 1) for x in batch.column(at)], pa.binary()))


def _batch(rows: Iterator[tuple], schema: pa.Schema) -> pa.RecordBatch:
    rows = list(rows)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, x.type) for c, x in zip(columns, schema)], schema=schema)


def known(windows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """windows joined with a verdict for each (a, b). Copies of the verdicts, dealt out by document, share a window's rows
    among tasks, as one window may hold a great part of them."""
    salted = verdicts.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    return windows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "h", "start"), F.lit(SALTS)).cast("int")).join(salted, ["a", "b", "_salt"]).drop("_salt")


def joined(texts: DataFrame, spots: DataFrame) -> DataFrame:
    """All documents with their spots, null if they have none."""
    right = spots.withColumnsRenamed({"doc_id": "_d", "h": "_h"})
    return texts.join(right, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left").drop("_d", "_h")


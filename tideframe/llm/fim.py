"""Fill-in-the-middle: texts cut in three and put together in another order, by a sparse index of checkpoints.

A text is read once, in pieces, to count its units; every so many units the count's unit, byte and code point are noted.
A cut looks up the last checkpoint before it and reads on from there, which is never more than one stride. Texts stay the
UTF-8 bytes that Spark hands over; nothing is decoded, and no index has an entry for each unit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tideframe.llm.common import frugal

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
_MARKS = re.compile(rb"<[PSM]>")
#: Units between two checkpoints, bytes that are counted at a time, and bytes of a batch of results.
STRIDE, PIECE, BATCH = 1024, 1 << 20, 32 << 20
#: Of 100 texts so many stay plain; of 100 others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _points(data: np.ndarray, before: int | None) -> np.ndarray:
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray, before: int | None) -> np.ndarray:
    word = ~_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    start[0] = before is None or (word[0] and _SPACE[before])  # what stands before the first word is a unit too
    return start


def _lines(data: np.ndarray, before: int | None) -> np.ndarray:
    start = np.empty(len(data), bool)
    start[1:] = data[:-1] == 0x0A
    start[0] = before is None or before == 0x0A
    return start


#: Where units start in a piece of a text, given the byte before the piece (None for the text's first one). A unit
#: reaches to the next one's start, so units joined are the text.
UNITS: dict[str, Callable[[np.ndarray, int | None], np.ndarray]] = {"char": _points, "word": _words, "line": _lines}


class Checkpoints:
    """How many units and code points a text has, and where every STRIDE-th unit starts."""

    def __init__(self, data: np.ndarray, unit: str = "char", stride: int = STRIDE, piece: int = PIECE):
        self.data, self.starts, self.stride = data, UNITS[unit], stride
        self.units = self.points = 0
        byte, point = [], []
        for low in range(0, len(data), piece):
            own = data[low : low + piece]
            at = self._starts(low, low + len(own))
            picked = at[-self.units % stride :: stride]
            byte.append(picked)
            points = (own & 0xC0) != 0x80
            if self.starts is _points:
                point.append(self.units + np.arange(-self.units % stride, len(at), stride))
            else:
                point.append(self.points + np.searchsorted(np.flatnonzero(points), picked - low))
            self.units += len(at)
            self.points += int(points.sum())
        self.byte = np.concatenate([*byte, [len(data)]]).astype(np.int64)
        self.point = np.concatenate([*point, [self.points]]).astype(np.int64)
        self.unit = np.append(np.arange(len(self.byte) - 1, dtype=np.int64) * stride, self.units)

    def _starts(self, low: int, high: int) -> np.ndarray:
        """Bytes from low to high at which units start."""
        first = low == 0
        return low + np.flatnonzero(self.starts(self.data[low:high], None if first else int(self.data[low - 1])))

    def cut(self, unit: int) -> tuple[int, int]:
        """The byte and the code point at which a unit starts; the text's end for the number of all units."""
        if unit >= self.units:
            return len(self.data), self.points
        k = int(np.searchsorted(self.unit[:-1], unit, side="right")) - 1
        low, ahead = int(self.byte[k]), unit - int(self.unit[k])
        byte = int(self._starts(low, int(self.byte[k + 1]))[ahead]) if ahead else low
        point = unit if self.starts is _points else int(self.point[k]) + int(((self.data[low:byte] & 0xC0) != 0x80).sum())
        return byte, point


def _numbers(seed: int, id_col: str) -> list[Column]:
    """Four numbers of a document, from the digest of the seed and its id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def arranged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "char", stride: int = STRIDE, seed: int = 1, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points; null if plain) and output of every row of docs.

    Cuts and form follow from the seed and the id alone. A text without units or with one of the marks stays plain, and so
    do `plain` of 100 others; of the rest `suffix_first` of 100 have the form spm, the others psm. A null text counts as
    empty; a null id as an empty one; repeated rows come out alike; a text of any length is cut whole and only counted in
    pieces; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.array(*_numbers(seed, id_col)).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, form, first, second, out, size, low = batch.column(0), [], [], [], [], [], 0, 0

            def ready(high: int) -> pa.RecordBatch:
                columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(out, pa.binary()).view(pa.string())]
                return pa.RecordBatch.from_arrays([ids.slice(low, high - low), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

            for i, h in enumerate(batch.column(2).to_pylist()):
                raw = batch.column(1)[i].as_buffer()
                data = np.frombuffer(raw, np.uint8)
                points = Checkpoints(data, unit, stride)
                n.append(points.units)
                if not points.units or h[2] % 100 >= 100 - plain or _MARKS.search(raw):
                    kind, a, b, text = "plain", None, None, raw.to_pybytes()
                else:
                    low_cut, high_cut = sorted(x % (points.units + 1) for x in h[:2])
                    (s, a), (e, b) = points.cut(low_cut), points.cut(high_cut)
                    view, b = memoryview(raw), b - a
                    if h[3] % 100 < suffix_first:
                        kind, text = "spm", b"".join([SUFFIX, view[e:], PREFIX, view[:s], MIDDLE, view[s:e]])
                    else:
                        kind, text = "psm", b"".join([PREFIX, view[:s], SUFFIX, view[e:], MIDDLE, view[s:e]])
                form.append(kind)
                first.append(a)
                second.append(b)
                out.append(text)
                size += len(text)
                if size >= BATCH:
                    yield ready(i + 1)
                    n, form, first, second, out, size, low = [], [], [], [], [], 0, i + 1
            if n:
                yield ready(len(ids))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(frugal(run), f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. Marks can't overlap and stand once each where the form isn't plain."""

    def between(left: str, right: str | None) -> Column:
        """What stands behind one mark and before another, or up to the end."""
        rest = F.split_part(output, F.lit(left), F.lit(2))
        return rest if right is None else F.split_part(rest, F.lit(right), F.lit(1))

    psm = F.concat(between("<P>", "<S>"), between("<M>", None), between("<S>", "<M>"))
    spm = F.concat(between("<P>", "<M>"), between("<M>", None), between("<S>", "<P>"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """Of every text: its units, form and parts, and the digests of the output and of the text rebuilt from it."""
    out = arranged(docs)
    text = restored(F.col("output"), F.col("form"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"), F.sha2(text.cast("binary"), 256).alias("restored_sha256"))


#: The same rows in DuckDB.
ORACLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d FROM documents),
h AS (SELECT *, length(text) AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2, ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4 FROM t),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""

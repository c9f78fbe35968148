"""Suffix-array deduplication of bytes.

Texts around recurring anchors (see repeats) are suffix-sorted in two stages: only suffixes smaller than their
successors are sorted directly; a scan over the buckets of first bytes in ascending order then puts every other suffix
in its place, as it follows from the place of its successor. The common prefixes of neighbours in the array are then
computed from the bytes; those that reach the width are repeats. Sorting goes as deep as the prefix that counts, and of
the suffixes that are too short to be a window only those are sorted that a window's place follows from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tideframe.llm.common import Rolling, runs, unpack
from tideframe.llm.repeats import Context, byte_units, compare, joined, keyed, known, mapped, recurring

WIDTH, GRAM = 200, 40


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one; the last one is not (the empty suffix is the least)."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int16) - t[:-1])
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def words_at(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, zeros after the end; numbers are in the order of the bytes."""
    padded = np.concatenate([t, np.zeros(8, np.uint8)])
    return np.ndarray(len(t) + 1, ">u8", padded, 0, (1,))


def sort_directly(words: np.ndarray, spots: np.ndarray, depth: int, same: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The suffixes at spots in order of their first `depth` bytes. same: a hash of so many bytes; groups that agree in it
    need no more order."""
    last = len(words) - 1
    first = words[spots].astype(np.uint64)
    order = np.argsort(first)
    spots, first = spots[order], first[order]
    starts = np.concatenate([[True], first[1:] != first[:-1]]) if len(spots) else np.zeros(0, bool)
    at = np.flatnonzero(~(starts & np.append(starts[1:], True)))  # members of groups of several
    own = spots[at]
    group = np.cumsum(starts)[at]
    marks = same(own)
    for deep in range(8, depth, 8):
        if not len(at):
            break
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        sizes = np.diff(np.append(heads, len(at)))
        mixed = np.repeat(np.minimum.reduceat(marks, heads) != np.maximum.reduceat(marks, heads), sizes)
        at, own, group, marks = at[mixed], own[mixed], group[mixed], marks[mixed]
        if not len(at):
            break
        keys = words[np.minimum(own + deep, last)].astype(np.uint64)
        apart = np.concatenate([[True], group[1:] != group[:-1]])
        if ((keys[1:] != keys[:-1]) & ~apart[1:]).any():
            order = np.lexsort((keys, group))
            own, keys, marks = own[order], keys[order], marks[order]
            spots[at] = own
            apart[1:] |= keys[1:] != keys[:-1]
            alone = apart & np.append(apart[1:], True)
            group = np.cumsum(apart)[~alone]
            at, own, marks = at[~alone], own[~alone], marks[~alone]
    return spots


def suffix_array(t: np.ndarray, depth: int, same: Callable[[np.ndarray], np.ndarray], ascending: np.ndarray, member: np.ndarray) -> np.ndarray:
    """The suffixes of t (bytes) that are members, in order of their first `depth` bytes at least.

    ascending: smaller than their successor. The successor of a member that is not ascending is a member as well.
    """
    spots = np.flatnonzero(member)
    chars, direct = t[spots], ascending[spots]
    direct = sort_directly(words_at(t), spots[direct], depth, same)
    sizes = np.bincount(chars, minlength=256)
    n_direct = np.bincount(t[direct], minlength=256)
    begin = np.cumsum(sizes) - sizes
    out = np.full(len(spots), -1, np.int32)
    direct_begin = np.cumsum(n_direct) - n_direct
    for c in np.flatnonzero(n_direct).tolist():
        end = begin[c] + sizes[c]
        out[end - n_direct[c] : end] = direct[direct_begin[c] : direct_begin[c] + n_direct[c]]
    filled = begin.copy()
    induced = member & ~ascending

    def place(c: int, spots: np.ndarray) -> None:
        out[filled[c] : filled[c] + len(spots)] = spots
        filled[c] += len(spots)

    for c in np.flatnonzero(sizes).tolist():
        done = begin[c]
        while done < filled[c]:  # suffixes that begin with a run of c induce one another
            before = out[done : filled[c]] - 1
            done = filled[c]
            before = before[before >= 0]
            place(c, before[(t[before] == c) & induced[before]])
        before = out[begin[c] : begin[c] + sizes[c]] - 1
        before = before[before >= 0]
        before = before[(t[before] > c) & induced[before]]
        if len(before):
            chars = t[before]
            order = np.argsort(chars, kind="stable")
            before, chars = before[order], chars[order]
            heads = np.flatnonzero(np.concatenate([[True], chars[1:] != chars[:-1]]))
            for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), len(chars)]):
                place(int(chars[lo]), before[lo:hi])
    return out


def common_prefixes(t: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """How many leading bytes each suffix in the order has in common with the one before it, `most` at most; 0 for the first."""
    words = np.ndarray(len(t) + 1, "<u8", np.concatenate([t, np.zeros(8, np.uint8)]), 0, (1,))
    out = np.zeros(len(order), np.int32)
    at = np.arange(1, len(order))
    for deep in range(0, most, 8):
        a, b = order[at] + deep, order[at - 1] + deep
        inside = np.maximum(a, b) < len(t)
        at, a, b = at[inside], a[inside], b[inside]
        differ = (words[a] ^ words[b]).astype(np.uint64)
        low = differ & (~differ + np.uint64(1))  # its lowest bit, in the first byte that differs
        equal = np.where(differ == 0, 8, np.searchsorted(_BYTE_BITS, low, "right") - 1)
        out[at] += equal.astype(np.int32)
        at = at[differ == 0]
    return np.minimum(out, most)


_BYTE_BITS = np.uint64(1) << (np.arange(8, dtype=np.uint64) * np.uint64(8))


def repeated_starts(texts: list[bytes], width: int) -> list[np.ndarray]:
    """For each text, which of its windows of `width` bytes start elsewhere too, in it or in another."""
    raw = b"\0".join(texts) + b"\0\1"  # each text's end is smaller than what follows it
    t = np.frombuffer(raw, np.uint8)
    sizes = np.array([*map(len, texts)], np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    counts = np.maximum(sizes - width + 1, 0)
    ascending = smaller_than_next(t)
    # what is sorted of a text: its windows, and what follows up to the next suffix smaller than its successor
    at = np.flatnonzero(ascending)
    ends = np.where(counts > 0, at[np.searchsorted(at, begin + np.maximum(counts, 1) - 1)] + 1, begin)
    edges = np.zeros(len(t) + 1, np.int8)
    np.add.at(edges, begin, 1)
    np.add.at(edges, ends, -1)
    member = np.cumsum(edges[:-1], dtype=np.int8) > 0
    rolling = Rolling(raw)
    order = suffix_array(t, width, lambda x: rolling.of(x, np.minimum(x + width, len(t))), ascending, member)
    edges[:] = 0
    np.add.at(edges, begin, counts > 0)
    np.add.at(edges, begin + counts, -(counts > 0).astype(np.int8))
    order = order[(np.cumsum(edges[:-1], dtype=np.int8) > 0)[order]]
    shared = np.flatnonzero(common_prefixes(t, order, width) >= width)
    flags = np.zeros(len(t), bool)
    flags[order[shared]] = True
    flags[order[shared - 1]] = True
    return [flags[b : b + n] for b, n in zip(begin.tolist(), counts.tolist())]


def _compare_contexts(contexts: list[Context]) -> Iterator[tuple]:
    """Runs of repeated windows of every context. If none of an anchor's contexts stands alone, all their windows repeat."""
    unsure = {c.anchor for c in contexts if len(c.places) == 1}
    own = [i for i, c in enumerate(contexts) if c.anchor in unsure]
    flags = dict(zip(own, repeated_starts([contexts[i].data for i in own], WIDTH))) if own else {}
    for i, c in enumerate(contexts):
        spans = [(0, c.n)] if len(c.places) > 1 else [(int(a), int(b - a)) for a, b in zip(*runs(flags[i]))]
        for doc, h, start in c.places:
            for at, n in spans:
                yield doc, h, start + at, n


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """doc_id, h, n_bytes, n_removed, n_spans, kept binary: each text without the bytes that a window of 200 bytes covers
    which also starts elsewhere in the corpus, overlaps and the same document included.

    A null text counts as empty; rows of one id or none are documents of their own; repeated rows remove one another; a
    text of fewer than 200 bytes stays whole, one of any length is compared whole, in contexts of at most 360 bytes. An
    empty df gives no rows; of other columns of df those of `carry` come along, as a struct of that name.
    """
    docs = keyed(df, id_col, text_col, carry)
    found = recurring(docs, byte_units, WIDTH, GRAM, F.col("total") >= 2)

    def hot(windows: DataFrame) -> DataFrame:
        times = windows.groupBy("a", "b").agg(F.count(F.lit(1)).alias("times")).filter("times >= 2")
        return known(windows, times).select("doc_id", "h", "start")

    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
    texts, spots = compare(docs, found, byte_units, WIDTH, GRAM, _compare_contexts, hot, "start int, n int", schema)

    def cut(row: dict) -> Iterator[tuple]:
        data, extra = unpack(row["data"]), (row["carry"],) if carry else ()
        if not row["spots"]:
            yield row["doc_id"], row["h"], len(data), 0, 0, data, *extra
            return
        gone = np.zeros(len(data), bool)
        for spot in row["spots"]:
            gone[spot["start"] : spot["start"] + spot["n"] + WIDTH - 1] = True
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        yield row["doc_id"], row["h"], len(data), int(gone.sum()), len(runs(gone)[0]), kept, *extra

    out = StructType.fromDDL("doc_id long, h long, n_bytes long, n_removed long, n_spans long, kept binary")
    for field in docs.schema.fields[3:]:
        out = out.add(field)
    return joined(texts, spots).mapInArrow(mapped(cut, to_arrow_schema(out), 2000), out)


def digests(df: DataFrame) -> DataFrame:
    return remove_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

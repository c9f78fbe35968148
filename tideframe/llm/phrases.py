"""Substring deduplication by repeated-phrase automata.

Windows of 50 words around recurring anchors (see repeats) are confirmed where all of an anchor's contexts meet: those
that stand in two documents or more. Confirmed windows that always stand next to each other form a passage, which is
taken once. Aho-Corasick automata are compiled from the passages, in shards of bounded size, and what documents have
around the anchors of a shard, that is wherever its passages can be, streams through its automaton. The automaton's hits
say where passages stand; an occurrence in a later document than the passage's first one is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tideframe.llm.common import Rolling, unpack
from tideframe.llm.repeats import Context, compare, joined, keyed, known, mapped, recurring, word_units

WIDTH, GRAM = 50, 10
#: Bytes of passages that one automaton holds, more only for a single passage.
SHARD = 500_000
_LAST = 2**63 - 1


def _rank(doc: int | None) -> int:
    """Null ids are the greatest."""
    return _LAST if doc is None else doc


def confirmed(texts: list[bytes], least: list[int], greatest: list[int], width: int) -> dict[bytes, int]:
    """The passages of the texts and the least document that holds each.

    A window of `width` words is part of a passage if its texts are of two documents or more; least and greatest have
    those of each text. Windows are in one passage if neither ever stands without the other next to it, so that a
    document holds all of a passage or nothing.
    """
    whole, starts, ends = word_units(b" ".join(texts))
    sizes = np.array([t.count(b" ") + 1 for t in texts], np.int64)
    counts = np.maximum(sizes - width + 1, 0)
    begin = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(texts)), counts)
    if not len(of):
        return {}
    at = np.repeat(begin - np.cumsum(counts) + counts, counts) + np.arange(len(of))
    keys = Rolling(whole).of(starts[at], ends[at + width - 1])
    _, first, which, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    low, high = np.full(len(first), _LAST, np.int64), np.full(len(first), -_LAST - 1, np.int64)
    np.minimum.at(low, which, np.array(least, np.int64)[of])
    np.maximum.at(high, which, np.array(greatest, np.int64)[of])
    next_to = of[1:] == of[:-1]  # of the window at hand and the one after it
    one, two = which[:-1], which[1:]
    _, back, number = np.unique((one[next_to] << 32) + two[next_to], return_inverse=True, return_counts=True)
    bound = np.zeros(len(of), bool)
    bound[:-1][next_to] = (number[back] == times[one[next_to]]) & (number[back] == times[two[next_to]])
    taken = (first[which] == np.arange(len(of))) & (low < high)[which]
    out: dict[bytes, int] = {}
    starts_at = np.flatnonzero(taken & ~np.concatenate([[False], taken[:-1] & bound[:-1]]))
    ends_at = np.flatnonzero(taken & ~(bound & np.append(taken[1:], False)))
    for lo, hi in zip(starts_at.tolist(), ends_at.tolist()):
        out[whole[starts[at[lo]] : ends[at[hi] + width - 1]]] = int(low[which[lo]])
    return out


def automata(passages: dict[bytes, int], size: int) -> Iterator[ahocorasick.Automaton]:
    """Automata of `size` bytes of passages each, which find all of them; a value is a passage's length and first holder."""
    out, held = ahocorasick.Automaton(), 0
    for passage, holder in passages.items():
        text = f" {passage.decode('latin-1')} "
        if held and held + len(text) > size:
            out.make_automaton()
            yield out
            out, held = ahocorasick.Automaton(), 0
        out.add_word(text, (len(text), holder))
        held += len(text)
    if held:
        out.make_automaton()
        yield out


def located(passages: dict[bytes, int], texts: list[bytes], size: int) -> list[list[tuple[int, int, int]]]:
    """For each text, the passages that stand in it: first word, number of words, holder."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for machine in automata(passages, size):
        for found, text in zip(out, texts):
            spaces = None
            for end, (length, holder) in machine.iter(f" {text.decode('latin-1')} "):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) + 1  # as they stand after the space put first
                lo, hi = np.searchsorted(spaces, [end - length + 1, end]).tolist()
                lo += length <= end  # the passage's first space is one of the text's own
                found.append((lo, hi + 1 - lo, holder))
    return out


def _compare_contexts(contexts: list[Context]) -> Iterator[tuple]:
    """What the automata find in every document that comes after a passage's first: first and number of windows."""
    ranks = [[_rank(doc) for doc, *_ in c.places] for c in contexts]
    passages = confirmed([c.data for c in contexts], [min(r) for r in ranks], [max(r) for r in ranks], WIDTH)
    if not passages:
        return
    for c, own, found in zip(contexts, ranks, located(passages, [c.data for c in contexts], SHARD)):
        found.sort()
        for (doc, h, start), rank in zip(c.places, own) if found else ():
            lo = hi = -1
            for a, n, holder in found:
                if holder < rank:
                    if a > hi:
                        if hi >= 0:
                            yield doc, h, start + lo, hi - lo - WIDTH + 1
                        lo, hi = a, a + n
                    hi = max(hi, a + n)
            if hi >= 0:
                yield doc, h, start + lo, hi - lo - WIDTH + 1


def remove_passages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, h, n_words, n_removed, kept binary: each text's words, joined by one space, without those covered by a
    window of 50 words that also starts in a document of a smaller id.

    A null text has no words. A null id counts as the greatest. Rows of one id don't remove one another. A text of any
    length is compared whole, in contexts of at most 90 words. An empty df gives no rows; other columns of df are not
    read. The windows of an anchor of more than HOT occurrences are counted one by one instead, as no task can hold them.
    """
    docs = keyed(df, id_col, text_col)
    found = recurring(docs, word_units, WIDTH, GRAM, F.col("low") < F.col("high"))

    def hot(windows: DataFrame) -> DataFrame:
        doc = F.coalesce("doc_id", F.lit(_LAST))
        holders = windows.groupBy("a", "b").agg(F.min(doc).alias("holder"), F.max(doc).alias("last")).filter("holder < last").drop("last")
        later = known(windows, holders).filter(F.col("holder") < doc)
        return later.select("doc_id", "h", "start")

    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])
    texts, spots = compare(docs, found, word_units, WIDTH, GRAM, _compare_contexts, hot, "start int, n int", schema)

    def cut(row: dict) -> Iterator[tuple]:
        words = unpack(row["data"]).split()
        gone = np.zeros(len(words), bool)
        for spot in row["spots"] or ():
            gone[spot["start"] : spot["start"] + spot["n"] + WIDTH - 1] = True
        yield row["doc_id"], row["h"], len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist()) if not g])

    return joined(texts, spots).mapInArrow(mapped(cut, _OUT, 2000), "doc_id long, h long, n_words long, n_removed long, kept binary")


_OUT = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary())])


def digests(df: DataFrame) -> DataFrame:
    return remove_passages(df).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The same rows of digests() for documents with ids.
ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
     v AS (SELECT r, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
     f AS (SELECT k, min(doc_id) AS holder FROM v GROUP BY k),
     g AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS p FROM v JOIN f USING (k) WHERE holder < doc_id),
     k AS (SELECT r, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
           FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x ANTI JOIN g USING (r, p) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

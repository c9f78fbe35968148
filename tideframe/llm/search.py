"""Ranked search by inverted treaps.

The index is a table of posting lists in shards of bounded size: each shard holds whole documents, ordered by id, so no
term's list is ever in one place. For a search, the lists of the terms that are asked for become treaps: search trees by
document whose parents have the greater impact, so that a subtree's root bounds all of it. All treaps of an item are
walked at once: an interval of documents is given up when the sum of its roots can't enter the item's best k; otherwise
it is parted at the document of the root that weighs most, which is scored. Best scores go on from shard to shard of a
task, so that later shards are pruned from their roots on.

Every number is a 64-bit integer but the logarithm in a term's weight.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideframe.llm.common import discard, frugal, partitions, written

#: Terms (with repeats) of a shard, more only for one longer document.
SHARD = 4_000_000
#: Rows (item, term) that are broadcast to the tasks at a time; more items take another pass over the lists asked for.
PASS = 1_000_000
#: Intervals of an item that are looked at together, those of the greatest bounds first.
WIDTH = 16

#: What bytes become: A-Z lower case, bytes that are no part of a term a space. All bytes beyond ASCII are part of terms.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, A-Z as a-z."""
    return raw.translate(_FOLD).split()


_INDEX = "shard long, term binary, places array<int>, counts array<int>, ids array<long>, lengths array<long>"


def _shards(size: int):
    """Documents (id, text) as rows of shards: one for each term with the documents' places and counts, and one without a
    term that has the ids and lengths of the shard's documents by place."""
    schema = pa.schema([("shard", pa.int64()), ("term", pa.binary()), ("places", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])

    def rows(shard: int, ids: list, codes: list, counts: list, lengths: list[int], names: list[bytes]) -> Iterator[pa.RecordBatch]:
        # documents by id, those without one last; equal ids as they come
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        place = np.empty(len(ids), np.int32)
        place[order] = np.arange(len(ids))
        sizes = [len(c) for c in codes]
        code, count, spot = np.concatenate(codes), np.concatenate(counts), np.repeat(place, sizes)
        by_term = np.lexsort((spot, code))
        ends = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(names)))]).astype(np.int32)
        spot, count = spot[by_term], count[by_term]
        step = max(1, (1 << 21) // max(1, len(spot) // max(1, len(names))))
        for low in range(0, len(names), step):
            high = min(len(names), low + step)
            own, at = slice(ends[low], ends[high]), pa.array(ends[low : high + 1] - ends[low], pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(v[own], pa.int32())) for v in (spot, count)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(high - low, shard)), pa.array(names[low:high], pa.binary()), *lists, *[pa.nulls(high - low, t.type) for t in list(schema)[4:]]], schema=schema)
        head = [pa.array([[values[i] for i in order]], pa.list_(pa.int64())) for values in (ids, lengths)]
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *[pa.nulls(1, t.type) for t in list(schema)[1:4]], *head], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, total = TaskContext.get().partitionId() << 32, 0
        vocabulary: dict[bytes, int] = {}
        ids, codes, counts, lengths = [], [], [], []
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                terms = terms_of(text.as_buffer().to_pybytes()) if text.is_valid else []
                if not terms:
                    continue  # no item finds it, and it counts nowhere
                own = Counter(terms)
                ids.append(i.as_py())
                codes.append(np.fromiter((vocabulary.setdefault(t, len(vocabulary)) for t in own), np.int32, len(own)))
                counts.append(np.fromiter(own.values(), np.int32, len(own)))
                lengths.append(len(terms))
                total += len(terms)
                if total >= size:
                    yield from rows(shard, ids, codes, counts, lengths, [*vocabulary])
                    shard, total, vocabulary = shard + 1, 0, {}
                    ids, codes, counts, lengths = [], [], [], []
        if ids:
            yield from rows(shard, ids, codes, counts, lengths, [*vocabulary])

    return run


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD) -> DataFrame:
    """The posting lists of all terms of all documents, as a written table. Documents without a term aren't in it."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return written(rows.mapInArrow(frugal(_shards(size)), _INDEX))


class Treaps:
    """Treaps of several terms over the documents of one shard, as arrays; node numbers run over all terms.

    Parents have the greater impact; among equal ones a hash of the place decides, so that equal documents make no chain.
    """

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray]], m: np.ndarray):
        sizes = np.array([len(p) for p, _ in lists], np.int64)
        self.place = np.concatenate([p for p, _ in lists]).astype(np.int64)
        count = np.concatenate([c for _, c in lists]).astype(np.int64)
        self.impact = 1_000_000_000 * count // (1000 * count + 8 * m[self.place])
        self.left, self.right = np.full((2, len(self.place)), -1, np.int64)
        spread = (self.place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        rank = np.empty(len(self.place), np.int64)
        rank[np.lexsort((spread, self.impact))] = np.arange(len(self.place))
        ends = np.cumsum(sizes)
        self.root = np.array([self._tree(rank, e - n, e) for e, n in zip(ends.tolist(), sizes.tolist())], np.int64)

    def _tree(self, rank: np.ndarray, low: int, high: int) -> int:
        """Joins the nodes from low to high, which are in order of place; its root."""
        if high - low == 1:
            return low
        own = rank[low:high].tolist()
        n, left, right, spine = high - low, [-1] * (high - low), [-1] * (high - low), []
        for i in range(n):
            last, r = -1, own[i]
            while spine and own[spine[-1]] < r:
                last = spine.pop()
            left[i] = last
            if spine:
                right[spine[-1]] = i
            spine.append(i)
        for side, links in ((self.left, left), (self.right, right)):
            own = np.array(links, np.int64)
            side[low:high] = np.where(own < 0, -1, own + low)
        return low + spine[0]

    def split(self, node: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each treap, by the root of what it has from low to high, and place: the roots of what it has from low to the
        place and from behind the place to high, and the impact of the place itself; -1 and 0 where there is nothing."""
        before, behind, found = np.full(len(node), -1, np.int64), np.full(len(node), -1, np.int64), np.zeros(len(node), np.int64)
        live, cur = np.arange(len(node)), node
        while len(live):
            place, goal = self.place[cur], at[live]
            less, more = place < goal, place > goal
            here = ~(less | more)
            new = less & (before[live] < 0) & (place >= low[live])
            before[live[new]] = cur[new]
            new = more & (behind[live] < 0) & (place < high[live])
            behind[live[new]] = cur[new]
            if here.any():
                found[live[here]] = self.impact[cur[here]]
                self._within(before, self.left, live[here], cur[here], low, at)
                self._within(behind, self.right, live[here], cur[here], at + 1, high)
            cur = np.where(less, self.right[cur], self.left[cur])
            go = ~here & (cur >= 0)
            live, cur = live[go], cur[go]
        return before, behind, found

    def _within(self, out: np.ndarray, child: np.ndarray, spot: np.ndarray, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """The root of what lies from low to high in the subtree of the node's child, where `out` has none yet."""
        new = out[spot] < 0
        spot, cur = spot[new], child[node[new]]
        while True:
            go = cur >= 0
            spot, cur = spot[go], cur[go]
            if not len(spot):
                return
            place = self.place[cur]
            less, more = place < low[spot], place >= high[spot]
            here = ~(less | more)
            out[spot[here]] = cur[here]
            cur = np.where(less, self.right[cur], self.left[cur])
            spot, cur = spot[~here], cur[~here]


class Best:
    """The best k documents of each item: greater scores first, then documents with an id, then the lesser id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.none, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
        self.least = np.zeros(items, np.int64)  # the score of an item's k-th document, 0 while it has fewer
        self.last = np.full((items, 2), -1, np.int64)  # and its (none, id)

    def add(self, item: np.ndarray, score: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        item, score, none, ids = (np.concatenate(x) for x in ((self.item, item), (self.score, score), (self.none, none), (self.id, ids)))
        order = np.lexsort((ids, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        keep = rank < self.k
        order = order[keep]
        self.item, self.score, self.none, self.id = item[keep], score[order], none[order], ids[order]
        full = rank[keep] == self.k - 1
        at = self.item[full]
        self.least[at] = self.score[full]
        self.last[at, 0], self.last[at, 1] = self.none[full], self.id[full]


def _starts(of: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers start."""
    return np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))


def walk(treaps: Treaps, item: np.ndarray, node: np.ndarray, weight: np.ndarray, none: np.ndarray, ids: np.ndarray, best: Best, width: int = WIDTH) -> int:
    """Add to `best` what the documents of a shard give. item, node, weight: for each item and term the term's root and
    weight, sorted by item; none, ids: the documents by place. How many documents of items were scored."""
    if not len(item):
        return 0
    known = len(none) - int(none.sum())
    start = _starts(item)
    entry = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(item))))
    stack, scored = [(item[start], np.zeros(len(start), np.int64), np.full(len(start), len(ids)), entry, node, weight)], 0
    while stack:
        item, low, high, entry, node, weight = stack.pop()
        start = _starts(entry)
        value = weight * treaps.impact[node]
        bound, least = np.add.reduceat(value, start), best.least[item]
        keep = bound > least
        tie = np.flatnonzero((bound == least) & (least > 0))
        if len(tie):  # a document of the same score counts if it comes before the last one
            last = best.last[item[tie]]
            keep[tie] = low[tie] < np.where(last[:, 0] == 1, known, np.searchsorted(ids[:known], last[:, 1]))
        if not keep.any():
            continue
        order = np.lexsort((-bound, item))
        order = order[keep[order]]
        rank = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        now = np.zeros(len(item), bool)
        now[order[rank < width]] = True
        later = keep & ~now
        if later.any():
            own = later[entry]
            number = np.cumsum(later) - 1
            stack.append((item[later], low[later], high[later], number[entry[own]], node[own], weight[own]))
        own = now[entry]
        item, low, high, number = item[now], low[now], high[now], np.cumsum(now) - 1
        entry, node, weight, value = number[entry[own]], node[own], weight[own], value[own]
        # the document of each interval's heaviest root
        start = _starts(entry)
        heaviest = np.flatnonzero(value == np.maximum.reduceat(value, start)[entry])
        heaviest = heaviest[_starts(entry[heaviest])]
        at = treaps.place[node[heaviest]]
        before, behind, found = treaps.split(node, at[entry], low[entry], high[entry])
        score = np.add.reduceat(weight * found, start)
        scored += len(score)
        some = score > 0
        best.add(item[some], score[some], none[at[some]], ids[at[some]])
        left, right = before >= 0, behind >= 0
        entries = np.concatenate([entry[left], entry[right] + len(item)])
        if len(entries):
            first = _starts(entries)
            new = entries[first]
            item, low, high = (np.concatenate(x)[new] for x in ((item, item), (low, at + 1), (at, high)))
            entry = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(entries))))
            stack.append((item, low, high, entry, np.concatenate([before[left], behind[right]]), np.concatenate([weight[left], weight[right]])))
    return scored


def _damping(lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
    """25 and 75 times a document's length over the mean one, rounded down. Beyond 64 bits with Python's own numbers."""
    if len(lengths) and 75 * int(lengths.max()) * docs < 2**63:
        return 25 + 75 * lengths * docs // total
    return np.array([25 + 75 * int(n) * docs // total for n in lengths], np.int64)


def _numbered(rows: pa.Table) -> tuple:
    """Rows (item, item_id, term, weight) as: hashes and ids of the items; the number of each term; and for each row, by
    item, the numbers of both and the weight."""
    rows = rows.sort_by([("item", "ascending"), ("item_id", "ascending"), ("term", "ascending")]).combine_chunks()
    number = {t: i for i, t in enumerate(sorted(set(rows["term"].to_pylist())))}
    pairs = rows.select(["item", "item_id"]).to_pylist()
    new = np.array([i == 0 or pairs[i] != pairs[i - 1] for i in range(len(pairs))])
    first = pa.array(np.flatnonzero(new))
    keys, ids = (rows[c].combine_chunks().take(first) for c in ("item", "item_id"))
    return keys, ids, number, np.cumsum(new) - 1, np.array([number[t] for t in rows["term"].to_pylist()], np.int64), rows["weight"].to_numpy()


def _ranked(asked, docs: int, total: int, k: int, width: int):
    """Lists of terms asked for, shard by shard, as the best k documents of each item over all shards of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, key_ids, number, items, of_term, weights = asked.value
        best = Best(len(keys), k)
        shard, lists, head = None, {}, None

        def done() -> None:
            if not lists or head is None:
                return
            ids, lengths = head
            none = np.array([i is None for i in ids], bool)
            ids = np.array([i or 0 for i in ids], np.int64)
            order = sorted(lists)
            treaps = Treaps([lists[t] for t in order], _damping(np.array(lengths, np.int64), docs, total))
            root = np.full(len(number), -1, np.int64)
            root[order] = treaps.root
            node = root[of_term]
            own = node >= 0
            walk(treaps, items[own], node[own], weights[own], none, ids, best, width)

        for batch in batches:
            flat = [(c.flatten().to_numpy(zero_copy_only=False), c.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)) for c in (batch.column("places"), batch.column("counts"))]
            (places, size), (counts, _) = flat
            ends = np.cumsum(size)
            for i, (s, term) in enumerate(zip(batch.column("shard").to_pylist(), batch.column("term").to_pylist())):
                if s != shard:
                    done()
                    shard, lists, head = s, {}, None
                if term is None:
                    head = batch.column("ids")[i].as_py(), batch.column("lengths")[i].as_py()
                else:
                    own = slice(ends[i] - size[i], ends[i])
                    lists[number[term]] = places[own], counts[own]
        done()
        own = pa.array(best.item)
        yield pa.RecordBatch.from_arrays([keys.take(own), key_ids.take(own), pa.array(best.score), pa.array(best.id, mask=best.none)], names=["item", "item_id", "score", "doc_id"])

    return run


def _weight(docs: Column, holding: Column) -> Column:
    return F.floor(1000 * F.log((2.0 * docs + 2) / (2.0 * holding + 1))).cast("long")


def asked_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a hash that knows an item), item_id, term, times: the terms of each item with their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[*Counter(terms_of(t.as_buffer().to_pybytes())).items()] if t.is_valid else [] for t in batch.column(2)]
            at = np.repeat(np.arange(len(out)), [len(x) for x in out])
            terms, times = pa.array([t for x in out for t, _ in x], pa.binary()), pa.array([n for x in out for _, n in x], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), terms, times], names=["item", "item_id", "term", "times"])

    own = items.select(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string")).alias("item"), F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return own.dropDuplicates(["item", "item_id"]).mapInArrow(run, "item long, item_id long, term binary, times long")


def search(lists: DataFrame, items: DataFrame, k: int = 10, width: int = WIDTH, per_pass: int = PASS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of an index for each item, those of score 0 left out.

    Items without a term, or with none that a document holds, have no rows. A repeated row of an item counts once; of rows
    with one id and different texts each has its own ranks. Documents of equal score go by id, those without one last;
    repeated rows of a document are documents of their own. An empty index or no items give no rows.
    """
    spark = lists.sparkSession
    result = "item_id long, rank int, doc_id long, score long"
    terms = written(asked_terms(items))
    size = lists.filter("term IS NULL").agg(F.sum(F.size("ids")).alias("docs"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("total")).first()
    docs, total, n = size["docs"] or 0, size["total"] or 0, terms.count()
    if not docs or not n:
        return spark.createDataFrame([], result)
    # the lists asked for, whatever the pass; Spark broadcasts the terms if they are few enough
    own = written(lists.join(terms.select("term").distinct(), "term", "left_semi"))
    holding = own.groupBy("term").agg(F.sum(F.size("places")).alias("holding"))
    weighed = terms.join(holding, "term").select("item", "item_id", "term", (F.col("times") * _weight(F.lit(docs), F.col("holding"))).alias("weight")).filter("weight > 0")
    passes = max(1, -(-n // per_pass))
    weighed = written(weighed.withColumn("pass", F.pmod(F.col("item"), F.lit(passes)).cast("int")))
    heads, found = lists.filter("term IS NULL"), []
    for p in range(passes):
        rows = weighed.filter(F.col("pass") == p).select("item", "item_id", "term", "weight").toArrow()  # about per_pass rows
        if not rows.num_rows:
            continue
        mine = own if passes == 1 else own.join(weighed.filter(F.col("pass") == p).select("term").distinct(), "term", "left_semi")
        dealt = heads.unionByName(mine.select(*heads.columns)).repartition(partitions(spark), "shard").sortWithinPartitions("shard")
        asked = spark.sparkContext.broadcast(_numbered(rows))
        found.append(written(dealt.mapInArrow(frugal(_ranked(asked, docs, total, k, width)), "item long, item_id long, score long, doc_id long")))
        asked.unpersist()
    if not found:
        return spark.createDataFrame([], result)
    every = found[0]
    for other in found[1:]:
        every = every.unionByName(other)
    place = F.row_number().over(Window.partitionBy("item", "item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    return every.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k best of all documents for each item, by an index made for it."""
    lists = index(docs)
    out = search(lists, items, k)
    discard(lists)
    return out


#: The same rows in DuckDB.
ORACLE = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS row, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
s AS (SELECT count(DISTINCT row) AS docs, count(*) AS total FROM t),
d AS (SELECT doc_id, row, 25 + (75 * count(*) * (SELECT docs FROM s)) // (SELECT total FROM s) AS m FROM t GROUP BY ALL),
p AS (SELECT row, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * (SELECT docs FROM s) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w FROM p GROUP BY term),
r AS (SELECT item_id, doc_id, row, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN p USING (term) JOIN d USING (row) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row) AS rank FROM r WHERE score > 0)
WHERE rank <= 10
"""

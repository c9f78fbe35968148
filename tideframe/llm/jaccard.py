"""N-gram Jaccard join: documents whose sets of word shingles have a least similarity, and their components. The shingle's
words and the similarity in percent are parameters: 3 and 90 if not given.

A size-aware heavy-light join. Equal sets fall together by their hash. A pair of small ("light") sets that links shares
a large subset, so light sets give all their subsets of the sizes that count as keys. Large ("heavy") sets are parted by
the shingles' hashes into one part more than a linked pair can differ in, so that a linked pair has an equal part: the
parts are their keys. There are a few more parts than that, and each set leaves out as many of its smallest, which may
be empty or a common phrase: of the parts that a pair has equal, the largest stays in both. The size where one passes
into the other is the one of least cost over the corpus's sizes. Copies within a task give their keys once, and copies
anywhere are one set from there on. Sets that share a key, directly or through others, form a group. Of the sets that a
task reads together only the first one with a key sends it on, and the others are hung on that set at once, so that a
key of a third of all sets crosses the network once for each such block of rows. A set travels to its group, where the
inverted lists of the group's shingles are scanned for exact overlaps. In a group of too many sets or bytes, as a line that
many texts have makes it, the sets are first grouped anew by their rarest shingles. What is still too large is parted by the
bands of the sets' sizes and each band into blocks; blocks of one band or of neighbouring ones are compared, two at a time,
as sets of other bands can't link. So what a task holds is bounded by bytes, and a text travels only to sizes like its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tideframe.llm.common import Rolling, discard, frugal, mix, partitions, written
from tideframe.llm.graph import components
from tideframe.llm.repeats import keyed, word_units

#: What is linked if not said otherwise: the similarity in percent, and the words of a shingle.
PERCENT, WORDS = 90, 3
#: The light sets have at most 20 shingles; reading one entry of an inverted list costs as much as so many subset keys.
MOST_LIGHT, SCAN_COST = 20, 3
#: Groups of more sets, or of more bytes of text, are compared in blocks of about so many. A single text may be longer.
BLOCK, BLOCK_BYTES = 1000, 16 << 20
#: Parts of fewer shingles than this on average may be empty or a common phrase.
SMALL_PART = 6
#: Rows that a task sketches at once, and among which a key is sent on only once.
AT_ONCE = 500
#: Sets that a task remembers having had.
MEMORY = 500_000
_LAST = 2**63 - 1


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text; fewer words than a shingle's are one shingle."""
    data, starts, ends = word_units(text.lower())
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64)
    k = min(n, words)
    return np.unique(Rolling(data).of(starts[: n - k + 1], ends[k - 1 :]))


def links(a, b, both, percent: int = PERCENT):
    """Whether sets of sizes a and b with `both` common shingles link."""
    return 100 * both >= percent * (a + b - both)


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    return -(-percent * (a + b) // (100 + percent))


@cache
def most_deleted(n: int, percent: int = PERCENT) -> int:
    """How many shingles a set of n may have that a linked set lacks."""
    sizes = range(-(-percent * n // 100), 100 * n // percent + 1)
    return max((n - least_overlap(n, b, percent) for b in sizes if least_overlap(n, b, percent) <= min(n, b)), default=0)


def subset_keys(n: int, percent: int = PERCENT) -> int:
    return sum(comb(n, k) for k in range(most_deleted(n, percent) + 1))


@cache
def _edges(percent: int) -> np.ndarray:
    """Size bands of the heavy sets: a linked pair is in one band or in neighbouring ones."""
    edges = [1]
    while edges[-1] < 10**9:
        edges.append(max(edges[-1] + 1, -(-edges[-1] * 100 // percent)))
    return np.array(edges)


def _band(n: int, percent: int) -> int:
    return int(np.searchsorted(_edges(percent), n, "right")) - 1


@cache
def parts(band: int, percent: int = PERCENT) -> int:
    """One more than the shingles in which a set of the band and a linked one as large or larger differ at most."""
    a = int(_edges(percent)[band + 1]) - 1
    b = 100 * a // percent
    return (a + b) * (100 - percent) // (100 + percent) + 1


@cache
def spare(band: int, percent: int = PERCENT) -> int:
    """How many parts there are besides, as many as a set leaves out: a fourth, where a part has few shingles, else an
    eighth, so that hardly any set has more empty parts than it leaves out."""
    m = parts(band, percent)
    return max(2, m // 4) if int(_edges(percent)[band + 1]) - 1 < SMALL_PART * m else max(2, m // 8)


def list_keys(n: int, percent: int = PERCENT) -> int:
    band = _band(n, percent)
    return parts(band, percent) + (parts(band - 1, percent) if band else 0)


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The greatest light size, by the least cost over how many sets have each size up to MOST_LIGHT * 100 / percent."""
    top = max([MOST_LIGHT * 100 // percent, *sizes])

    def cost(x: int) -> int:
        light = sum(sizes.get(n, 0) * subset_keys(n, percent) for n in range(1, x * 100 // percent + 1))
        return light + SCAN_COST * sum(sizes.get(n, 0) * list_keys(n, percent) for n in range(x + 1, top + 1))

    return min(range(MOST_LIGHT + 1), key=cost)


def keys_of(own: np.ndarray, light: int, percent: int = PERCENT) -> np.ndarray:
    """The keys of a set: those of its subsets, of its parts, or both near the boundary."""
    n, out = len(own), []
    spread = mix(own + np.uint64(0x5851F42D4C957F2D))
    if n <= light * 100 // percent:
        total = spread.sum(dtype=np.uint64)
        for k in range(most_deleted(n, percent) + 1):
            gone = np.array([sum(map(int, c)) % 2**64 for c in combinations(spread.tolist(), k)], np.uint64)
            out.append(mix((total - gone) ^ mix(np.full(len(gone), n - k, np.uint64))))
    if n > light:
        band = _band(n, percent)
        for i in (band, band - 1):
            if i >= 0:
                left_out = spare(i, percent)
                m = parts(i, percent) + left_out
                place = (own % np.uint64(m)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                heads = np.searchsorted(place[order], np.arange(m))
                ends = np.append(heads[1:], n)
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread[order], dtype=np.uint64)])
                value = sums[ends] - sums[heads]
                keys = mix(value ^ mix(np.arange(m, dtype=np.uint64) + np.uint64(i << 32) + np.uint64(1 << 20)))
                # equal parts have equal sizes and keys, so that this order is the same in both sets
                out.append(keys[np.lexsort((keys, ends - heads))[left_out:]] if left_out else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def set_keys(own: np.ndarray) -> tuple[int, int]:
    """Two hashes of a whole set."""
    one = mix(own).sum(dtype=np.uint64)
    two = mix(own ^ np.uint64(0xA24BAED4963EE407)).sum(dtype=np.uint64)
    return int(np.int64(one.view(np.int64))), int(np.int64(two.view(np.int64)))


def listed(flat: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
    """The values of each of n rows as a list; row: the rows that the values belong to, in order."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, flat)


def _sketch(light: int, words: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("k", pa.int64()), ("keys", pa.list_(pa.int64())), ("met", pa.list_(pa.int64())), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                yield sketched(whole.slice(lo, AT_ONCE), seen)

    def sketched(batch: pa.RecordBatch, seen: set[tuple[int, int]]) -> pa.RecordBatch:
        """Copies of a set that the task has had give no keys again; a key that a row before has is given up for that row's
        node in `met`."""
        if len(seen) > MEMORY:
            seen.clear()
        sets = [shingles(x.as_py(), words) for x in batch.column(2)]
        pairs = [set_keys(s) for s in sets]
        own = []
        for s, pair in zip(sets, pairs):
            own.append(keys_of(s, light, percent) if len(s) and pair not in seen else np.zeros(0, np.uint64))
            seen.add(pair)
        flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
        row = np.repeat(np.arange(len(own)), [*map(len, own)]).astype(np.int64)
        _, first, which = np.unique(flat, return_index=True, return_inverse=True)
        lead = row[first[which]]
        new = lead == row
        hung = np.unique(np.stack([row[~new], lead[~new]], axis=1), axis=0)
        nodes = np.array([p[0] for p in pairs], np.int64)
        lists = [listed(flat[new], row[new], len(own)), listed(nodes[hung[:, 1]], hung[:, 0], len(own))]
        columns = [batch.column(0), batch.column(1), pa.array([*map(len, sets)], pa.int64()), pa.array(nodes), pa.array([p[1] for p in pairs], pa.int64()), *lists, pc.binary_length(batch.column(2)).cast(pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def _sizes(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(shingles(x.as_py(), words)) for x in batch.column(0)], pa.int64())], names=["n"])

    return run


def overlaps(sets: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each set, the others that share a shingle with it and how many they share, by scanning the inverted lists of
    its shingles."""
    sizes = np.array([*map(len, sets)])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    length = np.diff(np.append(heads, len(flat)))
    where = np.empty(len(flat), np.int64)
    where[order] = np.repeat(np.arange(len(heads)), length)
    at = np.cumsum(sizes) - sizes
    for i in range(len(sets)):
        own = where[at[i] : at[i] + sizes[i]]
        own = own[length[own] > 1]
        if not len(own):
            continue
        count = length[own]
        ends = np.cumsum(count)
        found = owner[np.arange(ends[-1]) + np.repeat(heads[own] - ends + count, count)]
        if len(found) < len(sets):
            others, both = np.unique(found, return_counts=True)
        else:
            both = np.bincount(found)
            others = np.flatnonzero(both)
            both = both[others]
        yield i, others[others != i], both[others != i]


def _resolve(words: int, percent: int):
    """For each group: its sets with the least document of their component, and how many documents they link with."""

    def group(rows: list[dict]) -> pa.RecordBatch:
        by_group: dict = {}
        for row in rows:
            by_group.setdefault((row["grp"], row["one"], row["two"]), []).append(row)
        out = []
        for (grp, one, two), own in by_group.items():
            own = list({(r["node"], r["k"]): r for r in own}.values())  # repeated rows
            sets = [shingles(r["data"], words) for r in own]
            sizes = np.array([*map(len, sets)])
            copies = np.array([r["copies"] for r in own])
            side = np.array([r["block"] for r in own])
            parent = list(range(len(own)))

            def find(i: int) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            linked = [0] * len(own)
            for i, others, both in overlaps(sets):
                yes = links(sizes[i], sizes[others], both, percent)
                if one != two:
                    yes &= side[others] != side[i]
                others = others[yes]
                linked[i] = int(copies[others].sum())
                for j in others.tolist():
                    a, b = find(i), find(j)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
            for i, row in enumerate(own):
                top = own[find(i)]
                out.append((row["node"], row["k"], top["node"], linked[i]))
        columns = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "k", "top", "linked"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                for row in batch.slice(lo, 256).to_pylist():
                    key = (row["grp"], row["one"], row["two"])
                    if size >= 4_000_000 and key != (rows[-1]["grp"], rows[-1]["one"], rows[-1]["two"]):
                        yield group(rows)
                        rows, size = [], 0
                    rows.append(row)
                    size += len(row["data"])
        if rows:
            yield group(rows)

    return run


def _band_of(n: Column, percent: int) -> Column:
    """The band of a set's size, as _band() has it."""
    return F.size(F.filter(F.lit(_edges(percent).tolist()), lambda e: e <= n)) - 1


def _block(band: Column, place: Column) -> Column:
    """One number for a block of a band."""
    return F.shiftleft(band.cast("long"), 32) + place


def _partners(band: Column, blocks: Column) -> Column:
    """The blocks of a band and of its neighbours; blocks: how many each band of the group has."""

    def of(b: Column) -> Column:
        n = F.coalesce(F.try_element_at(blocks, b), F.lit(0))
        return F.transform(F.filter(F.sequence(F.lit(0), n), lambda o: o < n), lambda o: _block(b, o))

    return F.flatten(F.transform(F.array(band - 1, band, band + 1), of))


def _counted(place: DataFrame) -> DataFrame:
    """grp, parted, blocks: whether a group is compared in blocks, and how many each of its bands has."""
    bands = place.groupBy("grp", "band").agg(F.count(F.lit(1)).alias("sets"), F.sum("size").alias("bytes"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK), F.ceil(F.col("bytes") / BLOCK_BYTES), F.lit(1)).cast("int")
    counts = bands.groupBy("grp").agg(F.sum("sets").alias("sets"), F.sum("bytes").alias("bytes"), F.map_from_entries(F.collect_list(F.struct("band", blocks))).alias("blocks"))
    return counts.select("grp", ((F.col("sets") > BLOCK) | (F.col("bytes") > BLOCK_BYTES)).alias("parted"), "blocks")


def _tokens(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, AT_ONCE):
                batch = whole.slice(lo, AT_ONCE)
                sets = [shingles(x.as_py(), words) for x in batch.column(2)]
                row = np.repeat(np.arange(len(sets)), [*map(len, sets)]).astype(np.int64)
                grp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                flat = mix(np.concatenate(sets) ^ mix(grp)[row]).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(1), listed(flat, row, len(sets))], names=["node", "keys"])

    return run


def _finer(member: DataFrame, words: int, percent: int) -> DataFrame:
    """node, root: groups within the groups of member, of sets that share one of their rarest shingles, directly or
    through others. A set without one links with nothing and is left out.

    Linked sets of a and b shingles share percent of the larger at least. In any one order of all shingles, the least of
    those that both have is among the first a - percent * a + 1 of the one and the first b - percent * b + 1 of the other.
    In the order of how many sets of the group have a shingle, what only one set has comes first and needs no row, and a
    line that a third of the group has comes last.
    """
    rows = member.select("grp", "node", "data").mapInArrow(frugal(_tokens(words)), "node long, keys array<long>").select("node", F.explode("keys").alias("key"))
    shared = rows.withColumn("sets", F.count(F.lit(1)).over(Window.partitionBy("key"))).filter("sets > 1")
    shared = shared.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("sets", "key"))).alias("shared")).join(member.groupBy("node").agg(F.max("n").alias("n")), "node")
    first = (F.size("shared") - F.floor((percent * F.col("n") + 99) / 100) + 1).cast("int")
    keys = shared.select("node", F.explode(F.slice("shared", F.lit(1), F.greatest(first, F.lit(0)))).alias("one")).select("node", "one.key")
    return components(keys.select(F.col("node").alias("a"), F.min("node").over(Window.partitionBy("key")).alias("b")))


def similar(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, h, n_shingles, component_id, n_links, root: each document's set size, the least document that links reach
    from it (itself included), the number of documents it links with directly, and a number of its component (null for
    the empty set).

    Documents link whose sets of shingles of so many words have a similarity of so many percent or more.
    Null and empty texts have the empty set and link with nothing, so their component is their own id. A null id counts
    as the greatest, and is the component of documents that have no other. Repeated rows link with one another. A text
    of any length is one set of all its shingles. An empty df gives no rows; other columns of df are not read.
    """
    spark = df.sparkSession
    n_parts = max(partitions(spark), 8)
    docs = keyed(df, id_col, text_col)
    # the boundary only weighs costs, so sizes of texts that can't but be small do
    short = docs.filter(F.octet_length("data") <= 1000).select("data").mapInArrow(_sizes(words), "n long")
    top = MOST_LIGHT * 100 // percent
    light = boundary({r["n"]: r["count"] for r in short.filter(F.col("n").between(1, top)).groupBy("n").count().collect()}, percent)
    sketches = written(docs.mapInArrow(frugal(_sketch(light, words, percent)), "doc_id long, h long, n long, node long, k long, keys array<long>, met array<long>, size long"))

    entries = sketches.select(F.explode("keys").alias("key"), "node")
    edges = entries.select(F.col("node").alias("a"), F.min("node").over(Window.partitionBy("key")).alias("b"))
    edges = edges.unionByName(sketches.select(F.col("node").alias("a"), F.explode("met").alias("b")))
    groups = components(edges).withColumnRenamed("root", "grp")
    sketches, keyed_ones = written(sketches.drop("keys", "met")), sketches  # the keys are most of it
    discard(keyed_ones)

    classes = sketches.filter("n > 0").groupBy("node", "k").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("d"), "h", "size")).alias("rep"), F.first("n").alias("n"))
    member = classes.join(groups, "node").select("grp", "node", "k", "copies", "n", F.col("rep.d").alias("_d"), F.col("rep.h").alias("_h"), F.col("rep.size").alias("size"))
    member = member.join(docs, (F.col("_d") == F.coalesce("doc_id", F.lit(_LAST))) & (F.col("_h") == F.col("h")))
    member = written(member.select("grp", "node", "k", "copies", "n", _band_of(F.col("n"), percent).alias("band"), "size", "data"))
    place = member.drop("data").distinct()
    counts = written(_counted(place))
    large = counts.filter("parted").select("grp")
    if not large.isEmpty():
        finer = _finer(member.join(large, "grp", "left_semi"), words, percent)
        apart = place.join(large, "grp", "left_semi").join(finer, "node").withColumn("grp", F.col("root")).select(place.columns)
        place = written(place.join(large, "grp", "left_anti").unionByName(apart))
        counts = written(_counted(place))
    place = place.join(counts, "grp").withColumn("block", F.when(F.col("parted"), _block(F.col("band"), F.pmod(F.xxhash64("node", F.lit(7)), F.try_element_at("blocks", "band")))).otherwise(0))
    pairs = F.when(F.col("parted"), _partners(F.col("band"), F.col("blocks"))).otherwise(F.array(F.lit(0).cast("long")))
    pair = F.explode(F.transform(pairs, lambda o: F.struct(F.least("block", o).alias("one"), F.greatest("block", o).alias("two"))))
    place = place.select("grp", pair.alias("pair"), "block", "node", "k", "copies").select("grp", "pair.one", "pair.two", "block", "node", "k", "copies")
    units = place.join(member.select("node", "k", "data"), ["node", "k"]).select("grp", "one", "two", "block", "node", "k", "copies", "data")
    resolved = written(
        units.repartition(n_parts, "grp", "one", "two").sortWithinPartitions("grp", "one", "two").mapInArrow(frugal(_resolve(words, percent)), "node long, k long, top long, linked long")
    )
    discard(member)
    linked = resolved.groupBy("node", "k").agg(F.sum("linked").alias("linked"))
    if counts.filter("parted").isEmpty():
        roots = resolved.select("node", "k", F.col("top").alias("root"))
    else:  # the links of a group in blocks meet again
        again = components(resolved.select(F.col("node").alias("a"), F.col("top").alias("b")))
        roots = resolved.select("node", "k").distinct().join(again, "node", "left").select("node", "k", F.coalesce("root", "node").alias("root"))
    full = classes.join(linked, ["node", "k"], "left").join(roots, ["node", "k"], "left").withColumn("root", F.coalesce("root", "node"))
    first = full.groupBy("root").agg(F.min("least").alias("component"))
    full = full.join(first, "root").select("node", "k", "root", "component", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links"))
    out = sketches.select("doc_id", "h", "n", "node", "k").join(full, ["node", "k"], "left")
    return out.select("doc_id", "h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"), F.when(F.col("n") > 0, F.col("links")).otherwise(0).alias("n_links"), "root")


def report(df: DataFrame) -> DataFrame:
    return similar(df).select("doc_id", "n_shingles", "component_id", "n_links")


#: The same rows of report() for documents with ids that differ.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS shingle
           FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
     e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
     c AS (SELECT doc_id, doc_id AS root FROM documents UNION SELECT e.a, c.root FROM c JOIN e ON e.b = c.doc_id)
SELECT t.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(root) FROM c WHERE c.doc_id = t.doc_id) AS component_id, (SELECT count(*) FROM e WHERE e.a = t.doc_id) AS n_links
FROM documents t LEFT JOIN n ON n.doc_id = t.doc_id
"""

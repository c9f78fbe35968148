"""Passages, repeated strings and near copies against plain versions, and their edge cases."""

import collections
import hashlib
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tideframe.llm import graph, jaccard, phrases, repeats, suffixes
from tideframe.llm.common import Rolling, ragged, runs, sliding_max, sliding_min, pack_ints, pack_strings, unpack_ints, unpack_strings


def test_helpers():
    a = np.array([5, 3, 4, 1, 9, 2], np.uint64)
    assert sliding_min(a, 3).tolist() == [3, 1, 1, 1] and sliding_max(a, 4).tolist() == [5, 9, 9]
    assert unpack_ints(pack_ints(np.array([0, 7, 70000]))).tolist() == [0, 7, 70000] and unpack_strings(pack_strings([b"", b"ab"])) == [b"", b"ab"]
    assert ragged(np.arange(9), np.array([4, 0]), np.array([2, 3])).tolist() == [4, 5, 0, 1, 2]
    assert [x.tolist() for x in runs(np.array([True, False, True, True]))] == [[0, 2], [1, 4]]
    r = Rolling(b"abcabc")
    assert r.of(np.array([0]), np.array([3])) == r.of(np.array([3]), np.array([6])) != r.of(np.array([1]), np.array([4]))


@pytest.mark.parametrize("seed", range(20))
def test_two_stage_suffix_sorting(seed):
    rng = random.Random(seed)
    letters = b"ab" if seed % 2 else b"abcdef \0"
    base = bytes(rng.choice(letters) for _ in range(60))
    texts = []
    for _ in range(rng.randint(1, 6)):
        own, i = bytes(rng.choice(letters) for _ in range(rng.randint(0, 60))), rng.randint(0, 40)
        texts.append(own[:20] + base[i : i + rng.randint(0, 40)] + own[20:])
    width = rng.choice([9, 12, 17])
    whole = b"\0".join(texts) + b"\0\1"
    t = np.frombuffer(whole, np.uint8)
    ascending = suffixes.smaller_than_next(t)
    assert ascending.tolist() == [i + 1 < len(whole) and whole[i:] < whole[i + 1 :] for i in range(len(whole))]
    member = np.arange(len(whole)) < len(whole) - 1
    order = suffixes.suffix_array(t, width, lambda x: Rolling(whole).of(x, np.minimum(x + width, len(whole))), ascending, member)
    assert sorted(order.tolist()) == [*range(len(whole) - 1)] and all(whole[x : x + width] <= whole[y : y + width] for x, y in zip(order, order[1:]))
    common = [next((k for k in range(width) if whole[x + k : x + k + 1] != whole[y + k : y + k + 1] or x + k >= len(whole)), width) for x, y in zip(order, order[1:])]
    assert suffixes.common_prefixes(t, order, width).tolist() == [0, *common]
    seen = collections.Counter(x[i : i + width] for x in texts for i in range(len(x) - width + 1))
    for x, flags in zip(texts, suffixes.repeated_starts(texts, width)):
        assert flags.tolist() == [seen[x[i : i + width]] > 1 for i in range(len(x) - width + 1)]


def words(rng, n):
    return " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))


def corpus(rng):
    """Copies, shared passages, periodic texts, empty and null texts, null and repeated ids."""
    shared, long_ = words(rng, 70), words(rng, 400)
    docs = [(i, f"{words(rng, rng.randint(0, 120))} {shared if i % 3 == 0 else ''} {words(rng, 30)}") for i in range(60)]
    docs += [(100 + i, long_) for i in range(5)] + [(110, long_ + " tail"), (111, "x " * 300), (112, "y" * 900), (113, "é" * 450)]
    docs += [(120, None), (121, ""), (122, " \n\t "), (3, docs[3][1]), (4, words(rng, 90) + " " + shared), (None, long_), (None, long_), (None, None)]
    rng.shuffle(docs)
    return docs


def plain_strings(docs, width=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = collections.Counter(t[k : k + width] for t in texts for k in range(len(t) - width + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - width + 1):
            if seen[t[k : k + width]] > 1:
                gone[k : k + width] = b"\1" * width
        out.append((i, len(t), sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), hashlib.sha256(bytes(c for c, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def plain_passages(docs, width=50):
    last = 2**63
    own = [(last if i is None else i, i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for d, _, w in sorted(own, key=lambda x: x[0]):
        for k in range(len(w) - width + 1):
            first.setdefault(tuple(w[k : k + width]), d)
    out = []
    for d, i, w in own:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k : k + width])] < d:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "clash", 0) for i, t in docs], "doc_id long, text string, h string, n int")


@pytest.mark.parametrize("hot", [50_000, 2])
def test_against_plain_versions(spark, monkeypatch, hot):
    """Also with nearly every anchor counted as hot, so that both ways to compare give the same."""
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = corpus(random.Random(4))
    df = frame(spark, docs)
    assert sorted(map(tuple, suffixes.digests(df).collect()), key=repr) == plain_strings(docs)
    assert sorted(map(tuple, phrases.digests(df).collect()), key=repr) == plain_passages(docs)


def test_queries_on_the_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    df = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    assert sorted(map(tuple, suffixes.digests(df).collect()), key=repr) == plain_strings(docs)
    assert sorted(map(tuple, phrases.digests(df).collect()), key=repr) == plain_passages(docs)
    assert sorted(map(tuple, jaccard.report(df).collect()), key=repr) == plain_links(docs)


def test_empty_tables(spark):
    df = frame(spark, [])
    assert suffixes.digests(df).count() == phrases.digests(df).count() == jaccard.report(df).count() == 0


def test_carried_columns(spark):
    df = spark.createDataFrame([(1, "a" * 250, "en", None)], "doc_id long, text string, lang string, source string")
    assert suffixes.remove_repeats(df, carry=["lang", "source"]).select("n_removed", "carry.lang", "carry.source").first()[1:] == ("en", None)


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def plain_links(docs):
    sets = [shingle_set(t) for _, t in docs]
    parent, count = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) >= 0.9 * max(len(a), len(b)) and 100 * len(a & b) >= 90 * len(a | b):
                count[i] += 1
                count[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d, count[i]) for i, (d, _) in enumerate(docs)), key=repr)


def near_copies(rng):
    base = [f"w{i}" for i in range(400)]
    docs = [(0, None), (1, ""), (2, " \n"), (None, "One two THREE four"), (None, "one two three four")]
    for k in range(3, 500):
        start, n = rng.choice([0, 0, 7, 50]), rng.randint(1, 45) if k % 2 else rng.randint(30, 200)
        own = base[start : start + n]
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            own[rng.randrange(len(own))] = f"x{rng.randint(0, 9)}"
        docs.append((k, " ".join(own)))
    return docs


@pytest.mark.parametrize("block, size", [(4000, 1 << 24), (30, 1 << 24), (4000, 3000), (30, 100)])
def test_links(spark, monkeypatch, block, size):
    """Also with groups compared in blocks of few sets, of few bytes, and of fewer bytes than a text has."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", size)
    docs = near_copies(random.Random(3))
    assert sorted(map(tuple, jaccard.report(frame(spark, docs)).collect()), key=repr) == plain_links(docs)


@pytest.mark.parametrize("light", [0, 9, 20])
def test_linked_sets_share_a_key(light):
    rng = np.random.default_rng(light)
    for n in [*range(1, 60), 150, 700]:
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        for cut in range(jaccard.most_deleted(n) + 2):
            for more in range(0, n // 9 + 2):
                b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, more, np.uint64)]))
                if len(b) and jaccard.links(len(a), len(b), len(np.intersect1d(a, b))):
                    assert np.intersect1d(jaccard.keys_of(a, light), jaccard.keys_of(b, light)).size, (n, cut, more)


def test_a_key_leaves_a_block_of_rows_once(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(jaccard, "AT_ONCE", 7)
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join([*base, f"end{i}"]) for i in range(20)] + ["", "one two", " ".join([*base, "end3"]), "quite another text of its own"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], names=["doc_id", "h", "data"])
    parts = list(jaccard._sketch(0, 3, 90)(iter([batch])))
    assert [p.num_rows for p in parts] == [7, 7, 7, 3]
    for p in parts:
        keys = [k for row in p["keys"].to_pylist() for k in set(row)]
        assert len(keys) == len(set(keys))
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    rows = [r for p in parts for r in p.to_pylist()]
    for r in rows:
        for other in [("key", k) for k in r["keys"]] + r["met"]:
            parent[find(other)] = find(r["node"])
    tops = [find(r["node"]) for r in rows]
    assert len(set(tops[:20])) == 1 and tops[22] == tops[0] and len({tops[0], tops[20], tops[21], tops[23]}) == 4
    empty = next(iter(jaccard._sketch(0, 3, 90)(iter([batch.slice(20, 1)]))))
    assert empty["keys"].to_pylist() == [[]] and empty["met"].to_pylist() == [[]]


@pytest.mark.parametrize("percent", [80, 90])
def test_blocks_meet_those_of_sizes_that_link(spark, percent):
    """A block meets each block of its band and of the next ones once, and sizes that link are in such bands."""
    from pyspark.sql import functions as F

    bands = {r.n: r.band for r in spark.range(1, 3000).select(F.col("id").alias("n"), jaccard._band_of(F.col("id"), percent).alias("band")).collect()}
    assert all(band == jaccard._band(n, percent) for n, band in bands.items())
    for n in range(1, 2000):
        assert bands[100 * n // percent] - bands[n] in (0, 1)
    df = spark.createDataFrame([(5, {4: 2, 5: 3, 7: 9}), (7, {4: 2, 5: 3, 7: 1})], "band int, blocks map<int, int>")
    got = [sorted(divmod(x, 2**32) for x in r.p) for r in df.select(jaccard._partners(F.col("band"), F.col("blocks")).alias("p")).collect()]
    assert got == [[(4, 0), (4, 1), (5, 0), (5, 1), (5, 2)], [(7, 0)]]


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    """Long texts that nearly agree, with a short chain beside: no task's pair of blocks holds many times the bound."""
    monkeypatch.setattr(jaccard, "BLOCK_BYTES", 40_000)
    words = [f"w{i}" for i in range(2000)]
    docs = [(i, " ".join(words[:k] + [f"own{i}"] + words[k:])) for i, k in enumerate(range(100, 1900, 45))]
    docs += [(100 + i, " ".join(words[: 700 + 60 * i])) for i in range(15)]
    plain = jaccard._resolve

    def spied(words, percent):
        run = plain(words, percent)

        def counted(batches):
            rows = [b for b in batches]
            for b in rows:
                units = {}
                for r in b.to_pylist():
                    key = (r["grp"], r["one"], r["two"])
                    units[key] = units.get(key, 0) + len(r["data"])
                assert max(units.values(), default=0) < 8 * 40_000, units
            yield from run(iter(rows))

        return counted

    monkeypatch.setattr(jaccard, "_resolve", spied)
    assert sorted(map(tuple, jaccard.report(frame(spark, docs)).collect()), key=repr) == plain_links(docs)


def test_a_common_line_makes_no_large_group(spark, monkeypatch):
    """Texts that have only a line in common share keys, so that they are one group, which grows with the square of the
    corpus if its blocks are compared. By their rarest shingles only near copies stay together; others travel no more."""
    monkeypatch.setattr(jaccard, "BLOCK", 1)
    rng = random.Random(5)
    line = " ".join(f"c{i}" for i in range(22))
    docs = [(i, f"{line} alone {words(rng, 55)}") for i in range(300)]
    near = [f"{line} {words(rng, 55)}" for _ in range(10)]
    docs += [(1000 + 10 * i + k, f"{text} last{k}") for i, text in enumerate(near) for k in range(4)]
    plain = jaccard._resolve

    def spied(words, percent):
        run = plain(words, percent)

        def watched(batches):
            for b in batches:
                assert not [x for x in b.column(7).to_pylist() if b"alone" in x]
                yield from run(iter([b]))

        return watched

    monkeypatch.setattr(jaccard, "_resolve", spied)
    got = {r.doc_id: (r.component_id, r.n_links) for r in jaccard.similar(frame(spark, docs), words=5, percent=80).collect()}
    assert got == {k: (k, 0) if k < 1000 else (k // 10 * 10, 3) for k, _ in docs}


def test_shuffle_files_of_written_tables_go(spark):
    from tideframe.llm.common import written

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    before, grouped = files(), spark.range(1000).groupBy(F.xxhash64("id").alias("h")).count()
    table = written(grouped)
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and table.count() == grouped.count() == 1000


def test_boundary_follows_cost():
    assert jaccard.boundary({5: 100}) >= 5 and jaccard.boundary({20: 1000}) < 18


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (-5, 200)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, -5: -5, 200: -5}


def test_written_tables_can_go(spark, tmp_path, monkeypatch):
    from tideframe.llm import common

    monkeypatch.setattr(common, "_folder", lambda _: f"file://{tmp_path}/tables")
    one, two = common.written(spark.range(3)), common.written(spark.range(4))
    common.discard(one)
    assert two.count() == 4 and common.sweep(spark, 1) == 0 and common.sweep(spark, -1) == 1 and common.sweep(spark, -1) == 0


@pytest.mark.parametrize("name", ["op2_phrase_dedup", "op7_ngram_jaccard"])
def test_sql_twins(spark, name):
    from oracle import connect, same
    from tideframe.llm import queries

    sf = f"{DATA}/sf0.001"
    same(queries.QUERIES[name](spark, sf), connect(sf), queries.ORACLE[name])


def test_passages_and_automata(spark, monkeypatch):
    """Passages are confirmed once, split where documents part, and found by every automaton; nothing else decides."""
    a, b, c = ([f"{x}{i}" for i in range(70)] for x in "abc")
    texts = [" ".join(x).encode() for x in (a + b, a + c, b[:60], ["z"] * 120, ["z"] * 60)]
    passages = phrases.confirmed(texts, [1, 2, 3, 4, 5], [1, 2, 3, 4, 5], 50)
    assert {p.decode(): d for p, d in passages.items()} == {" ".join(a): 1, " ".join(b[:60]): 1, " ".join(["z"] * 50): 4}
    for size in (10**6, 1):  # one automaton, and one for each passage
        found = [sorted(x) for x in phrases.located(passages, texts, size)]
        assert found[0] == [(0, 70, 1), (70, 60, 1)] and found[1] == [(0, 70, 1)] and found[2] == [(0, 60, 1)] and found[4] == [(i, 50, 4) for i in range(11)]
    assert phrases.confirmed(texts, [7] * 5, [7] * 5, 50) == {}  # all of one document
    docs = [(1, "x y " + " ".join(a)), (2, " ".join(a) + " end")]
    assert [r.n_removed for r in phrases.digests(frame(spark, docs)).orderBy("doc_id").collect()] == [0, 70]
    import ahocorasick

    assert issubclass(next(phrases.automata({b"a b": 1}, 9)).__class__, ahocorasick.Automaton)


def test_very_long_texts(spark):
    rng = random.Random(8)
    long_ = words(rng, 30_000)
    docs = [(1, long_), (2, "start " + long_ + " end"), (3, long_[:100_000]), (4, "q" * 300_000), (5, None)]
    df = frame(spark, docs)
    got = {r.doc_id: r for r in phrases.digests(df).collect()}
    assert got[1].n_removed == 0 and got[2].n_removed == 30_000 and got[2].n_words == 30_002 and got[4].n_words == 1
    got = {r.doc_id: r for r in suffixes.digests(df).collect()}
    assert got[1].n_removed == got[1].n_bytes and got[2].n_bytes - got[2].n_removed == len("start  end") and got[4].n_removed == 300_000
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.report(df).collect()}
    assert got[1][1] == got[2][1] == 1 and got[3][1] == 3 and got[5] == (0, 5)


@pytest.mark.parametrize("width", [3, 10])
def test_windows_as_runs(spark, width):
    """Neighbouring windows of a document are one run, also from one batch to the next."""
    rng = random.Random(width)
    places = {(d, h): sorted(rng.sample(range(4000), 900)) for d in (1, 2, None) for h in (-5, 5)}
    rows = [(d, h, s, "x") for (d, h), own in places.items() for s in own]
    rng.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = repeats._joined_up(spark.createDataFrame(rows, "doc_id long, h long, start int, a string"), width, 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for key, own in places.items():
        runs = sorted((r.start, r.n) for r in got if (r.doc_id, r.h) == key)
        covered = {p for s, n in runs for p in range(s, s + n + width - 1)}
        assert covered == {p for s in own for p in range(s, s + width)}
        assert all(b > a + n - 1 + width for (a, n), (b, _) in zip(runs, runs[1:]))


def test_one_letter_over_and_over(spark):
    """All windows of such a text are alike and hot; none of them is held as a row of its own."""
    df = spark.range(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("a"), 4_000_000).alias("text"))
    df = df.unionByName(df.select(F.lit(2).alias("doc_id"), F.concat(F.lit("b "), F.repeat(F.lit("word "), 300_000)).alias("text")))
    got = {r.doc_id: r for r in suffixes.digests(df).collect()}
    assert (got[1].n_bytes, got[1].n_removed, got[1].n_spans) == (4_000_000, 4_000_000, 1)
    assert (got[2].n_bytes - got[2].n_removed, got[2].n_spans) == (1, 1)
    got = {r.doc_id: r for r in phrases.digests(df).collect()}
    assert got[2].n_words == 300_001 and got[2].n_removed == 0

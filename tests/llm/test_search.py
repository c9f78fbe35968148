"""Ranked search against scores of all documents."""

import collections
import math
import random
import re

import numpy as np
import pytest

from conftest import DATA
from oracle import connect, same
from tideframe.llm import queries, search
from tideframe.llm.common import written


def plain_terms(text):
    out = (text or "").translate({b: b + 32 for b in range(0x41, 0x5B)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", out)


def plain_search(docs, items, k):
    """docs: (id, text) rows; items: (id, text) rows."""
    held = [(i, collections.Counter(plain_terms(t)), len(plain_terms(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n, total = len(held), sum(h[2] for h in held)
    df = collections.Counter(t for h in held for t in h[1])
    out = []
    for item, text in sorted(set(items), key=repr):
        asked = collections.Counter(plain_terms(text))
        scores = []
        for i, own, length in held:
            m = 100 - 75 + (75 * length * n) // total
            s = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * own[t]) // (1000 * own[t] + 8 * m)) for t, times in asked.items() if t in own)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def test_terms():
    text = "Ab1_c-É x y\t\x7fZ0 ß\n'İstanbul'"
    assert [t.decode() for t in search.terms_of(text.encode())] == plain_terms(text) == ["ab1", "c", "É", "x y", "z0", "ß", "İstanbul"]


@pytest.mark.parametrize("size,per_pass,width", [(40, 5, 1), (400, 1_000_000, 3), (10**6, 40, 16)])
def test_against_all_scores(spark, size, per_pass, width):
    draw = random.Random(size)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(draw.choices(words, [1 / (i + 1) for i in range(60)], k=draw.choice([1, 3, 10, 40]))) for _ in range(150)]
    docs = [(draw.randrange(1000), t) for t in texts] + [(i, texts[0]) for i in range(2000, 2060)] + [(None, texts[1]), (None, texts[1]), (5, texts[2]), (5, texts[2]), (6, None), (7, ""), (8, "!?"), (9, "w1 " * 3000)]
    items = [(i, " ".join(draw.choices(words, k=12))) for i in range(12)] + [(1, "w0 w1 w0"), (None, "w3 W3 w5"), (None, "w3 W3 w5"), (50, None), (51, ""), (52, "unknown"), (53, texts[0]), (54, " ".join(words))]
    table = spark.createDataFrame([(b"", t, i, "x") for i, t in docs], "term binary, text string, doc_id long, shard string").repartition(3)
    asked = spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id long, rank int")
    lists = search.index(table, size=size)
    assert lists.filter("term IS NULL").count() >= (10 if size == 40 else 1)
    got = sorted(map(tuple, search.search(lists, asked, k=10, width=width, per_pass=per_pass).collect()), key=repr)
    assert got == plain_search(docs, items, 10)
    assert len({(r[0], r[1]) for r in got if r[0] not in (1, None)}) == len([r for r in got if r[0] not in (1, None)])


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in search.ranked(docs, items).collect()] == plain_search([(1, "a b")], [(1, "a")], 10)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.filter("doc_id > 5"), items)):
        assert search.ranked(d, i).columns == ["item_id", "rank", "doc_id", "score"]
        assert search.ranked(d, i).count() == 0


def shard(lengths, lists):
    return search.Treaps([(np.array(p), np.array(c)) for p, c in lists], 25 + 75 * np.array(lengths) // 10)


def test_treaps_are_trees_and_heaps():
    draw = np.random.default_rng(3)
    n = 500
    lists = [(np.sort(draw.choice(n, size, replace=False)), draw.integers(1, 4, size)) for size in (1, 2, 37, 500)]
    treaps = shard(draw.integers(1, 30, n), lists)

    def nodes(i, low, high):
        if i < 0:
            return []
        assert low <= treaps.place[i] < high
        for child in (treaps.left[i], treaps.right[i]):
            assert child < 0 or treaps.impact[child] <= treaps.impact[i]
        return nodes(treaps.left[i], low, treaps.place[i]) + [treaps.place[i]] + nodes(treaps.right[i], treaps.place[i] + 1, high)

    for root, (places, _) in zip(treaps.root, lists):
        assert nodes(root, 0, n) == places.tolist()


@pytest.mark.parametrize("lengths", [[7] * 5000, list(range(1, 5001)), list(range(5000, 0, -1))])
def test_subtrees_are_pruned(lengths):
    n = len(lengths)
    rare = np.arange(100, n, 1000)
    treaps = shard(lengths, [(np.arange(n), np.ones(n, int)), (rare, np.full(len(rare), 3))])
    best, none, ids = search.Best(1, 3), np.zeros(n, bool), np.arange(n) * 2
    scored = search.walk(treaps, np.array([0, 0]), treaps.root, np.array([700, 9000]), none, ids, best)
    m = 25 + 75 * np.array(lengths) // 10
    score = 700 * (10**9 // (1000 + 8 * m))
    score[rare] += 9000 * (3 * 10**9 // (3000 + 8 * m[rare]))
    want = sorted(zip(-score, ids))[:3]
    assert sorted(zip(-best.score, best.id)) == want
    assert scored < n // 10
    # equal scores of a later shard count only before the last one's id
    again = search.walk(treaps, np.array([0, 0]), treaps.root, np.array([700, 9000]), none, ids + 2 * n, best)
    assert sorted(zip(-best.score, best.id)) == sorted([*zip(-score, ids), *zip(-score, ids + 2 * n)])[:3]
    assert again <= (3 if len(set(lengths)) == 1 else n // 10)


def test_sql_twin(spark):
    same(queries.QUERIES["op11_ranked_search"](spark, f"{DATA}/sf0.001"), connect(f"{DATA}/sf0.001"), queries.ORACLE["op11_ranked_search"])

"""What the first round of advice found missing."""

import collections
import random
import re
import time

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tideframe.llm import jaccard, licences, templates
from test_dedup import near_copies


def plain_near(docs, words=5, percent=80):
    """doc_ids of the documents that are the least of their component, or have no word."""
    sets = []
    for _, t in docs:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else []))
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                lo, hi = sorted((find(i), find(j)), key=lambda k: docs[k][0])
                parent[hi] = lo
    return {d for i, (d, _) in enumerate(docs) if find(i) == i}


def test_pipeline_drops_near_copies_of_five_words_and_80_percent(spark):
    import corpus_pipeline

    docs = [(i, t) for i, t in near_copies(random.Random(11)) if i is not None]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert plain_near(docs) != plain_near(docs, 3, 90)
    assert {r.doc_id for r in corpus_pipeline.one_of_near_copies(spark, df, "").collect()} == plain_near(docs)


@pytest.mark.parametrize("light", [0, 9, 20])
def test_sets_linked_at_80_percent_share_a_key(light):
    rng = np.random.default_rng(light)
    for n in [*range(1, 25), 60, 150, 700]:
        a = np.unique(rng.integers(0, 2**63, n, np.uint64))
        for cut in range(0, jaccard.most_deleted(n, 80) + 2, 1 + n // 50):
            for more in range(0, n // 4 + 2, 1 + n // 50):
                b = np.unique(np.concatenate([a[cut:], rng.integers(0, 2**63, more, np.uint64)]))
                if len(b) and jaccard.links(len(a), len(b), len(np.intersect1d(a, b)), 80):
                    assert np.intersect1d(jaccard.keys_of(a, light, 80), jaccard.keys_of(b, light, 80)).size, (n, cut, more)


@pytest.mark.parametrize("size,percent", [(300, 80), (300, 90), (60, 90), (1500, 90)])
def test_empty_parts_are_no_keys_of_strangers(size, percent):
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, size, np.uint64)) for _ in range(3000 if size < 1000 else 300)]
    keys = np.concatenate([np.unique(jaccard.keys_of(s, 9, percent)) for s in sets])
    assert len(np.unique(keys)) == len(keys)


def test_licences_inside_longer_texts():
    scan = licences.Scanner(licences.TEMPLATES, licences.THRESHOLD).scan
    mit = next(t for n, t in licences.TEMPLATES if n == "MIT" and len(t) > 200)
    one, two = mit.index("The above copyright"), mit.index("THE SOFTWARE IS")
    paragraphs = f"{mit[:one]}\n\n{mit[one:two]}\n\n{mit[two:]}"
    code = "\n\n".join(f"def f{i}(x):\n    return x + {i} * y{i}" for i in range(60))
    [(name, dice, lo, hi)] = scan(f"Title of it\n\n{paragraphs}\n\n{code}")
    assert (name, lo, hi) == ("MIT", 2, 6) and dice > 0.99
    assert [*scan("Copyright 2020 Acme Inc. All rights reserved.")] == [("all-rights-reserved", 1.0, 0, 0)]
    assert [*scan("Licensed under CC BY-SA 4.0.")] == [("CC-BY-SA-4.0", 1.0, 0, 0)]
    assert [*scan("So this is licensed under CC BY 3.0 by its author.")] == []
    assert [x[0] for x in scan("All rights reserved." + " " * 30000)] == ["all-rights-reserved"]
    for other in ("Licensed under the Apache License, Version 1.1", "This work is licensed under the GNU General Public License, version 1.", "This work is licensed under the Creative Commons Attribution 2.5 International License."):
        assert [*scan(other)] == [], other
    assert [x[0] for x in scan("This work is licensed under a Creative Commons Attribution 3.0 Unported License.")] == ["CC-BY-3.0"]
    [(name, dice, *_)] = scan("word " * 200_000 + "Released under the MIT License. " + "-" * 20_000 + " more" * 100_000)
    assert name == "MIT" and dice == 1.0
    cut = mit[: mit.rindex("IN NO EVENT")]  # a shorter copy, whole sentences
    assert [x[0] for x in scan(f"{code}\n\n{cut[:one]}\n\n{cut[one:]}\n\n{code}")] == ["MIT"]


def test_templates_dense_in_numbers_and_first_words(spark):
    bench = spark.createDataFrame([(1, "Find the next term: 2 4 8 16 32 64"), (2, "What is the boiling point of water?")], "item_id long, text string")
    docs = [(1, "Find the next term: 3 6 12 24 48 96"), (2, "Find the next term: 3 6 12 12 48 96"), (3, "Question 3 What is the boiling point of water?"), (4, "What is the boiling point of water?")]
    got = {(r.doc_id, r.item_id, r.copied) for r in templates.report(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1, False), (3, 2, True), (4, 2, True)}


def plain_windows(scanner, text):
    """Every window of every template, the best first, each counted by itself."""
    lines = text.split("\n")
    words, starts, ends = [], set(), set()
    for line in lines:
        at = len(words)
        own = licences._WORDS.findall(line.lower())
        if own:
            starts.add(at)
            ends.add(at + len(own) - 1)
        for x in re.finditer(r"[.!?:;]+(?=\s)", line.lower()):
            n = at + len(licences._WORDS.findall(line.lower()[: x.end()]))
            starts.add(n)
            ends.add(n - 1)
        words += own
    pairs = [*zip(words, words[1:])]
    found = []
    for i, (_, template) in enumerate(scanner.templates):
        m = template.total()
        for lo in range(len(pairs)):
            for hi in range(lo, min(len(pairs), lo + int(m * 1.5 + 1e-9))):
                n, both = hi - lo + 1, (collections.Counter(pairs[lo : hi + 1]) & template).total()
                if 2 * both >= scanner.threshold * (n + m) and (n >= m or lo in starts and hi + 1 in ends) and scanner.versions[i] <= set(words[lo : hi + 2]):
                    found.append((-2 * both / (n + m), i, lo, hi))
    out, taken = [], set()
    for d, i, lo, hi in sorted(found):
        if taken.isdisjoint(range(lo, hi + 2)):
            taken.update(range(lo, hi + 2))
            out.append((-d, i, lo, hi))
    return out, pairs, starts, ends


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["released", "under", "the", "mit", "license", "license 1.0", "apache", "2.0", "all rights", "reserved", ".\n", ". ", "\n\n", "x y"]), max_size=45))
def test_windows_against_all_windows(parts):
    scanner = licences.Scanner([("A", "Released under the MIT license"), ("B", "Released under the Apache license 2.0 the license"), ("C", "all rights reserved")], 0.8)
    text = " ".join(parts)
    want, pairs, starts, ends = plain_windows(scanner, text)
    assert scanner.windows(pairs, scanner.dense(pairs), starts, ends) == want


def test_a_megabyte_of_licences_is_read_in_seconds():
    mit = next(t for n, t in licences.TEMPLATES if n == "MIT" and len(t) > 200)
    scanner = licences.Scanner(licences.TEMPLATES, licences.THRESHOLD)
    began = time.process_time()
    found = [*scanner.scan(" ".join([mit] * (1_000_000 // len(mit))))]
    assert time.process_time() - began < 12
    assert sum(name == "MIT" and dice == 1.0 for name, dice, *_ in found) == 1_000_000 // len(mit)

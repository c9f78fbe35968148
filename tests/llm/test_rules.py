"""The rule ensemble against plain counts, plain rules and held-out labels."""

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import DATA
from tideframe.llm import queries, rules

W = r"[^\x20\x09-\x0D]+"


def plain_statistics(text):
    t = text or ""
    w, lines = re.findall(W, t), [x for x in t.split("\n") if re.search(W, x)]
    pairs = [*zip(w, w[1:])]
    n, chars = len(w), len(t)
    count = lambda cs: sum(t.count(c) for c in cs)
    per = lambda a, b: a / b if b else 0.0
    return {
        "words": float(n), "word_chars": per(sum(map(len, w)), n), "upper": per(sum("A" <= c <= "Z" for c in t), chars), "digits": per(sum("0" <= c <= "9" for c in t), chars),
        "stops": per(count(".,;:?"), n), "exclamations": per(count("!"), n), "symbols": per(count("#*$%&|<>"), n), "bars": per(count("|"), n), "brackets": per(count("{}[]()=_\\/~^"), n),
        "beyond_ascii": per(len(t.encode()) - chars, chars), "distinct_words": per(len(set(w)), n), "distinct_pairs": per(len(set(pairs)), len(pairs)),
        "echoes": per(sum(a == b for a, b in pairs), n), "line_words": per(n, len(lines)), "repeated_lines": per(len(lines) - len(set(lines)), len(lines)),
    }


TEXTS = [None, "", " \n\t", "One", "One one One", "A!! B!! | c # d\nA!! B!! | c # d\n\n", "été 12 été\x0bété; {x}=[y]\\/~^_(z)", "x" * 5000, "<P> " * 300, "a b c"]


def test_statistics(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(TEXTS)], "doc_id long, text string, words double")
    got = {r["doc_id"]: r.asDict() for r in rules.statistics(docs, {"doc_id": F.col("doc_id")}).collect()}
    for i, t in enumerate(TEXTS):
        want = plain_statistics(t)
        assert [*want] == rules.STATISTICS
        assert {k: got[i][k] for k in want} == pytest.approx(want), t


@pytest.fixture(scope="module")
def rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    return rules.labelled(rules.statistics(docs, {"doc_id": F.col("doc_id")}), labels)


def test_paths_are_the_trees(spark, rows):
    from pyspark.ml.classification import DecisionTreeClassifier

    own = rows.select("label", rules._vector([F.col(s) for s in rules.STATISTICS]).alias("features"), *rules.STATISTICS)
    tree = DecisionTreeClassifier(labelCol="label", maxDepth=4).fit(own)
    found = [*rules.paths(tree._call_java("rootNode"), rules.STATISTICS)]
    assert len(found) == tree.numNodes - 1
    # each row follows as many paths as its leaf is deep: its path's rules are those of the nodes on its way
    out = tree.transform(own).select(*rules.STATISTICS, sum((r.column() for r in found), F.lit(0.0)).alias("n"), *[r.column().alias(f"r{i}") for i, r in enumerate(found)], "probability").collect()
    by_path = {}
    for r in out:
        held = tuple(i for i in range(len(found)) if r[f"r{i}"])
        assert held == tuple(i for i, rule in enumerate(found) if rule.holds(r.asDict()))
        assert 1 <= r["n"] <= 4
        by_path.setdefault(held, set()).add(tuple(r["probability"]))
    assert all(len(p) == 1 for p in by_path.values())  # one leaf for each set of rules


def test_lasso_and_compiled_score(rows):
    model = rules.fit(rows)
    assert 0 < len(model.weights) <= 60
    assert all(1 <= len(r.bounds) <= rules.DEPTH for r, _ in model.weights)
    got = rows.select("label", *rules.STATISTICS, model.score().alias("score")).collect()
    for r in got:
        odds = model.intercept + sum(w for rule, w in model.weights if rule.holds(r.asDict()))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-12)
    # at a lasso's optimum the gradient of each weight in use, in standard units, is as large as the penalty
    y = np.array([r["label"] for r in got])
    miss = np.array([r["score"] for r in got]) - y
    assert abs(miss.mean()) < 1e-3
    for rule, weight in model.weights:
        x = np.array([rule.holds(r.asDict()) for r in got], float)
        if abs(weight) > 1e-6:
            gradient = (miss * x).mean() / x.std(ddof=1)
            assert gradient == pytest.approx(-math.copysign(rules.PENALTY, weight), abs=2e-4)
    assert rules.fit(rows) == model


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    out = queries.QUERIES["op12_quality_classifier"](spark, f"{DATA}/sf0.01")
    assert out.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == docs.count()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    aside = [(truth[i], r) for i, r in got.items() if r["held_out"] and i in truth]
    assert len(aside) > 50
    assert np.mean([q == r["predicted"] for q, r in aside]) > 0.97
    assert all(r["predicted"] for q, r in aside if q == 1)


def test_held_out_labels_language_and_source_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.001/{n}.parquet") for n in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    others = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert sorted(map(tuple, rules.classify(docs, labels).collect())) == sorted(map(tuple, rules.classify(others, turned).collect()))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, 0.5, True) for i, t in enumerate(TEXTS)] + [(None, "no id", 0.5, True)] * 2 + [(3, "One", 0.1, False)] * 2, "doc_id long, text string, score double, held_out boolean")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in rules.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(i, 1, 0) for i in range(8)] + [(1, 0, 0), (None, 0, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    out = rules.classify(docs, one).collect()
    assert len(out) == len(TEXTS) + 4 and len({r["score"] for r in out}) == 1 and out[0]["score"] > 0.5
    # nothing tells these labels apart
    same = spark.createDataFrame([(i, "alike") for i in range(40)], "doc_id long, text string")
    both = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert len({r["score"] for r in rules.classify(same, both).collect()}) == 1
    assert rules.classify(docs.limit(0), one).count() == 0


def test_very_long_text(spark):
    docs = spark.range(1).select(F.lit(1).alias("doc_id"), F.repeat(F.lit("Word one. "), 400_000).alias("text"))
    assert rules.statistics(docs, {"doc_id": F.col("doc_id")}).first()["words"] == 800_000


def test_sample_is_bounded(spark, rows):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    some = rules.labelled(rules.statistics(docs, {"doc_id": F.col("doc_id")}), labels, sample=100)
    assert 60 < some.count() < 140 < rows.count()

"""Quality classifier: a sparse ensemble of rules over plain statistics of a text.

Shallow trees are grown over the statistics of labelled documents; every path from a root is a rule, a conjunction of
bounds on statistics. A logistic regression with a lasso penalty weighs the rules and leaves most out. The rest are
compiled into one Spark expression, so that documents are scored without Python. Statistics are read off each whole text
once and kept in a small table, which trees, weights and scores are made from.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tideframe.llm.common import written
from tideframe.llm.quality import hashes_of, lines_of, pairs_of, symbols, words_of

#: About so many labelled rows are learned from at most: those of the least hashes of their ids.
SAMPLE = 200_000
#: Trees, their depth, the share of statistics that a node may choose from, and rows that a leaf must hold.
TREES, DEPTH, CHOICE, LEAF = 20, 3, "onethird", 3
#: Weight of the lasso penalty, and the score from which on a document counts as good.
PENALTY, THRESHOLD = 0.001, 0.3
SEED = 11

STATISTICS = [
    "words", "word_chars", "upper", "digits", "stops", "exclamations", "symbols", "bars", "brackets", "beyond_ascii", "distinct_words", "distinct_pairs", "echoes", "line_words", "repeated_lines",
]


def _per(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(0.0)


def _occurrences(text: Column, chars: str) -> Column:
    """How many of some ASCII characters a text has."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def statistics(docs: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """keep, and STATISTICS (double) of every whole text. A null text counts as empty, whose statistics are all 0.

    Steps that later ones build on are projections of their own, so that they are made once.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    out = docs.select(F.struct(*[c.alias(n) for n, c in keep.items()]).alias("keep"), text.alias("t"))
    out = out.select("keep", "t", words_of(F.col("t")).alias("w"), lines_of(F.col("t")).alias("l"))
    out = out.select("keep", "t", "l", hashes_of(F.col("w")).alias("h"), F.length(F.array_join("w", "")).alias("c"))
    out = out.select("*", pairs_of(F.col("h")).alias("p"))
    n, t, chars = F.size("h"), F.col("t"), F.length("t")
    made = {
        "words": n.cast("double"),
        "word_chars": _per(F.col("c"), n),
        "upper": _per(F.regexp_count(t, F.lit("[A-Z]")), chars),
        "digits": _per(F.regexp_count(t, F.lit("[0-9]")), chars),
        "stops": _per(_occurrences(t, ".,;:?"), n),
        "exclamations": _per(_occurrences(t, "!"), n),
        "symbols": _per(symbols(t), n),
        "bars": _per(_occurrences(t, "|"), n),
        "brackets": _per(_occurrences(t, "{}[]()=_\\/~^"), n),
        "beyond_ascii": _per(F.octet_length(t) - chars, chars),
        "distinct_words": _per(F.size(F.array_distinct("h")), n),
        "distinct_pairs": _per(F.size(F.array_distinct("p")), F.size("p")),
        "echoes": _per(F.size(F.filter("h", lambda x, i: (i > 0) & (F.get(F.col("h"), i - 1) == x))), n),
        "line_words": _per(n, F.size("l")),
        "repeated_lines": _per(F.size("l") - F.size(F.array_distinct("l")), F.size("l")),
    }
    return out.select(*[F.col(f"keep.{k}") for k in keep], *[made[s].alias(s) for s in STATISTICS])


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: each (statistic, low, high) holds if low < value <= high; None leaves a side open."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        """1.0 where the rule holds, else 0.0."""
        holds = [c for name, low, high in self.bounds for c in ([F.col(name) > low] if low is not None else []) + ([F.col(name) <= high] if high is not None else [])]
        every = holds[0]
        for c in holds[1:]:
            every = every & c
        return every.cast("double")

    def holds(self, row: dict[str, float]) -> bool:
        return all((low is None or row[name] > low) and (high is None or row[name] <= high) for name, low, high in self.bounds)


@dataclass(frozen=True)
class Ensemble:
    """What a fit gives: the rules with a weight other than 0, and the log odds without any."""

    weights: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self) -> Column:
        """The chance of label 1, of the statistics of a row."""
        odds = F.lit(self.intercept)
        for rule, weight in self.weights:
            odds = odds + F.lit(weight) * rule.column()
        return 1 / (1 + F.exp(-odds))


def paths(root, names: list[str]) -> Iterable[Rule]:
    """A rule for each path from a tree's root, to inner nodes too; bounds on one statistic are put together."""
    stack = [(root, {})]
    while stack:
        node, bounds = stack.pop()
        if bounds:
            yield Rule(tuple(sorted((name, low, high) for name, (low, high) in bounds.items())))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            name, at = names[split.featureIndex()], split.threshold()
            low, high = bounds.get(name, (None, None))
            stack.append((node.leftChild(), bounds | {name: (low, at if high is None else min(at, high))}))
            stack.append((node.rightChild(), bounds | {name: (at if low is None else max(at, low), high)}))


def _vector(columns: list[Column]) -> Column:
    return array_to_vector(F.array(*columns))


def fit(rows: DataFrame, seed: int = SEED) -> Ensemble:
    """The ensemble of rows that have STATISTICS and a label of 0 or 1. With one label only, its smoothed share counts for
    every document."""
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    bad, good = counts.get(0.0, 0), counts.get(1.0, 0)
    if not bad or not good:
        return Ensemble((), log((good + 1) / (bad + 1)))
    rows = rows.select("label", _vector([F.col(s) for s in STATISTICS]).alias("features"), *STATISTICS)
    forest = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, featureSubsetStrategy=CHOICE, bootstrap=False, minInstancesPerNode=LEAF, maxBins=64, seed=seed).fit(rows)
    rules = sorted({rule for tree in forest.trees for rule in paths(tree._call_java("rootNode"), STATISTICS)}, key=repr)
    if not rules:  # no statistic tells the labels apart
        return Ensemble((), log((good + 1) / (bad + 1)))
    held = rows.select("label", _vector([r.column() for r in rules]).alias("features"))
    lasso = LogisticRegression(featuresCol="features", labelCol="label", regParam=PENALTY, elasticNetParam=1.0, maxIter=100, tol=1e-6).fit(held)
    return Ensemble(tuple((r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w), float(lasso.intercept))


def labelled(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """STATISTICS and label of the rows of stats that have one, about `sample` at most; a document with both labels has none."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("known")).agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
    known = known.filter("low = high AND low IN (0, 1)").select("known", F.col("low").cast("double").alias("label"))
    rows = written(stats.join(known, F.col("doc_id").cast("long") == F.col("known")).select("label", *STATISTICS, F.xxhash64("known").alias("h")))
    share = min(1.0, sample / max(1, rows.count()))
    return rows.filter(F.pmod("h", F.lit(1 << 32)) < int(share * (1 << 32))).drop("h")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, learned from those that are not held out.

    A document is held out if crc32 of its id as text (of an empty text for a null id) is divisible by 5; a document
    without an id, without a label or with both is not learned from. Null and empty texts are scored like others, by
    statistics that are 0; repeated rows alike; a text of any length whole. Without labels every score is 0.5; an empty
    table gives no rows; other columns are not read.
    """
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    stats = written(statistics(docs, {"doc_id": F.col("doc_id"), "held_out": held}))
    model = fit(labelled(stats.filter("NOT held_out"), labels))
    return stats.select("doc_id", "held_out", model.score().alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

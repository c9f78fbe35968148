"""Language identification by multinomial logistic regression on TF-IDF character n-grams.

Document frequencies come from all training documents. The weights are fitted on a bounded sample of them with
follow-the-regularised-leader and elastic-net penalties, which leave most weights at zero; a temperature, fitted on
sampled rows that the weights have not seen, then calibrates the probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

#: Buckets of hashed n-grams of 1 to 3 characters.
BUCKETS = 1 << 14
#: At most so many labelled rows are fitted on: those of the least hash of their text.
SAMPLE = 4000
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.5, 1.0, 0.02, 0.02

_LETTER = np.full(0x110000, 2, np.uint8)


def _letters(codes: np.ndarray) -> np.ndarray:
    kinds = _LETTER[codes]
    if (kinds == 2).any():
        for c in np.unique(codes[kinds == 2]).tolist():
            _LETTER[c] = regex.match(r"\p{L}", chr(c)) is not None
        kinds = _LETTER[codes]
    return kinds.astype(bool)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of the n-grams of a text's lower-case letters, with a space for whatever stands between them;
    None if there is no letter."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    letter = _letters(codes)
    if not letter.any():
        return None
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    c = np.concatenate([[32], np.where(letter, codes, 32)[keep], [32]]).astype(np.uint64)
    two = c[:-1] * np.uint64(0x9E3779B1) + c[1:]
    three = two[:-1] * np.uint64(0x85EBCA77) + c[2:]
    h = np.concatenate([c, two * np.uint64(0xC2B2AE3D27D4EB4F), three * np.uint64(0x9E3779B97F4A7C15)])
    h = (h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(50)
    counts = np.bincount(h.astype(np.int64), minlength=BUCKETS)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weighted(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / (np.sqrt((x * x).sum()) or 1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow-the-regularised-leader for a softmax over classes; lazily the weights of the buckets at hand."""

    def __init__(self, classes: int):
        self.z, self.n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def fit(rows: list[tuple[np.ndarray, np.ndarray, str]], idf: np.ndarray) -> tuple[list[str], np.ndarray, float]:
    """Languages, weights (bucket by language) and temperature from (buckets, counts, language) in a fixed order."""
    langs = sorted({lang for *_, lang in rows})
    data = [(at, weighted(at, n, idf), langs.index(lang)) for at, n, lang in rows]
    aside = data[::5] if len(data) >= 50 else data
    model = Ftrl(len(langs))
    order = np.random.default_rng(7)
    own = [d for i, d in enumerate(data) if i % 5] if len(data) >= 50 else data
    for _ in range(EPOCHS):
        for i in order.permutation(len(own)).tolist():
            model.learn(*own[i])
    w = model.weights(slice(None))
    logits = np.array([x @ w[at] for at, x, _ in aside])
    labels = np.array([label for *_, label in aside])

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-300).mean()

    grid = np.exp(np.linspace(np.log(0.02), np.log(20), 300))
    return langs, w, float(min(grid, key=loss))


def _schema(df: DataFrame) -> tuple[Column, Column]:
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 == 0
    return held, F.col("text").cast("string")


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """Languages, idf, weights and temperature from docs (text, lang), all of which may be learned from."""
    docs = docs.filter("text IS NOT NULL AND lang IS NOT NULL")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                got = features(text.as_py())
                if got:
                    df[got[0]] += 1
                    df[BUCKETS] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(df[at], pa.int64())], names=["b", "n"])

    counts = np.zeros(BUCKETS + 1)
    for row in docs.select("text").mapInArrow(frequencies, "b int, n long").groupBy("b").agg(F.sum("n").alias("n")).collect():
        counts[row["b"]] = row["n"]  # one row a bucket
    idf = np.log((1 + counts[-1]) / (1 + counts[:-1])) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [features(t.as_py()) for t in batch.column(1)]
            keep = pa.array([x is not None for x in own], pa.bool_())
            at = pa.array([x and x[0].tolist() for x in own], pa.list_(pa.int32()))
            n = pa.array([x and x[1].tolist() for x in own], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), at, n, batch.column(2)], names=["h", "at", "n", "lang"]).filter(keep)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(((h, np.array(at), np.array(n), lang) for b in batches for h, at, n, lang in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        if rows:
            langs, w, temperature = fit([r[1:] for r in rows], idf)
            yield pa.RecordBatch.from_pylist([{"langs": langs, "w": w.astype("<f4").tobytes(), "t": temperature}])

    # a share of the distinct texts that gives about SAMPLE, by hash, before any order is made; buckets and counts of
    # their n-grams travel, which are bounded however long a text is
    own = docs.filter(F.col("text").rlike(r"\p{L}")).select(F.xxhash64("text", "lang").alias("h"), "text", "lang")
    distinct = own.agg(F.approx_count_distinct("h", 0.02)).first()[0]
    share = min(1.0, 1.2 * SAMPLE / max(1.0, distinct))
    own = own.filter(F.pmod("h", F.lit(1 << 32)) < int(share * (1 << 32)))
    sample = own.mapInArrow(counted, "h long, at array<int>, n array<int>, lang string").dropDuplicates(["h"]).orderBy("h").limit(SAMPLE)
    got = sample.coalesce(1).mapInArrow(learn, "langs array<string>, w binary, t double").collect()
    if not got:
        return [], idf, np.zeros((BUCKETS, 0)), 1.0
    langs = list(got[0]["langs"])
    return langs, idf, np.frombuffer(got[0]["w"], "<f4").reshape(BUCKETS, len(langs)).astype(float), got[0]["t"]


def predict(docs: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score, from text_col alone; `und` and 0 for a text that is null or has no letter."""
    names = docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, idf, w, temperature = shared.value
        for batch in batches:
            preds, scores = [], []
            for text in batch.column(names.index(text_col)):
                got = features(text.as_py()) if langs else None
                if got:
                    p = softmax(weighted(*got, idf) @ w[got[0]] / temperature)
                    best = int(p.argmax())
                    preds.append(langs[best])
                    scores.append(float(p[best]))
                else:
                    preds.append("und")
                    scores.append(0.0)
            kept = [c for c, n in zip(batch.columns, names) if n != text_col]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(preds, pa.string()), pa.array(scores, pa.float64())], names=[*[n for n in names if n != text_col], "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col)
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document, learned from those that are not held out.

    A document is held out if crc32 of its id as text (of an empty text for a null id) is divisible by 5. Repeated rows
    are predicted alike. Without anything to learn from every prediction is `und`. A text of any length is read whole. An
    empty table gives no rows. Other columns are not read.
    """
    held, text = _schema(docs)
    own = docs.select("doc_id", text.alias("text"), "lang", held.alias("held_out"))
    model = train(own.filter("NOT held_out").select("text", F.col("lang").cast("string").alias("lang")))
    return predict(own.select("doc_id", "held_out", "text"), model)

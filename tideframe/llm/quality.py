"""Quality rules: plain counts of a text, and a hashed n-gram log-likelihood ratio of trusted text against the corpus.

Only DataFrame functions. Two passes over the texts: the first counts hashed words and word pairs of all documents and
of the trusted ones in a fixed number of buckets; the second averages the buckets' weights over each document. The
weights are one array, as long as there are buckets whatever the corpus, which the second pass gets as a scalar subquery,
so that a document's n-grams never leave its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tideframe.llm.common import SPACE, quoted, written

BUCKETS = 1 << 18
#: Trusted ids that are broadcast; more of them are joined by a shuffle.
BROADCAST = 1_000_000
#: Added to both sides of a ratio of counts. A ratio is shrunk to half of it where it stands so many standard deviations
#: from what chance gives, less than that for more and nearly to 0 for few.
PRIOR, SURE = 5.0, 6.0
#: A document stays if its mean weight is at least this; so many n-grams of weight 0 are added to its own, so that a few
#: words alone don't condemn a short text.
THRESHOLD, SHRINK = -0.007, 100
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, though body may use it in lambdas and many times."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; none of a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def pairs_of(hashes: Column) -> Column:
    """A hash of each word with the next one; none for the last word."""
    n = F.greatest(F.size(hashes) - 1, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(2), n), lambda a, b: F.xxhash64(a, b))


def windows_of(hashes: Column, pairs: Column) -> Column:
    """A hash of each five words in a row."""
    n = F.greatest(F.size(hashes) - 4, F.lit(0))
    return F.transform(F.slice(pairs, F.lit(1), n), lambda p, i: F.xxhash64(p, F.get(pairs, i + 2), F.get(hashes, i + 4)))


def repeat_words(keys: Column, width: int = 5) -> Column:
    """How many words lie in a window of `width` words that stands twice or more among the keys of all windows."""

    def covered(spots: Column) -> Column:
        gaps = F.transform(spots, lambda p, i: F.when(i + 1 < F.size(spots), F.least(F.lit(width), F.get(spots, i + 1) - p)).otherwise(width))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    spots = let(
        F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i")))),
        lambda s: F.sort_array(
            F.transform(
                F.filter(s, lambda x, i: ((i > 0) & (F.get(s, i - 1)["k"] == x["k"])) | ((i + 1 < F.size(s)) & (F.get(s, i + 1)["k"] == x["k"]))),
                lambda x: x["i"],
            )
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(let(spots, covered))


def lines_of(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def symbols(text: Column) -> Column:
    """How many of the characters #*$%&|<> a text has; they are one byte each."""
    rest = text = F.coalesce(text, F.lit(""))
    for c in "#*$%&|<>":
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def _grammed(df: DataFrame, text_col: str, keep: list[str], base: bool) -> DataFrame:
    """keep (a struct of those columns), h and p (hashes of words and word pairs); with base the base counts besides.

    Each step is a projection of its own, so that what it makes is made once.
    """
    text = F.col(text_col).cast("string")
    plain = {"sym": symbols(text), "lines": lines_of(text)} if base else {}
    out = df.select(F.struct(*[quoted(c) for c in keep]).alias("keep"), words_of(text).alias("w"), *[c.alias(n) for n, c in plain.items()])
    counts = {"n_words": F.size("w"), "word_chars": F.length(F.array_join("w", "")), "n_symbols": F.col("sym"), "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines"))} if base else {}
    out = out.select("keep", hashes_of(F.col("w")).alias("h"), *[c.cast("long").alias(n) for n, c in counts.items()])
    out = out.select("*", pairs_of(F.col("h")).alias("p"))
    if not base:
        return out
    out = out.select("*", windows_of(F.col("h"), F.col("p")).alias("k"))
    out = out.select("*", repeat_words(F.col("k")).alias("n_repeat_words")).drop("k")
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def bucket_weights(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """bucket int, weight double: the log-likelihood ratio of each bucket that all of docs give.

    trusted has the ids of trusted documents, all of which count. With no trusted document all weights are 0.
    """
    ids = written(trusted.select(F.col(id_col).cast("long").alias("_trusted")).dropna().distinct())
    ids = F.broadcast(ids) if ids.count() <= BROADCAST else ids
    marked = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(ids, F.col("_id") == F.col("_trusted"), "left")
    marked = marked.select(F.col("_trusted").isNotNull().cast("long").alias("t"), "_text")
    grams = _grammed(marked, "_text", ["t"], base=False).select("keep.t", F.explode(F.concat("h", "p")).alias("g"))
    counts = written(grams.select("t", _bucket(F.col("g")).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), F.sum("t").alias("t")))
    total = counts.agg(F.sum("c").alias("c"), F.sum("t").alias("t")).first()
    share = F.lit((total["t"] or 0) / (total["c"] or 1))
    expected = F.col("c") * share
    gap = F.pow(F.col("t") - expected, 2)
    noise = SURE**2 * expected * (1 - share)  # both are 0 where nothing or all is trusted, and then so is the ratio
    return counts.select("bucket", F.when(gap == 0, 0.0).otherwise(F.log((F.col("t") + PRIOR) / (expected + PRIOR)) * gap / (gap + noise)).alias("weight"))


def _array(weights: DataFrame) -> Column:
    """The weights by bucket, as a scalar: one row of as many numbers as there are buckets."""
    every = weights.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(weights, "bucket", "left").select(F.struct("bucket", F.coalesce("weight", F.lit(0.0)).cast("float").alias("w")).alias("x"))
    return dense.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["w"]).alias("w")).scalar()


def scored(docs: DataFrame, weights: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """keep (a struct of the columns of docs that it names, all by default), the base counts, `score` (shrunk mean weight
    of a document's words and word pairs) and `kept`.

    Repeated rows stay apart; a null text counts as empty, and a text without words scores 0.
    """
    rows = _grammed(docs, text_col, docs.columns if keep is None else keep, base=True)
    table = _array(weights)

    def total(of: str, w: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda a, g: a + F.get(w, _bucket(g)))

    # the optimiser puts the subquery where it is used once, so that no row carries the array
    rows = rows.withColumn("table", table).withColumn("sum", let(F.col("table"), lambda w: total("h", w) + total("p", w))).drop("h", "p", "table")
    score = F.when(F.col("n_words") > 0, F.col("sum") / (2 * F.col("n_words") - 1 + SHRINK)).otherwise(0.0)
    rows = rows.withColumn("score", score).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD))
    return rows.select("keep", *RESULTS)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled as good and not toxic; one that is also labelled otherwise is not trusted."""
    by_doc = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    return by_doc.filter("q = 1 AND t = 0").select("doc_id")


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Of every document: the base counts, whether they fail it, and whether it stays.

    Null and empty texts have no words and fail; null ids and repeated rows are judged like any other; a text of any
    length is judged whole; an empty table gives no rows; other columns are not read.
    """
    weights = bucket_weights(docs, trusted_ids(labels))
    out = scored(docs, weights, keep=["doc_id"])
    return out.select("keep.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")

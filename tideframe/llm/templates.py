"""Benchmark decontamination by template canonicalisation.

Words become templates: numbers, units after numbers and names within sentences are replaced by placeholders, whose
values are kept as slots. Windows of template words of documents and benchmark items meet in a hash join. Windows of
one alignment must fill an item's slots consistently: one value of the item, one value of the document, both ways.
That finds copied questions and such as only had their numbers and names changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tideframe.llm.common import frugal, mix, written
from tideframe.llm.repeats import _batch

#: Words of a window; the share of an item's windows, or the number of them, that make a leak.
WIDTH, SHARE, MANY = 8, 0.5, 20
#: Benchmark windows that are matched in one pass over the documents (8 bytes each are broadcast).
PASS = 4_000_000
#: Distinct words that a worker remembers.
MEMORY = 500_000

#: Units of measure, singular and plural.
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles inch inches foot feet yard yards meter meters metre metres kilometer kilometers "
    "kilometre kilometres mg g kg t gram grams kilogram kilograms ton tons lb lbs pound pounds oz ounce ounces ml cl l "
    "liter liters litre litres gallon gallons s sec secs second seconds min mins minute minutes h hr hrs hour hours day "
    "days week weeks month months year years kmh mph hz khz mhz ghz w kw mw v a c f k percent dollar dollars cent cents "
    "euro euros usd eur gbp degree degrees bit bits byte bytes kb mb gb tb".split()
)
_NUMBER = regex.compile(r"[-+$€£]?\p{N}[\p{N}.,/:]*%?")
_WORD, _NUM, _UNIT, _CAP = range(4)


class Lexicon:
    """What is known of each word: hash of its plain form, kind, whether a sentence ends with it. Bounded."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.tables = [np.zeros(1024, t) for t in (np.uint64, np.uint8, bool)]

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(self.index) > MEMORY:
            self.__init__()
        index = self.index
        for w in set(words).difference(index):
            i = index[w] = len(index)
            if i == len(self.tables[0]):
                self.tables = [np.concatenate([t, np.zeros_like(t)]) for t in self.tables]
            for t, value in zip(self.tables, self.look(w)):
                t[i] = value
        at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        return tuple(t[at] for t in self.tables)

    @staticmethod
    def look(word: str) -> tuple[int, int, bool]:
        plain = word.strip(".,;:!?\"'()[]{}…“”„«»¿¡")
        low = plain.lower()
        kind = _NUM if _NUMBER.fullmatch(plain) else _UNIT if low in UNITS else _CAP if plain[:1].isupper() and plain[1:] == low[1:] else _WORD
        return xxhash.xxh64_intdigest(low), kind, word.rstrip("\"')]}”»")[-1:] in (".", "!", "?", ":")


_SLOT = {_NUM: np.uint64(0x1001), _UNIT: np.uint64(0x2002), _CAP: np.uint64(0x3003)}


def template(words: list[str], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each plain word and of each template word, and which are slots."""
    hashes, kinds, ends = lexicon.of(words)
    after_number = np.concatenate([[False], kinds[:-1] == _NUM])
    inside = np.concatenate([[False], ~ends[:-1]])
    slots = (kinds == _NUM) | ((kinds == _UNIT) & after_number) | ((kinds == _CAP) & inside)
    out = hashes.copy()
    for kind, value in _SLOT.items():
        out[slots & (kinds == kind)] = value
    return hashes, out, slots


def window_hashes(plain: np.ndarray, words: np.ndarray, slots: np.ndarray, width: int) -> np.ndarray:
    """Of each window of template words; a window of slots only would fit anywhere and stays as it is."""

    def rolled(a: np.ndarray) -> np.ndarray:
        out = np.zeros(max(0, len(a) - width + 1), np.uint64)
        spread = mix(a)
        for j in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + spread[j : j + len(out)]
        return mix(out)

    out = rolled(words)
    if slots.any() and len(out):
        sums = np.concatenate([[0], np.cumsum(slots)])
        bare = sums[width:] - sums[:-width] == width
        out = np.where(bare, rolled(plain), out) if bare.any() else out
    return out


#: Punctuation around a slot's value.
_EDGE = ".,;:!?\"'()[]{}"


def slot_values(words: list[str], slots: np.ndarray, start: int, width: int) -> list[str]:
    return [words[i].strip(_EDGE).lower() for i in range(start, start + width) if slots[i]]


def _pattern(values: list[str]) -> list[int]:
    """Which slots have the same value: for each the number of its value in the order of first appearance."""
    number: dict[str, int] = {}
    return [number.setdefault(v, len(number)) for v in values]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of every item; of an item shorter than a window, the whole item. The first window also has the key
    with the first word as a slot, as only a document tells what stands before it."""
    lexicon, out = Lexicon(), []
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = (text or "").split()
            if words:
                plain, hashes, slots = template(words, lexicon)
                width = min(WIDTH, len(words))
                own = window_hashes(plain, hashes, slots, width).view(np.int64).tolist()
                values = slot_values(words, slots, 0, len(words))
                alike = xxhash.xxh64(f"{width} {own} {_pattern(values)}")
                rows = [(i, h, slot_values(words, slots, i, width), False) for i, h in enumerate(own)]
                kind = int(lexicon.of(words[:1])[1][0])
                if kind in (_CAP, _UNIT):  # a slot in a document where the word before makes it one
                    hashes, slots = hashes[:width].copy(), slots[:width].copy()
                    hashes[0], slots[0] = _SLOT[kind], True
                    key = int(window_hashes(plain[:width], hashes, slots, width).view(np.int64)[0])
                    if key != own[0]:
                        rows.append((0, key, slot_values(words, slots, 0, width), True))
                        alike.update(f" {key} {_pattern([words[0].strip(_EDGE).lower(), *values])}")
                same = (xxhash.xxh64_intdigest(f"{item} {text}") - (1 << 63), item, alike.intdigest() - (1 << 63), width, len(own))
                out += [(*same, *r) for r in rows]
            if len(out) > 10_000:
                yield _batch(iter(out), _ITEM)
                out = []
    yield _batch(iter(out), _ITEM)


_ITEM = pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("alike", pa.int64()), ("width", pa.int32()), ("windows", pa.int32()), ("at", pa.int32()), ("key", pa.int64()), ("values", pa.list_(pa.string())), ("other", pa.bool_())])
_ITEM_DDL = "item long, item_id long, alike long, width int, windows int, at int, key long, values array<string>, other boolean"
_HIT = pa.schema([("doc_id", pa.int64()), ("h", pa.int64()), ("width", pa.int32()), ("spot", pa.int32()), ("key", pa.int64()), ("found", pa.list_(pa.string()))])


def rarest(items: DataFrame) -> DataFrame:
    """Of each item the windows, those of the rarest keys, of which a document that holds it must have one.

    A document that has at least `need` of n windows has one of any n - need + 1.
    """
    shared = items.groupBy("width", "key").agg(F.count(F.lit(1)).alias("shared"))
    at = items.join(shared, ["width", "key"]).groupBy("item", "windows", "at").agg(F.sum("shared").alias("shared"))
    need = F.least(F.ceil(F.col("windows") * SHARE), F.lit(MANY))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("shared", "at"))
    return items.join(at.withColumn("rank", rank).filter(F.col("rank") <= F.col("windows") - need + 1).select("item", "at"), ["item", "at"])


def _matcher(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: np.sort(keys.view(np.uint64)) for w, keys in shared.value.items()}
        maps = {}
        for w, keys in known.items():
            maps[w] = np.zeros(1 << 22, bool)
            maps[w][(keys >> np.uint64(42)).astype(np.int64)] = True
        lexicon, out = Lexicon(), []
        for batch in batches:
            for doc, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                words = (text.as_py() or "").split()
                if not words:
                    continue
                plain, hashes, slots = template(words, lexicon)
                for w, keys in known.items():
                    own = window_hashes(plain, hashes, slots, w)
                    at = np.flatnonzero(maps[w][(own >> np.uint64(42)).astype(np.int64)])
                    if len(at):
                        at = at[keys[np.minimum(np.searchsorted(keys, own[at]), len(keys) - 1)] == own[at]]
                        out += [(doc, h, w, i, int(own[i : i + 1].view(np.int64)[0]), slot_values(words, slots, i, w)) for i in at.tolist()]
            if len(out) > 10_000:
                yield _batch(iter(out), _HIT)
                out = []
        yield _batch(iter(out), _HIT)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, h, item_id, n_items, n_windows, n_matched, copied, reparameterised: the documents that hold a benchmark item.

    Items of equal templates whose slots are equal in the same places are told apart by values only, and a document that
    fits one of them fits all. They are one class of n_items: a document has one row for each class it fits. item_id is the
    least item whose values it has throughout, else the least of the class; item_classes() names the others.

    A document holds an item if, in one alignment with consistent slots, it has half of the item's windows of 8 template
    words, or 20 of them. `copied`: each window that matched has the values that an item of the class has
    there; else the item is reparameterised. Null texts hold nothing; empty items are in no document; an item shorter than a window is one
    window. A null id of a document or an item stays null; rows that repeat id and text give one row, and
    items of one id and other templates the best of them; a null id gives way to another one of its class. A text of any length is read whole; empty tables give no rows; other columns are
    not read. The benchmark's window keys are broadcast PASS at a time, with a pass over the
    documents for each, so that a benchmark of any size fits.
    """
    spark = docs.sparkSession
    items = written(benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_items, _ITEM_DDL))
    members, verbatim = _members(items)
    parted = items.withColumn("v", F.xxhash64("values"))
    member_windows = parted.select("alike", "at", "key", "v").distinct().withColumn("own", F.lit(True))
    # from here on one item stands for all that are alike
    items = written(items.join(members.select("item"), "item", "left_semi"))
    total = items.count()
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.col("text").cast("string"))
    passes, hits = -(-total // PASS), None
    for i in range(max(passes, 1)):
        rows = items.filter(F.pmod(F.xxhash64("key"), F.lit(max(passes, 1))) == i).select("width", "key").distinct().toArrow()
        keys = {w: rows["key"].to_numpy()[rows["width"].to_numpy() == w] for w in set(rows["width"].to_pylist())}
        found = texts.mapInArrow(frugal(_matcher(spark.sparkContext.broadcast(keys))), "doc_id long, h long, width int, spot int, key long, found array<string>")
        hits = found if hits is None else hits.unionByName(found)
    hits = written(hits.withColumn("d", F.coalesce("doc_id", F.lit(-(2**63)))))
    # candidates by the rare windows only, so that a window that many items share makes no rows of every item and document
    found = hits.join(rarest(items), ["width", "key"]).select("d", "h", "item", (F.col("spot") - F.col("at")).alias("shift")).distinct()
    both = found.join(items, "item").withColumn("spot", F.col("shift") + F.col("at")).join(hits, ["d", "h", "width", "key", "spot"])
    both = both.withColumn("v", F.xxhash64("found")).join(member_windows, ["alike", "at", "key", "v"], "left")
    pairs = F.arrays_zip(F.col("values").alias("a"), F.col("found").alias("b"))
    lined = both.groupBy("doc_id", "h", "item", "alike", "windows", "shift").agg(
        F.count_distinct("at").alias("matched"),
        F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"),
        F.coalesce(F.min(F.coalesce("own", F.lit(False))), F.lit(False)).alias("copied"),
        F.xxhash64(F.sort_array(F.collect_set(F.struct("at", "key", "v")))).alias("text"),
    )
    lined = lined.withColumns({"left": F.size(F.array_distinct("pairs.a")), "right": F.size(F.array_distinct("pairs.b"))})
    fit = lined.filter((F.size("pairs") == F.col("left")) & (F.size("pairs") == F.col("right")) & ((F.col("matched") >= SHARE * F.col("windows")) | (F.col("matched") >= MANY)))
    # a document that has all of an item, values and all, names that one, else the least of those alike
    fit = fit.join(verbatim, ["alike", "text"], "left").join(members.drop("item"), "alike")
    return fit.groupBy("doc_id", "h", "alike").agg(
        F.coalesce(F.min("exact_id"), F.min("least_id")).alias("item_id"), F.max("n_items").alias("n_items"), F.max(F.col("windows").cast("long")).alias("n_windows"), F.max("matched").alias("n_matched"),
        F.max("copied").alias("copied"), F.min(~F.col("copied")).alias("reparameterised"),
    ).groupBy("doc_id", "h", "item_id").agg(*[f(c).alias(c) for c, f in {"n_items": F.max, "n_windows": F.max, "n_matched": F.max, "copied": F.max, "reparameterised": F.min}.items()])


def _members(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alike, item, least_id, n_items): for each class of items of equal templates the one that stands for it, its least id
    and its size; and (alike, text, exact_id): the least item of a class that has just these values."""
    own = items.select("alike", "item", "item_id").distinct()
    classes = own.groupBy("alike").agg(F.min("item").alias("item"), F.min("item_id").alias("least_id"), F.count(F.lit(1)).alias("n_items"))
    window = F.struct("at", "key", F.xxhash64("values").alias("v"))
    plain, other = (F.collect_set(F.when((F.col("at") > 0) | (F.col("other") == o), window)) for o in (False, True))
    texts = items.groupBy("alike", "item", "item_id").agg(F.array_distinct(F.array(F.xxhash64(F.sort_array(plain)), F.xxhash64(F.sort_array(other)))).alias("t"))
    exact = texts.select("alike", "item_id", F.explode("t").alias("text")).groupBy("alike", "text").agg(F.min("item_id").alias("exact_id"))
    return written(classes), written(exact)


def item_classes(benchmark: DataFrame) -> DataFrame:
    """item_id, class: the items whose templates and pattern of equal slots are the same, by the least id among them."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(_items, _ITEM_DDL)
    own = written(rows.select("alike", "item_id").distinct())
    return own.join(own.groupBy("alike").agg(F.min("item_id").alias("class")), "alike").select("item_id", "class")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The leaks by document and item."""
    return leaks(docs, benchmark).select("doc_id", "item_id", "n_windows", "n_matched", "copied", "reparameterised", "n_items")

"""Fill-in-the-middle against plain cuts."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import DATA
from oracle import connect, same
from tideframe.llm import fim, queries

PLAIN = {"char": lambda t: list(t), "word": lambda t: re.findall(r"^[ \t-\r]+|[^ \t-\r]+[ \t-\r]*", t), "line": lambda t: re.findall(r"[^\n]*\n|[^\n]+", t)}


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\té😀<P>"), max_size=60), st.sampled_from(sorted(PLAIN)), st.integers(1, 5), st.integers(1, 7))
def test_cuts(text, unit, stride, piece):
    data = np.frombuffer(text.encode(), np.uint8)
    own, units = fim.Checkpoints(data, unit, stride, piece), PLAIN[unit](text)
    assert "".join(units) == text
    assert (own.units, own.points) == (len(units), len(text))
    assert len(own.unit) == -(-len(units) // stride) + 1
    for k in range(len(units) + 1):
        head = "".join(units[:k])
        assert own.cut(k) == (len(head.encode()), len(head))


def plain_row(i, text, seed=1):
    text = text or ""
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 20:
        return i, n, "spm", a, b - a, f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    return i, n, "psm", a, b - a, f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fim, "BATCH", 1000)
    texts = [None, "", " ", "é", "<P>", "a<S>b", "<", "<P", "<S<S<M", ">P>S>", "x" * 3000, "ñ😀\n" * 50_000, "<M> at last"]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(None, "no id"), (None, "no id"), (7, "twice"), (7, "twice"), (-5, "less than nothing")]
    docs = spark.createDataFrame([(t, b"x", i, "") for i, t in rows], "text string, output binary, doc_id long, `h.a` string")
    out = fim.arranged(docs)
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    got = sorted(map(tuple, out.collect()), key=key)
    assert got == sorted((plain_row(*r) for r in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    back = out.select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert fim.arranged(docs.limit(0)).count() == 0


@pytest.mark.parametrize("unit", ["word", "line"])
def test_other_units(spark, unit):
    docs = spark.createDataFrame([(i, "one two\nthree  four\n" * i) for i in range(40)], "doc_id long, text string")
    out = fim.arranged(docs, unit=unit, stride=3)
    for i, n, form, a, m, output, text in out.withColumn("text", fim.restored(F.col("output"), F.col("form"))).collect():
        units = PLAIN[unit](text)
        assert (text, n) == ("one two\nthree  four\n" * i, len(units))
        if form != "plain":
            ends = {len("".join(units[:k])) for k in range(n + 1)}
            assert {a, a + m} <= ends


def test_very_long_text(spark):
    docs = spark.range(1).select(F.lit(3).alias("doc_id"), F.repeat(F.lit("aé\n"), 4_000_000).alias("text"))
    n, form, text = fim.arranged(docs).select("n", "form", F.sha2(fim.restored(F.col("output"), F.col("form")).cast("binary"), 256)).first()
    assert (n, text) == (12_000_000, hashlib.sha256(("aé\n" * 4_000_000).encode()).hexdigest())


def test_sql_twin(spark):
    same(queries.QUERIES["op13_fill_in_middle"](spark, f"{DATA}/sf0.001"), connect(f"{DATA}/sf0.001"), queries.ORACLE["op13_fill_in_middle"])

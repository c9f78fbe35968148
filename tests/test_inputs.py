"""Documents of unknown fields, lines that don't fit, tags, numbers and near sets."""

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideframe.functions import metrics, parsing
from tideframe.operators import ranking, similarity
from tideframe.session import shared_folder
from tideframe.sources import inferred, readers
from tideframe.sources.sinks import Table


def at(spark, name):
    return f"{shared_folder(spark)}/tests/{name}-{uuid.uuid4().hex}"


def texts(spark, *own):
    return spark.createDataFrame([(t,) for t in own], "value string")


def test_masks(spark):
    docs, broken = inferred.parsed(texts(spark, '{"a":1,"b":null,"c":true}', '{"a":2.5,"c":false,"d":{"x":1}}', '{"a":12345678901234567890,"t":"2024-03-01T12:00:00Z","c":"x"}', "[1]", "{", "", None, '{"t":null,"d":[1]}'))
    assert inferred.masks(docs) == {
        "a": inferred.WHOLE | inferred.NUMBER | inferred.HUGE, "b": 0, "c": inferred.BOOLEAN | inferred.TEXT, "d": inferred.NESTED, "t": inferred.TIME,
    }
    assert sorted(str(r.value) for r in broken.collect()) == ["", "None", "[1]", "{"]


def test_masks_come_together_in_any_order():
    draw = random.Random(1)
    kinds = [{"a": draw.randrange(128), **({"b": draw.randrange(128)} if draw.random() < 0.5 else {})} for _ in range(6)]
    one, two = {}, {}
    for m in kinds:
        one = inferred.together(one, m)
    for m in reversed(kinds):
        two = inferred.together(m, two)
    assert one == {k: two[k] for k in one} and len(one) == len(two)
    order = ["boolean", "bigint", "decimal(38,0)", "double", "timestamp", "string"]
    assert [inferred.kind_of(m) for m in (1, 2, 6, 14, 16, 3)] == order and inferred.kind_of(0) == inferred.kind_of(64 | 2) == "string"


def test_a_table_widens(spark):
    own = inferred.Documents(Table(spark, at(spark, "docs"), ["n"], buckets=2))
    broken = own.load(texts(spark, '{"n":1,"someName":5,"some_name":"x","o":{"k":[1]}}', "no", '{"n":2}'), batch=("load", 0))
    assert [r.value for r in broken.collect()] == ["no"]
    assert own.table.read().dtypes == [("n", "bigint"), ("o", "string"), ("some_name", "bigint"), ("some_name_2", "string")]
    own.load(texts(spark, '{"n":9}'), batch=("load", 0))  # the same batch again
    folders = set(own.table.read().inputFiles())
    own.load(texts(spark, '{"n":3,"o":{"k":2}}'), batch=("load", 1))
    assert folders <= set(own.table.read().inputFiles())  # nothing had to be written anew
    own.load(texts(spark, '{"n":1.5,"late":true}', '{"n":4,"some_name":{"deep":"é\\"q"}}'))
    got = own.table.read()
    assert got.dtypes == [("n", "double"), ("o", "string"), ("some_name", "bigint"), ("some_name_2", "string"), ("late", "boolean")]
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert rows == sorted([(1.0, '{"k":[1]}', 5, '"x"', None), (2.0, None, None, None, None), (3.0, '{"k":2}', None, None, None), (1.5, None, None, None, True), (4.0, None, None, '{"deep":"é\\"q"}', None)], key=repr)
    own.load(texts(spark, '{"n":"word","someName":"2024-01-01"}'), sample={"other": inferred.WHOLE})
    got = own.table.read()
    assert dict(got.dtypes) == {"n": "string", "o": "string", "some_name": "string", "some_name_2": "string", "late": "boolean", "other": "bigint"}
    assert sorted(r.n for r in got.collect()) == ["1.0", "1.5", "2.0", "3.0", "4.0", "word"]
    nothing = inferred.Documents(Table(spark, at(spark, "none"), ["n"]))
    assert nothing.load(texts(spark)).count() == 0 and nothing.table.read() is None


def test_lines_that_do_not_fit(spark):
    path = at(spark, "csv")
    lines = ["id,name,n", '1,"a, ""quoted""",5', "2,b", "3,c,4,5", "x,d,6", "4,,", '5,"open,7', "6,é,8"]
    texts(spark, *lines).coalesce(1).write.text(path)
    good, bad = readers.checked_csv(spark, path, StructType.fromDDL("id int, name string, n int"))
    assert sorted(map(tuple, good.collect()), key=repr) == [(1, 'a, "quoted"', 5), (4, None, None), (6, "é", 8)]
    assert sorted(r.line for r in bad.collect()) == sorted(["2,b", "3,c,4,5", "x,d,6", '5,"open,7'])
    assert bad.count() == 4
    good, bad = readers.checked_csv(spark, path, StructType.fromDDL("id int, name string, n int"), head=False)
    assert bad.count() == 5


def values(spark, column, *own):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(own)], "i int, t string")
    return [r.x for r in df.orderBy("i").select(column(F.col("t")).alias("x")).collect()]


def test_numbers_and_tags(spark):
    assert values(spark, parsing.whole_number, "12", " 12.0 ", "12.5", "1.2e1", "x", "NaN", "Infinity", "", None, "9007199254740993", "-3.0", "1e30") == [12, 12, None, 12, None, None, None, None, None, 9007199254740993, -3, None]
    assert values(spark, parsing.tag_array, "#a #b", "#Big  Game", "#a b,#c", "plain words", "#one", "#x\t#y #x") == [["a", "b"], ["big", "game"], ["a b", "c"], ["plain words"], ["one"], ["x", "y"]]
    assert values(spark, parsing.hashtags, "a #B c #d# #", None) == [["b", "d#"], []]
    row = spark.range(1).select(metrics.viral_score_shares(F.lit(100), F.lit(10), F.lit(5), F.lit(2)).alias("s"), metrics.viral_score_shares(F.lit(0), F.lit(0), F.lit(0), F.lit(0)).alias("z")).first()
    assert row.s == pytest.approx(0.7 + 2.5 + 1.0 + 0.4) and row.z == 0


@pytest.mark.parametrize("parts", [1, 5, 64])
def test_percent_ranks_of_values_that_many_share(spark, parts):
    draw = random.Random(parts)
    rows = [(draw.choice(["a", "b", None]), draw.choice([None, 7, 7, 7, 7, *range(20)])) for _ in range(400)] + [("one", 1), ("same", 2), ("same", 2)]
    df = spark.createDataFrame(rows, "g string, v int")
    got = ranking.percent_ranks(df, ["g"], {"v": "p"}, parts=parts)
    want = []
    for g, v in rows:
        own = [x for h, x in rows if h == g]
        below = sum((x is not None, x or 0) < (v is not None, v or 0) for x in own)
        want.append((g, v, round(100 * below / (len(own) - 1) + 1e-9, 2) if len(own) > 1 else 0.0))
    assert sorted(((r.g, r.v, round(r.p, 2)) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_recall_of_minhash(spark):
    """At the settings by default (5 tables, distance 0.5, items of 2 rows to 2 % of them) against the exact join."""
    draw = random.Random(12)
    rows = []
    for i in range(1500):
        base = [f"t{j}" for j in draw.sample(range(3000), 8)]
        rows.append((3 * i, base))
        near = base[: draw.choice([5, 6, 7, 8])] + [f"t{j}" for j in draw.sample(range(3000), 1)]
        rows.append((3 * i + 1, near))
    rows += [(10_000 + i, ["t1", "t2", "t3"]) for i in range(20)] + [(20_000, ["common"]), (20_001, []), (20_002, None), (None, ["t1", "t2"]), (20_003, ["alone"])]
    rows = [(k, t + ["common"] if t and k is not None and k % 2 else t) for k, t in rows]
    df = spark.createDataFrame(rows, "k long, tags array<string>")
    sets = similarity.item_sets(df, "k", "tags", 2, 0.02)
    exact = {(r.a, r.b): r.similarity for r in similarity.jaccard_join(sets, "k", "_s", 0.5).collect()}
    found = {(r.a, r.b): r._distance for r in similarity.minhash_candidates(df, "k", "tags").collect()}
    assert len(exact) > 1000 and set(found) <= set(exact)
    assert all(found[p] == pytest.approx(1 - exact[p]) for p in found)
    reach = [p for p in exact if exact[p] > 0.5]  # below the threshold, not at it
    assert len([p for p in reach if p in found]) >= 0.9 * len(reach)
    members, pairs = similarity.minhash_classes(sets, "k")
    classes = {r.k: r["class"] for r in members.collect()}
    assert {classes[10_000 + i] for i in range(20)} == {10_000} and not {20_000, 20_001, 20_002, 20_003} & set(classes)
    assert similarity.minhash_candidates(df.limit(0), "k", "tags").count() == 0

"""Functions, operators, sinks and streams on small frames with odd rows."""

import datetime
import json
import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideframe.functions import metrics, parsing, themes
from tideframe.operators import aggregates, documents, ranking, similarity, snapshots
from tideframe.plans import registry
from tideframe.session import shared_folder
from tideframe.sources import readers
from tideframe.sources.sinks import Table, publish, retried
from tideframe.streaming import engine


def values(spark, column, *texts, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, t {kind}")
    return [r.x for r in df.orderBy("i").select(column(F.col("t")).alias("x")).collect()]


def test_times_and_durations(spark):
    at = datetime.datetime(2024, 3, 1, 12, 0, 5)
    texts = ["1709294405", "1709294405000", "2024-03-01T12:00:05Z", "2024-03-01T14:00:05+02:00", "2024-03-01 12:00:05", "rubbish", "", None]
    got = values(spark, lambda c: parsing.timestamp_of(c).cast("timestamp_ntz"), *texts)
    assert got == [at] * 5 + [None] * 3
    assert values(spark, parsing.iso_duration_seconds, "PT1H2M3S", "PT45S", "PT", "P1D", "", None) == [3723, 45, None, None, None, None]
    assert values(spark, parsing.clock_seconds, "2:05", "75", "75.9", "x", "1:2:3", None) == [125, 75, 75, None, None, None]
    assert values(spark, parsing.seconds_clock, 125, 0, None, kind="int") == ["2:05", "0:00", None]


def test_tags_and_text(spark):
    assert values(spark, parsing.tag_array, '["#B", "a  x", "a x"]', "a|B", "#A, #a;c", "[none]", "", None) == [["a x", "b"], ["a", "b"], ["a", "c"], [], [], []]
    assert values(spark, parsing.tag_array, '["Rock, paper", "x", null]', "don't|'quoted'", "[a, 'b']", "[]") == [["rock, paper", "x"], ["don't", "quoted"], ["a", "b"], []]
    df = spark.createDataFrame([(["#B", None, "b ", "none"],), (None,)], "t array<string>")
    assert [r.x for r in df.select(parsing.tag_array(F.col("t"), "array<string>").alias("x")).collect()] == [["b"], []]
    assert [len(x[0]) for x in values(spark, parsing.hashtags, "#" + "x" * 20_000)] == [20_000]
    assert values(spark, lambda c: parsing.mentions(["Game", "play"], c, F.lit(None).cast("string")), "GAMES", "none", None) == [True, False, False]
    assert values(spark, lambda c: parsing.theme_text(parsing.tag_array(c), F.lit("title"), F.lit(None).cast("string")), "a|b", "") == ["a b", "title "]
    assert values(spark, parsing.day_type, "2024-03-02T10:00:00Z", "2024-03-04", "rubbish", None) == ["Weekend", "Weekday", "Weekday", "Weekday"]
    assert values(spark, lambda c: parsing.day_type(c, strict=True), "rubbish") == [None]
    odd = spark.createDataFrame([(" ", "5", "x"), (None, "NaN", "7")], "Views string, VIEW_COUNT string, n string")
    assert [r.x for r in odd.select(parsing.column_like(odd, ["views", "view_count", "absent", "N"], "long").alias("x")).collect()] == [5, 7]
    lists = F.array(F.struct(F.lit("a").alias("k"), F.lit(1).alias("v")), F.struct(F.lit("a").alias("k"), F.lit(2).alias("v")))
    assert values(spark, lambda c: parsing.element_where(lists, "k", c, "v", F.lit(0)), "a", "b") == [1, 0]
    assert values(spark, parsing.hashtag_names, "[{'name': 'One'}, {\"name\": \"two\"}]", "none")[0] == ["One", "two"]
    assert values(spark, parsing.hashtags, "see #Cats and # #dogs2", None) == [["cats", "dogs2"], []]
    assert values(spark, lambda c: parsing.keywords(c, ["the"], digits=False), "The CATS, a 123 dog!", None) == [["cats", "dog"], []]
    assert [len(x) for x in values(spark, parsing.short_title, "x" * 100, "x" * 101)] == [100, 100]
    assert values(spark, lambda c: parsing.first_filled(F.lit(" "), F.lit("NaN"), c), "a", None) == ["a", None]
    assert parsing.snake_name("camelCase Name") == "camel_case_name" and parsing.snake_name("1st") == "c_1st" and len(parsing.snake_name("x" * 99)) == 63


def test_themes(spark):
    texts = ["Roblox and Minecraft", "LOL", "lol moments", "scp", "My FPS setup", "nothing", "", None]
    assert values(spark, themes.theme, *texts) == ["roblox", "league of legends", "other gaming", "horror", "hardware & setup", "other gaming", "other gaming", "other gaming"]


#: Written by hand, not from the table of rules: a text for each theme, and texts that several rules fit, of which the first
#: one decides.
THEMED = {
    "Roblox obby": "roblox", "MINECRAFT survival": "minecraft", "cs2 clutch": "counter-strike 2", "Counter Strike esports": "counter-strike 2", "valorant tips": "valorant",
    "fortnite montage": "fortnite", "GTA roleplay": "gta", "grand theft auto": "gta", "League of Legends news": "league of legends", "\tLoL \r\n": "league of legends", "lol!": "other gaming",
    "dota 2 patch": "dota 2", "apex esports": "apex legends", "overwatch": "overwatch 2", "code of the day": "call of duty", "Warzone": "call of duty", "pubg mobile": "pubg",
    "free fire short": "free fire", "brawl stars": "brawl stars", "clash royale": "clash royale", "clash of clans strategy": "clash of clans", "genshin anime": "genshin impact",
    "ea sports fc": "sports / fifa", "fc 25 vs fc 24": "sports / fifa", "nba 2k25": "sports / nba 2k", "rocket league": "rocket league", "character6": "rainbow six siege",
    "elden ring boss fight": "elden ring", "dark souls speedrun": "dark souls", "Black Myth": "black myth wukong", "cyberpunk open world": "cyberpunk 2077", "rdr2 online": "red dead redemption 2",
    "elder scrolls": "skyrim", "resident evil horror": "resident evil", "five nights": "five nights at freddys", "phasmophobia": "phasmophobia", "lethal company": "lethal company",
    "among us funny": "among us", "helldivers": "helldivers 2", "monster hunter": "monster hunter wilds", "mario kart": "mario kart", "zelda walkthrough": "zelda", "pokemon": "pokemon",
    "competitive survival": "esports", "e-sports": "esports", "survival horror": "survival", "scp containment": "horror", "battle royale rpg": "battle royale", "role-play": "rpg",
    "tactical": "strategy game", "farming simulation": "simulator game", "indie retro": "indie game", "sandbox": "open world / sandbox", "anime retro": "anime games", "retrospective": "retro gaming",
    "mobile vr": "mobile gaming", "virtual reality": "vr gaming", "no commentary speedrun": "walkthrough / playthrough", "speedrun guide": "speedrun", "boss fight guide": "boss fight",
    "best settings": "tutorial / guides", "tricks and clips": "tutorial / guides", "shortage": "highlights & clips", "trickshot": "tutorial / guides", "clutch": "highlights & clips", "storage": "funny moments & memes",
    "twitch news": "livestream / vod", "a preview": "gaming news & reviews", "24h challenge co-op": "gaming challenges", "multiplayer setup": "multiplayer / co-op",
    "aim training fps": "hardware & setup", "unreal engine shooter": "tech & ai gaming", "first-person": "fps", "prototype": "other gaming",
}


def test_themes_written_by_hand(spark):
    assert values(spark, themes.theme, *THEMED) == list(THEMED.values())
    assert {t for t in THEMED.values()} == {name for _, name in themes.RULES} | {themes.OTHER}


def test_metrics(spark):
    assert values(spark, metrics.finite, 1.0, 0.0, -1.0, math.nan, math.inf, None, kind="double") == [1.0, 0.0, None, None, None, None]
    got = values(spark, lambda v: metrics.viral_score(v, F.lit(10), F.lit(5)), 100, 0, -1, None, kind="long")
    assert got == [pytest.approx(1 + 3 + 1), None, None, None]
    assert values(spark, lambda v: metrics.plausible(v, F.lit(5), 10), 10, 11, 4, 0, None, kind="long") == [True, False, False, False, None]
    assert values(spark, lambda v: metrics.duration_similarity(v, F.lit(9)), 9, 4, -1, None, kind="int") == [1.0, pytest.approx(0.5), 0.0, 0.0]
    assert values(spark, lambda v: metrics.kept_or(v, F.lit(9.0)), 1.0, -1.0, math.nan, math.inf, None, kind="double") == [1.0, 9.0, 9.0, 9.0, 9.0]
    assert values(spark, lambda v: metrics.valid_message(v, F.lit(5), F.lit(0), F.lit(1.0)), 5.0, 4.0, 0.0, math.nan, None, kind="double") == [True, False, False, False, False]
    both = F.array().cast("array<string>")
    assert values(spark, lambda _: metrics.jaccard(both, both), "x") == [0.0]
    assert values(spark, lambda _: metrics.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))), "x") == [0.5]


def test_ranking(spark):
    df = spark.createDataFrame([("a", 1, 5.0, None), ("a", 2, 5.0, 1), ("a", 3, None, 9), ("b", 4, None, None)], "k string, id int, v double, w int")
    top = ranking.top_n_per_group(df, ["k"], [F.desc_nulls_last("v"), F.asc("id")], 1).select("k", "id").collect()
    assert sorted(map(tuple, top)) == [("a", 1), ("b", 4)]
    best = ranking.best_observation(df, ["k"], ["v", "w"], [F.asc("id")]).select("k", "id")
    assert sorted(map(tuple, best.collect())) == [("a", 2), ("b", 4)]
    assert sorted(map(tuple, ranking.best_observation(df.unionByName(df), ["k"], ["v", "w"], [F.asc("id")]).select("k", "id").collect())) == [("a", 2), ("b", 4)]


def test_same_id_on_two_sides_counts_twice_over_all(spark):
    df = spark.createDataFrame([("x", 1), ("y", 1), ("y", 2)], "side string, id int").withColumn("own", F.struct(F.col("side").alias("s"), "id"))
    got = aggregates.with_all(df, "side", [], {"n": F.count_distinct("own")}).collect()
    assert sorted(map(tuple, got)) == [("All", 3), ("x", 1), ("y", 2)]


def test_distinct_counts_beside_metrics(spark):
    """The same as all in one aggregation, with null keys, parts, ids and values, repeated rows, and no rows at all."""
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), rng.choice([1, 2, None]), rng.choice([*range(9), None]), rng.choice([*range(50), None])) for _ in range(400)]
    df = spark.createDataFrame([*rows, *rows[:50], ("z", 3, None, None)], "side string, k int, id int, v int")
    df = df.withColumn("own", F.when(F.col("id").isNotNull(), F.struct(F.col("side").alias("s"), "id")))
    metrics = {"n": F.count(F.lit(1)), "total": F.sum("v"), "median": aggregates.median("v")}
    for keys in (["k"], []):
        for rows in (df, df.limit(0)):
            want = aggregates.with_all(rows, "side", keys, metrics | {"ids": F.count_distinct("own")})
            got = aggregates.with_all(rows, "side", keys, metrics, within={"ids": F.col("own")})
            assert got.columns == want.columns
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_pairs_and_growth(spark):
    assert values(spark, lambda c: aggregates.pairs_of(F.split(c, ",")), "b,a,b,c", "a", "") == [["a + b", "a + c", "b + c"], [], []]
    day = datetime.date(2024, 1, 10)
    rows = [("up", day - datetime.timedelta(d), 2.0 if d < 3 else 1.0) for d in range(6)] + [("new", day, 1.0), ("old", day - datetime.timedelta(4), 1.0), ("zero", day, 1.0), ("zero", day - datetime.timedelta(3), 0.0)]
    df = spark.createDataFrame(rows, "k string, d date, v double")
    assert sorted((r.k, r.growth_rate) for r in aggregates.growth(df, "k", "d", "v", F.lit(day)).collect()) == [("up", 1.0), ("zero", 0.0)]


def test_change_gate_compares_with_the_last_kept(spark):
    rows = [("a", t, v, 10, 0.0) for t, v in enumerate([100, 104, 108, 109, 0, 0, 1])]
    df = spark.createDataFrame(rows, "k string, t int, views int, likes int, score double").withColumn("tie", F.lit(0))
    kept = snapshots.change_gated(df, ["k"], "t", ["views", "likes"], "score", "tie")
    # 108 is 8 % over the 100 kept last, though only 4 % over 104; a move from 0 always counts, by rule
    assert [r.t for r in kept.orderBy("t").collect()] == [0, 2, 4, 5, 6]
    assert snapshots.change_gated(df.limit(0), ["k"], "t", ["views", "likes"], "score", "tie").count() == 0


def test_similarity(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "b"]), (3, ["c"]), (4, [])], "id int, w array<string>")
    weights = similarity.tf_idf(df, "id", "w")
    norms = weights.groupBy("id").agg(F.round(F.sum(F.col("weight") ** 2), 9).alias("n")).collect()
    assert {tuple(r) for r in norms} == {(1, 1.0), (2, 1.0), (3, 1.0)}
    pairs = spark.createDataFrame([(1, 2), (1, 3), (3, 4)], "a int, b int")
    assert {(r.a, r.b): round(r.cosine, 9) for r in similarity.cosine_pairs(weights, "id", pairs).collect()} == {(1, 2): 1.0, (1, 3): 0.0, (3, 4): 0.0}
    edges = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5), (1, 4, 0.9)], "a int, b int, s double")
    assert sorted((r.a, r.b, r.rank) for r in similarity.neighbours(edges, "s", 2).collect()) == [(1, 2, 2), (1, 4, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1)]


def test_jaccard_join_finds_all_pairs(spark):
    import random

    rng = random.Random(5)
    sets = {i: frozenset(rng.sample("abcdefghijklmnop", rng.randint(0, 9))) for i in range(300)}
    df = spark.createDataFrame([(i, sorted(s) + sorted(s)[:1]) for i, s in sets.items()] + [(None, ["a"])], "id int, w array<string>")
    for least in (0.3, 0.5, 0.65, 1.0):
        want = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}
        assert {(r.a, r.b) for r in similarity.jaccard_join(df, "id", "w", least).collect()} == want


def test_percent_ranks_by_parts(spark):
    from pyspark.sql import Window

    rows = [(g, v) for g in ("a", "b", None) for v in [None, 1.0, 1.0, 2.0, 5.0, 5.0, 5.0, 9.0] * (9 if g == "a" else 1)] + [("c", 3.0), ("d", None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, g string, v double")
    want = df.withColumn("p", F.round(F.percent_rank().over(Window.partitionBy("g").orderBy("v")) * 100, 2)).collect()
    assert sorted(map(tuple, ranking.percent_ranks(df, ["g"], {"v": "p"}, parts=5).collect()), key=repr) == sorted(map(tuple, want), key=repr)


def test_companions_parts_and_grids(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 2, 5, "y"), ("b", 3, None, "z")], "k string, id int, v int, c string")
    assert sorted(map(tuple, aggregates.with_companion(df, ["k"], ["v"], {"c": ["v", "id"]}).collect())) == [("a", 5, "y"), ("b", None, "z")]
    got = aggregates.parts_with_total(df, ["k"], "c", "v").collect()
    assert sorted((r.k, r.total, [tuple(x) for x in r.parts]) for r in got) == [("a", 10, [("x", 5), ("y", 5)]), ("b", None, [("z", None)])]
    kinds = spark.range(1500).select(F.col("id").cast("string").alias("c"))
    grid = aggregates.densified(df.select("k", "c", "v"), df.select("k").distinct(), kinds.unionByName(df.select("c")), "v")
    assert grid.count() == 2 * 1503 and grid.agg(F.sum("v")).first()[0] == 10


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,Title,n\n1,"two\nlines, ""quoted""",NA\n2,,3\n')
    path = str(tmp_path / "a.csv")
    assert readers.header(spark, path) == ["id", "Title", "n"]
    assert sorted(map(tuple, readers.csv(spark, path, columns=["n", "Title"]).collect()), key=repr) == [("3", None), ("NA", 'two\nlines, "quoted"')]
    assert readers.csv(spark, path, StructType.fromDDL("id int, Title string, n int")).select("id").collect()[0][0] == 1
    (tmp_path / "d.json").write_text('{"a": 1, "b": {"c": "x"}}\n{"a": 2.5, "late": true}\n')
    docs = readers.documents(spark, str(tmp_path / "d.json"))
    assert docs.columns == ["a", "b", "late"] and dict(documents.flattened(docs).dtypes) == {"a": "double", "b_c": "string", "late": "boolean"}


def test_formats(spark, tmp_path):
    from tideframe.sources import sinks

    sinks.overwrite(spark.range(3), f"{tmp_path}/x", "json")
    sinks.overwrite(spark.range(9), f"{tmp_path}/x", "json", "ignore")
    assert spark.read.json(f"{tmp_path}/x").count() == 3
    got = sinks.as_messages(spark.createDataFrame([(1, None, "x")], "k int, v int, w string"), ["k"]).first()
    assert tuple(got) == ('{"k":1}', '{"k":1,"w":"x"}')


def test_documents(spark):
    df = spark.createDataFrame([(1, ("x", ("7", "t"))), (2, ("y", (None, "true")))], "id int, doc struct<aB string, in struct<n string, f string>>")
    flat = documents.promoted(documents.flattened(df))
    assert dict(flat.dtypes) == {"id": "int", "doc_a_b": "string", "doc_in_n": "bigint", "doc_in_f": "boolean"}


def test_messages(spark):
    texts = ['{"k": 1}', '[{"k": 2}, {"k": NaN}]', "{broken", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    good, bad = readers.messages(df, StructType.fromDDL("k double"))
    assert good.count() == 3 and good.select("record.k").filter("k = 2").count() == 1
    assert sorted((r.value, r.reason) for r in bad.filter("value <> ''").collect()) == [("{broken", "invalid_json")]
    good, bad = readers.messages(spark.createDataFrame([('[{"k": 1}, null]',)], "value string"), StructType.fromDDL("k double"))
    assert [r.record.k for r in good.collect()] == [1.0] and [r.reason for r in bad.collect()] == ["null_record"]


def test_alignment(spark):
    one = spark.createDataFrame([("1", "x")], "view_count string, title string")
    two = spark.createDataFrame([("bad", 3)], "views string, extra int")
    columns = {"views": ("bigint", ["views", "view_count"]), "title": ("string", ["title"])}
    out = readers.stacked([readers.aligned(one, columns, platform="a"), readers.aligned(two, columns, platform="b")])
    assert sorted(map(tuple, out.collect()), key=repr) == [(1, "x", "a"), (None, None, "b")]


def at(spark, name):
    import uuid

    return f"{shared_folder(spark)}/tests/{name}-{uuid.uuid4().hex}"


def test_keyed_tables(spark):
    t = Table(spark, at(spark, "keyed"), ["k"])
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    assert t.read() is None
    t.upsert(rows((1, "a"), (2, "b")))
    for _ in range(2):  # twice the same
        t.upsert(rows((2, "c"), (3, "d")))
        assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c"), (3, "d")]
    t.upsert(rows((3, "x"), (4, "y")), update=False)
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (2, "c"), (3, "d"), (4, "y")]
    for wrong in (rows((5, "a"), (5, "b")), rows((None, "a"))):
        with pytest.raises(ValueError):
            t.upsert(wrong)
    t.replace(rows((9, "n")), rows((1, ""), (2, "")), ["k"])
    t.delete(rows((4, "")))
    assert sorted(map(tuple, t.read().collect())) == [(3, "d"), (9, "n")]


def test_publish_is_all_or_nothing(spark):
    path = at(spark, "both")
    one, two = Table(spark, path, ["id"], "one"), Table(spark, path, ["id"], "two")
    good = spark.range(3)
    publish({one: good, two: good})
    bad = good.select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        publish({one: spark.range(9), two: bad})
    assert one.read().count() == two.read().count() == 3


def test_retry():
    waits, tries = [], []

    def flaky():
        tries.append(1)
        if len(tries) < 4:
            raise OSError

    retried(flaky, wait=waits.append)
    assert waits == [1, 2, 4]
    with pytest.raises(ValueError):
        retried(lambda: (_ for _ in ()).throw(ValueError("wrong data")), wait=waits.append)
    assert waits == [1, 2, 4]
    with pytest.raises(OSError):
        retried(lambda: (_ for _ in ()).throw(OSError()), attempts=3, wait=waits.append)


SCHEMA = "id int, channel string, day int, views int, version int"


def feed(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_regrouped_stream_moves_records_and_drops_empty_groups(spark):
    """Also over a restart from the checkpoint, and with a late and a repeated message."""
    src, state = at(spark, "src"), at(spark, "state")

    def go():
        return sorted(map(tuple, engine.regrouped(
            readers.tail(spark, src, StructType.fromDDL(SCHEMA)), ["id"], lambda df: ranking.latest(df, ["id"], [F.desc("version"), F.desc("views")]), ["channel", "day"],
            lambda df: df.groupBy("channel", "day").agg(F.sum("views").alias("views"), F.count(F.lit(1)).alias("n")), state,
        ).collect()))

    feed(spark, src, [(1, "a", 1, 10, 1), (2, "a", 1, 5, 1), (3, "b", 1, 7, 1)])
    assert go() == [("a", 1, 15, 2), ("b", 1, 7, 1)]
    feed(spark, src, [(3, "a", 1, 9, 2), (2, "a", 1, 5, 1), (1, "a", 1, 99, 0)])
    assert go() == [("a", 1, 24, 3)]
    feed(spark, src, [(4, "c", 2, 1, 1)])
    assert go() == [("a", 1, 24, 3), ("c", 2, 1, 1)]


def test_gated_stream_equals_the_batch_query(spark):
    """With ties, late and repeated records, over restarts."""
    src, state = at(spark, "src"), at(spark, "state")
    schema = "k int, t int, id int, views int, score double"
    seen = []

    def go(*rows):
        seen.extend(rows)
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(src)
        got = engine.gated(readers.tail(spark, src, StructType.fromDDL(schema)), "k", "t", ["views"], "score", "id", state)
        want = snapshots.change_gated(spark.createDataFrame(sorted(set(seen), key=repr), schema), ["k"], "t", ["views"], "score", "id")
        assert sorted(map(tuple, got.select(*want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        return sorted((r.t, r.id) for r in got.filter("k = 1").collect())

    assert go((1, 0, 1, 100, 0.0), (1, 1, 2, 104, 0.0)) == [(0, 1)]
    assert go((1, 2, 3, 104, 0.0), (1, 3, 4, 108, 0.0)) == [(0, 1), (3, 4)]
    assert go((1, 5, 5, 200, 0.0), (1, 5, 6, 100, 0.0), (2, 1, 1, 5, 0.0), (None, 1, 1, 5, 0.0)) == [(0, 1), (3, 4), (5, 5), (5, 6)]
    assert go((1, 3, 4, 108, 0.0), (1, 1, 0, 108, 0.0)) == [(0, 1), (1, 0), (5, 5), (5, 6)]  # late: 108 at t=3 no longer differs


def test_a_failed_batch_is_repeated_without_harm(spark, monkeypatch):
    """The write of the results fails once; after a restart they are as if it had not."""
    from tideframe.sources.sinks import Store

    src, state = at(spark, "src"), at(spark, "state")

    def go():
        return sorted(map(tuple, engine.regrouped(
            readers.tail(spark, src, StructType.fromDDL(SCHEMA)), ["id"], lambda df: ranking.latest(df, ["id"], [F.desc("version"), F.desc("views")]), ["channel"],
            lambda df: df.groupBy("channel").agg(F.sum("views").alias("views")), state,
        ).collect()))

    feed(spark, src, [(1, "a", 1, 10, 1), (2, "a", 1, 5, 1)])
    assert go() == [("a", 15)]
    feed(spark, src, [(2, "b", 1, 6, 2)])
    commit = Store.commit
    for when in ("before", "after"):  # the process dies before or after the manifest is there

        def dies(self, *args, when=when, **more):
            if when == "after":
                commit(self, *args, **more)
            raise RuntimeError("gone")

        monkeypatch.setattr(Store, "commit", dies)
        with pytest.raises(Exception, match="gone"):
            go()
        monkeypatch.setattr(Store, "commit", commit)
    assert go() == [("a", 10), ("b", 6)]


def test_running_keeps_null_keys(spark):
    src = at(spark, "src")
    feed(spark, src, [(1, None, 1, 10, 1), (2, "a", 1, 5, 1), (3, None, 2, 1, 1)])
    stream = readers.tail(spark, src, StructType.fromDDL(SCHEMA))
    assert sorted(map(tuple, engine.running(stream, ["channel"], {"n": F.sum("views")}).collect()), key=repr) == [("a", 5), (None, 11)]
    best = engine.best_records(stream.select("channel", "id", "views"), ["channel"], [F.col("views")])
    assert sorted(map(tuple, best.collect()), key=repr) == [("a", 2, 5), (None, 1, 10)]


def test_stores(spark, monkeypatch):
    """Races, broken manifests, vacuum, appends, checked loads, copies of a definition."""
    from tideframe.sources import sinks
    from tideframe.sources.sinks import Conflict

    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    t = Table(spark, at(spark, "store"), ["k"])
    assert t.ensure(rows((1, "a"))) and not t.ensure(rows((2, "b")))
    base, manifest = t.store.current()
    staged = t.upserted(manifest, rows((2, "b")))
    t.upsert(rows((3, "c")))
    with pytest.raises(Conflict):
        t.store.commit({t.name: staged}, base)
    t.store._fs.create(t.store._file(t.store.current()[0] + 1), False).close()  # a writer that broke off
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (3, "c")]
    with pytest.raises(Conflict):  # as far as one can tell, it is still at work
        t.upsert(rows((1, "w")))
    monkeypatch.setattr(sinks, "GRACE", 0.0)
    t.upsert(spark.createDataFrame([(1, "x")], "k int, v string"))  # another type of key
    assert sorted(map(tuple, t.read().collect())) == [(1, "x"), (3, "c")]
    for i in range(25):
        t.upsert(rows((i, "y")))
    t.store.vacuum(2)
    assert t.read().count() == 25 and len(t.store.numbers()) <= 2
    one = Table(spark, at(spark, "one"), ["k"], buckets=2)
    one.like(t)
    assert one.read().columns == ["k", "v"] and one.read().count() == 0
    one.append(rows((1, "a")))
    one.append(rows((1, "a")))
    assert one.read().count() == 2 and one.load(rows((7, "z"))) == 1 and one.read().count() == 1
    before = t.store.current()[1]["tables"]["table"]["buckets"]
    t.upsert(rows((0, "z")))
    after = t.store.current()[1]["tables"]["table"]["buckets"]
    assert sum(before[b] != after[b] for b in after) == 1  # only the bucket that it touches is written anew




def test_no_update_is_lost(spark, monkeypatch):
    """A writer whose manifest is there but still empty, while another one reads and commits."""
    from tideframe.sources import sinks
    from tideframe.sources.sinks import Conflict

    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    t = Table(spark, at(spark, "race"), ["k"])
    t.upsert(rows((1, "first")))
    base, manifest = t.store.current()
    own = t.upserted(manifest, rows((2, "slow")))
    slow = t.store._fs.create(t.store._file(base + 1), False)  # the slow writer has the number, but no content yet
    seen, manifest = t.store.current()
    other = t.upserted(manifest, rows((3, "other")))
    with pytest.raises(Conflict):
        t.store.commit({t.name: other}, seen)
    slow.write(bytearray(json.dumps({"tables": {t.name: own}, "batches": {}, "parent": base}).encode()))
    slow.close()
    with pytest.raises(Conflict):  # now it is whole, but not what the other one has read
        t.store.commit({t.name: other}, seen)
    sinks.retried(lambda: t.upsert(rows((3, "other"))))
    assert sorted(map(tuple, t.read().collect())) == [(1, "first"), (2, "slow"), (3, "other")]
    # a writer that was taken for gone and comes back is told so
    monkeypatch.setattr(sinks, "GRACE", 0.0)
    create = type(t.store)._file
    late = Table(spark, t.path, ["k"])
    base, manifest = late.store.current()
    own = late.upserted(manifest, rows((4, "late")))

    def overtaken(self, number):  # just before the late one writes its manifest, the other one commits
        if self is late.store and number == base + 1 and not hasattr(self, "passed"):
            self.passed = True
            self._fs.create(create(self, number), False).close()
            t.upsert(rows((5, "quick")))
        return create(self, number)

    monkeypatch.setattr(type(t.store), "_file", overtaken)
    with pytest.raises(Conflict):
        late.store.commit({late.name: own}, base)
    assert 5 in {r.k for r in t.read().collect()} and 4 not in {r.k for r in t.read().collect()}


def test_keys_are_checked_before_every_commit(spark):
    rows = lambda *r: spark.createDataFrame(list(r), "k long, v string")
    path = at(spark, "keys")
    t, other = Table(spark, path, ["k"]), Table(spark, path, ["k"], "other")
    t.overwrite(rows((1, "a")))
    for wrong in (rows((1, "a"), (1, "b")), rows((None, "a"))):
        for write in (t.overwrite, t.load, lambda df: publish({t: df, other: rows((2, "b"))})):
            with pytest.raises(ValueError):
                write(wrong)
    assert [tuple(r) for r in t.read().collect()] == [(1, "a")] and other.read() is None
    Table(spark, path, ["k"], "log", unique=False).overwrite(rows((1, "a"), (1, "b")))


def test_buckets_follow_the_size(spark, monkeypatch):
    from tideframe.sources import sinks

    monkeypatch.setattr(sinks, "BUCKET", 2_000)
    t = Table(spark, at(spark, "wide"), ["id"], buckets=2)
    t.upsert(spark.range(10))
    assert t._entry()["n"] == 2
    t.upsert(spark.range(10_000))
    entry = t._entry()
    assert entry["n"] >= 8 and len(entry["buckets"]) == entry["n"] == len(entry["bytes"])
    t.upsert(spark.range(5, 15))
    assert t.read().count() == 10_000
    days = Table(spark, at(spark, "days"), ["k", "d"], by=["d"], parted=True)
    rows = lambda *r: spark.createDataFrame(list(r), "k int, d int")
    days.upsert(rows((1, 1), (2, 1), (1, 2), (1, 3)))
    before = days._entry()["buckets"]
    days.upsert(rows((3, 2)))
    after = days._entry()["buckets"]
    assert {d for d in after if before[d] != after[d]} == {"2"}
    part = days.parts([2, 9])
    assert sorted(map(tuple, part.collect())) == [(1, 2), (3, 2)] and all("_bucket=2/" in f for f in part.inputFiles())
    assert days.read(1).count() == 4 and days.read(2).count() == 5


def test_settings(spark):
    from tideframe.session import settings

    kinds = {"n": (int, 3), "names": (list, ["a"]), "on": (bool, False), "needed": (str, str)}
    try:
        with pytest.raises(ValueError, match="needed"):
            settings(spark, kinds)
        for k, v in {"needed": "x", "names": "b, c,", "on": "TRUE"}.items():
            spark.conf.set(f"spark.tideframe.{k}", v)
        assert settings(spark, kinds) == {"n": 3, "names": ["b", "c"], "on": True, "needed": "x"}
        spark.conf.set("spark.tideframe.n", "many")
        with pytest.raises(ValueError, match="int"):
            settings(spark, kinds)
    finally:
        for k in kinds:
            spark.conf.unset(f"spark.tideframe.{k}")


def test_a_table_read_anew_for_each_batch(spark):
    src, at_ = at(spark, "src"), at(spark, "state")
    names = Table(spark, at(spark, "names"), ["channel"])
    out = Table(spark, f"{at_}/out", ["id"])

    def go():
        stream = readers.tail(spark, src, StructType.fromDDL(SCHEMA))
        engine.joined_with(stream, names.read, ["channel"], lambda batch, n: engine.once(out, batch.select("id", "name"), n), at_)
        return sorted(map(tuple, out.read().collect()))

    names.upsert(spark.createDataFrame([("a", "old")], "channel string, name string"))
    feed(spark, src, [(1, "a", 1, 10, 1), (2, "b", 1, 5, 1)])
    assert go() == [(1, "old"), (2, None)]
    names.upsert(spark.createDataFrame([("a", "new"), ("b", "too")], "channel string, name string"))
    feed(spark, src, [(3, "a", 1, 10, 1), (4, "b", 1, 5, 1)])
    assert go() == [(1, "old"), (2, None), (3, "new"), (4, "too")]


def test_written_by_the_clock_and_watched(spark):
    """A query with a trigger writes what comes until it is stopped; a listener counts its rows and what is dropped."""
    import time

    src, at_ = at(spark, "src"), at(spark, "state")
    feed(spark, src, [(1, "a", 1, 10, 1), (2, None, 1, 5, 1)])
    watch = engine.Watch(spark)
    spark.streams.addListener(watch)
    out = Table(spark, f"{at_}/out", ["channel"], nulls=True)
    stream = engine.counted(readers.tail(spark, src, StructType.fromDDL(SCHEMA)), "dropped", {"no_channel": F.col("channel").isNull()})
    sums = stream.filter("channel IS NOT NULL").groupBy("channel").agg(F.sum("views").alias("views"))
    query = engine.run(sums, lambda batch, n: engine.once(out, batch, n), at_, every="1 second")
    try:
        def until(want):
            for _ in range(100):
                if out.read() is not None and sorted(map(tuple, out.read().collect())) == want:
                    return True
                time.sleep(0.3)

        assert until([("a", 10)])
        feed(spark, src, [(3, "a", 1, 1, 1), (4, "b", 1, 2, 1)])
        assert until([("a", 11), ("b", 2)])
    finally:
        query.stop()
    for _ in range(50):
        if watch.ended and watch.counters.get("dropped.no_channel"):
            break
        time.sleep(0.2)
    spark.streams.removeListener(watch)
    assert watch.rows[str(query.runId)] == 4 and watch.counters["dropped.no_channel"] == 1 and not watch.failed


def test_a_processor_trims_its_state(spark):
    src, at_ = at(spark, "src"), at(spark, "state")
    out = Table(spark, f"{at_}/out", ["key"])

    def go(*rows):
        spark.createDataFrame(list(rows), "k string, d int, v double").coalesce(1).write.mode("append").parquet(src)
        stream = readers.tail(spark, src, StructType.fromDDL("k string, d int, v double"))
        grown = engine.growth_state(stream, "k", F.col("d"), F.col("v"), 2)
        engine.run(grown, lambda batch, n: engine.once(out, batch, n), at_)
        return sorted((r.key, r.as_of, r.recent_avg, r.prior_avg, r.growth_rate) for r in out.read().collect())

    assert go(("a", 1, 1.0), ("a", 2, 3.0), ("a", 3, 4.0), ("b", 1, 5.0)) == [("a", 3, 3.5, 1.0, 2.5)]
    assert go(("a", 4, 6.0), ("a", None, 1.0)) == [("a", 4, 5.0, 2.0, 1.5)]
    # day 1 is gone from the state by now, so that a late row of day 5 can't bring it back; b has no earlier window
    assert go(("a", 6, 8.0), ("b", 2, 5.0)) == [("a", 6, 8.0, 5.0, 0.6)]


def test_copies_of_a_set_are_one_class_of_the_jaccard_join(spark):
    """All pairs of members as the plain way gives them, from pairs of as many classes as there are different sets."""
    words = [["a", "b", "c", "d"], ["a", "b", "c", "e"], ["d", "c", "b", "a", "a"], ["x", None], [], None, ["x", "y"], [None]]
    rows = [(i, words[i % len(words)]) for i in range(160)] + [(None, ["a", "b", "c", "d"])]
    df = spark.createDataFrame(rows, "id int, w array<string>")
    members, classes = similarity.set_classes(df, "id", "w")
    assert sorted((r["class"], len(r["_s"])) for r in classes.collect()) == [(0, 4), (1, 4), (3, 1), (6, 2)]
    assert members.count() == 100 and [tuple(r) for r in similarity.jaccard_classes(classes, 0.6).collect()] == [(0, 1, 0.6)]
    sets = {i: {x for x in w or [] if x} for i, w in rows if i is not None}
    for least in (0.3, 0.6, 1.0):
        want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] and sets[b]}
        got = [tuple(r) for r in similarity.jaccard_join(df, "id", "w", least).collect()]
        assert len(got) == len(set(got)) and {(a, b): s for a, b, s in got} == {p: s for p, s in want.items() if s >= least}


def test_neighbours_of_members(spark):
    """Against all pairs, with classes of one to many members and equal scores between and within them."""
    import random

    rng = random.Random(8)
    kind = {i: rng.choice([0, 0, 0, 0, 1, 2, 2, 3, 4, 5, 6, 7]) for i in range(120)}
    score = {(x, y): rng.choice([0.1, 0.5, 0.5, 0.9, 1.0]) for x in range(8) for y in range(x, 8) if (x + y) % 5 and (x, y) != (3, 3)}
    least = {x: min(i for i in kind if kind[i] == x) for x in set(kind.values())}
    members = spark.createDataFrame([(i, least[x]) for i, x in kind.items()], "id int, class int")
    edges = spark.createDataFrame([(least[x], least[y], s, x + y) for (x, y), s in score.items()], "a int, b int, s double, more int")
    want = []
    for a in kind:
        own = sorted((-score[p], b, sum(p)) for b in kind if b != a and (p := tuple(sorted((kind[a], kind[b])))) in score)[:7]
        want += [(a, b, -s, more, r + 1) for r, (s, b, more) in enumerate(own)]
    got = similarity.neighbours_of_members(members, "id", similarity.symmetric(edges), "s", 7).select("a", "b", "s", "more", "rank")
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("copies", [1, 30])
def test_tag_jaccard_of_copies_and_nulls(spark, tmp_path, copies):
    """Members of classes against the plain join; a part without brand or size has no pair, one without name no similarity."""
    kinds = [("a b", "x", 1), ("b a", "x", 2), ("a c", "x", 2), (None, "x", 1), ("a b", None, 1), ("a b", "x", None), ("a a b", "y", 3), ("d", "y", 2)]
    rows = [(i, *kinds[i % len(kinds)]) for i in range(len(kinds) * copies)]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    tags = [set(n.split()) if n else None for _, n, _, _ in rows]
    want = [(a[0], b[0]) for a in rows for b in rows if a[2] and a[2] == b[2] and a[3] and b[3] and a[3] == b[3] + 1]
    got = {(r.a, r.b): r.tag_similarity for r in registry.QUERIES["tag_jaccard"](spark, str(tmp_path)).collect()}
    assert sorted(got) == sorted(want)
    assert all(s == round(len(tags[a] & tags[b]) / len(tags[a] | tags[b]), 6) for (a, b), s in got.items() if tags[a] and tags[b])


def test_tag_jaccard_of_null_keys_and_more_than_a_pack(spark, tmp_path):
    """A part without key has its pairs too, also where it is alone; members of more than one pack have theirs once."""
    rows = [(None, "a b", "x", 1), (None, "c", "y", 5), (1, "d", "y", 4), *[(i, "a c", "x", 2) for i in range(2, 453)]]
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = registry.QUERIES["tag_jaccard"](spark, str(tmp_path)).select("a", "b", "tag_similarity").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, 1, 0.0), *[(i, None, 0.333333) for i in range(2, 453)]], key=repr)


def test_packed_members(spark):
    packs = similarity.packed(spark.range(450).select("id", F.lit(None).cast("string").alias("g")), ["g"], "id").collect()
    assert sorted(len(r.members) for r in packs) == [50, 200, 200] and sorted(m.key for r in packs for m in r.members) == [*range(450)]


def test_keyword_counts_clean_different_words(spark):
    df = spark.createDataFrame([("a", "Foo-bar foobar,\n FOOBAR! the x"), ("a", "- ¡foo¡bar the! (ab)"), ("b", None), (None, "čas  čas. 123\t!")], "g string, t string")
    got = aggregates.keyword_counts(df, ["g"], F.col("t"), ["the"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", "foobar", 4), (None, "čas", 2), (None, "123", 1)], key=repr)

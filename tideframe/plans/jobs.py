"""The end-to-end jobs as queries over the test tables, with the SQL that gives the same rows.

Raw records of two platforms are made from the events: texts as collectors write them. The SQL goes the short way.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tideframe.functions import metrics, parsing, themes
from tideframe.operators import aggregates, documents, similarity
from tideframe.operators.ranking import latest
from tideframe.plans import content
from tideframe.plans.registry import _DAILY, _GROWTH, _PEAK, _RANKINGS, _stream, daily_metrics_with_all, query, rankings_having, table
from tideframe.session import shared_folder
from tideframe.sources import readers, sinks
from tideframe.sources.sinks import Table
from tideframe.streaming import engine

LONG, SHORT = ("view", "purchase", "signup"), ("click", "share", "error")
#: What both Spark and the SQL read: raw fields of an event.
FIELDS = {
    "row_id": "event_id",
    "video_id": "'v' || CAST(user_id % 400 AS STRING)",
    "title": "'Video ' || CAST(user_id AS STRING) || CASE WHEN user_id % 3 = 0 THEN ' about roblox' ELSE '' END",
    "channel_title": "CASE WHEN event_id % 9 <> 0 THEN 'c' || CAST(user_id % 40 AS STRING) END",
    "views": "CAST(round(value * 100) AS BIGINT) - 500",
    "likes": "event_id % 977",
    "comments": "event_id % 53",
    "score": "CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN -1.0 ELSE (event_id % 700) / 100.0 END",
    "source_type": "CASE WHEN event_id % 2 = 0 THEN 'search' ELSE 'monitoring' END",
}
TAGS = """CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '[none]' WHEN 2 THEN 'Fortnite|Speed  run' WHEN 3 THEN '#Minecraft|boss fight|minecraft' WHEN 4 THEN 'Elden Ring' ELSE '["Rock, paper", "GTA V"]' END"""
TAGS_SQL = "CASE event_id % 6 WHEN 2 THEN ['fortnite', 'speed run'] WHEN 3 THEN ['boss fight', 'minecraft'] WHEN 4 THEN ['elden ring'] WHEN 5 THEN ['gta v', 'rock, paper'] ELSE [] END"
CAPS = {"long": 60_000, "short": 40_000}
_SECONDS = {"long": "event_id % 3 * 3600 + event_id % 60 * 60 + event_id % 59", "short": "event_id % 60 * 60 + event_id % 59"}


def raw(spark: SparkSession, events: DataFrame, platform: str) -> DataFrame:
    """A platform's records as text, under that platform's names."""
    rows = events.filter(F.col("event_type").isin(*(LONG if platform == "long" else SHORT)))
    rows = rows.select(
        *[F.expr(e).alias(n) for n, e in FIELDS.items()], F.expr(TAGS).alias("tags"), F.col("ts").alias("_ts"),
        F.expr("'PT' || CAST(event_id % 3 AS STRING) || 'H' || CAST(event_id % 60 AS STRING) || 'M' || CAST(event_id % 59 AS STRING) || 'S'").alias("iso"),
        F.expr("CAST(event_id % 60 AS STRING) || ':' || lpad(CAST(event_id % 59 AS STRING), 2, '0')").alias("clock"),
    )
    at = F.col("_ts").cast("timestamp")
    texts = {c: F.col(c).cast("string") for c in ("views", "likes", "comments", "score")}
    rows = rows.withColumns(texts).withColumnRenamed("score", "viral_score")
    if platform == "long":
        return rows.withColumns({"collected_at": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "duration": F.col("iso")}).drop("_ts", "iso", "clock")
    names = {"video_id": "id", "title": "desc", "channel_title": "author_name", "views": "play_count", "likes": "digg_count", "comments": "comment_count", "tags": "challenges"}
    return rows.withColumns({"collected_time": F.unix_seconds(at).cast("string"), "duration": F.col("clock")}).drop("_ts", "iso", "clock").withColumnsRenamed(names)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    seconds = {"long": parsing.iso_duration_seconds, "short": parsing.clock_seconds}
    return readers.stacked([content.prepared(raw(spark, events, p), p, CAPS[p], seconds[p]) for p in ("long", "short")])


_RAW = "SELECT ts, " + ", ".join(f"{e} AS {n}" for n, e in FIELDS.items()) + f", {TAGS_SQL} AS tags, CASE WHEN event_type IN {LONG} THEN 'long' ELSE 'short' END AS platform, CASE WHEN event_type IN {LONG} THEN {_SECONDS['long']} ELSE {_SECONDS['short']} END AS duration_seconds FROM events"
_PREPARED = f"""SELECT row_id, video_id, title, channel_title, CAST(ts AS DATE) AS day, platform, views, likes, comments, source_type, tags, CAST(duration_seconds AS INTEGER) AS duration_seconds,
    CAST(len(tags) AS INTEGER) AS tag_count, (likes + comments) / views AS engagement_rate,
    CASE WHEN score >= 0 THEN CAST(score AS DOUBLE) ELSE round(log10(views) * 0.50 + likes / views * 100 * 0.30 + comments / views * 100 * 0.20, 4) END AS viral_score
  FROM ({_RAW}) WHERE views > 0 AND likes <= views AND views <= CASE platform WHEN 'long' THEN {CAPS['long']} ELSE {CAPS['short']} END"""


@query("prepare_videos", f"SELECT row_id, video_id, day, platform, views, likes, comments, duration_seconds, tag_count, array_to_string(tags, ';') AS tags, round(engagement_rate, 6) AS engagement_rate, viral_score FROM ({_PREPARED})")
def prepare_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw texts of two platforms to one table of typed observations, written and read again."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    sinks.overwrite(observations(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "row_id", "video_id", "day", "platform", "views", "likes", "comments", "duration_seconds", "tag_count", F.array_join("tags", ";").alias("tags"), F.round("engagement_rate", 6).alias("engagement_rate"), "viral_score")


_DAILY_VIDEOS = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY platform, video_id, day ORDER BY (channel_title IS NOT NULL)::INT DESC, views DESC, likes DESC, comments DESC, row_id) AS rn FROM ({_PREPARED})) WHERE rn = 1"""


@query("daily_video_metrics", f"SELECT platform, video_id, day, row_id, title, channel_title, views, likes, comments, round(engagement_rate, 6) AS engagement_rate FROM ({_DAILY_VIDEOS})")
def daily_video_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily records upserted in two runs, of which the second one repeats part of the first."""
    rows = content.daily_videos(observations(spark, sf_dir)).select("platform", "video_id", "day", "row_id", "title", "channel_title", "views", "likes", "comments", F.round("engagement_rate", 6).alias("engagement_rate"))
    target = Table(spark, f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}", ["platform", "video_id", "day"])
    target.upsert(rows.filter("platform = 'long' OR row_id % 2 = 0"))
    target.upsert(rows.filter("platform = 'short'"))
    return target.read()


_THEMED = f"""SELECT * FROM (SELECT *, {themes.theme_sql('theme_text')} AS theme FROM (SELECT *, CASE WHEN len(tags) > 0 THEN array_to_string(tags, ' ') ELSE title END AS theme_text,
    row_number() OVER (PARTITION BY platform, video_id, day ORDER BY views DESC, viral_score DESC, engagement_rate DESC, source_type, array_to_string(tags, chr(31)), CASE WHEN len(tags) > 0 THEN array_to_string(tags, ' ') ELSE title END, row_id) AS rn FROM ({_PREPARED})) WHERE rn = 1) WHERE theme <> '{themes.OTHER}'"""
_MEASURES = """count(DISTINCT (platform_of, video_id)) AS video_count, CAST(sum(views) AS BIGINT) AS sum_views, avg(views) AS avg_views, quantile_disc(views, 0.5) AS median_views,
    CAST(sum(CAST(round(viral_score * 10000) AS BIGINT)) AS DOUBLE) / count(viral_score) / 10000 AS avg_viral_score, quantile_disc(viral_score, 0.5) AS median_viral_score,
    CAST(sum(CAST(round(engagement_rate * 1000000) AS BIGINT)) AS DOUBLE) / count(engagement_rate) / 1000000 AS avg_engagement_rate, quantile_disc(engagement_rate, 0.5) AS median_engagement_rate"""
_ROLLED = f"WITH o AS ({_THEMED}), r AS (SELECT *, platform AS platform_of FROM o UNION ALL SELECT * REPLACE ('All' AS platform), platform AS platform_of FROM o)"
_THEME_DAILY = f"{_ROLLED} SELECT platform, theme, day, {_MEASURES} FROM r GROUP BY ALL"
_THEME_RANKINGS = f"""{_ROLLED} SELECT * FROM (SELECT platform, theme, video_count, median_viral_score, CAST(row_number() OVER (PARTITION BY platform ORDER BY median_viral_score DESC, video_count DESC, theme) AS INTEGER) AS rank
    FROM (SELECT platform, theme, count(DISTINCT (platform_of, video_id)) AS video_count, quantile_disc(viral_score, 0.5) AS median_viral_score FROM r GROUP BY ALL HAVING count(DISTINCT (platform_of, video_id)) >= 2)) WHERE rank <= 10"""


def _theme_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return content.theme_tables(content.themed(observations(spark, sf_dir)), 2)


@query("theme_daily", _THEME_DAILY)
def theme_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _theme_tables(spark, sf_dir)["daily"]


@query("theme_tag_daily", f"{_ROLLED} SELECT platform, theme, tag, day, {_MEASURES} FROM (SELECT *, unnest(tags) AS tag FROM r) GROUP BY ALL")
def theme_tag_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _theme_tables(spark, sf_dir)["tag_daily"]


@query("theme_rankings", _THEME_RANKINGS)
def theme_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _theme_tables(spark, sf_dir)["rankings"]


@query("theme_dimension", f"SELECT theme, count(DISTINCT (platform, video_id)) AS video_count, min(day) AS first_day, max(day) AS last_day FROM ({_THEMED}) GROUP BY theme")
def theme_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _theme_tables(spark, sf_dir)["themes"]


@query("theme_top10_daily", f"SELECT d.theme, d.day, d.video_count, r.rank FROM ({_THEME_DAILY}) d JOIN ({_THEME_RANKINGS}) r ON r.theme = d.theme AND r.platform = d.platform WHERE d.platform = 'All' AND r.rank <= 10")
def theme_top10_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's tables published in one step; its view joins what a reader finds."""
    at = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    keys = {"daily": ["platform", "theme", "day"], "tag_daily": ["platform", "theme", "tag", "day"], "rankings": ["platform", "theme"], "themes": ["theme"]}
    own = {n: Table(spark, at, k, n) for n, k in keys.items()}
    sinks.publish({own[n]: df for n, df in _theme_tables(spark, sf_dir).items()})
    daily, ranks = own["daily"].read().filter("platform = 'All'"), own["rankings"].read().filter("rank <= 10")
    return daily.select("platform", "theme", "day", "video_count").join(ranks.select("platform", "theme", "rank"), ["platform", "theme"]).drop("platform")


_TAGGED = "SELECT p_partkey AS id, list_sort(list_distinct(list_append(string_split(lower(p_name), ' '), lower(p_brand)))) AS tags, lower(p_name || ' ' || p_type) AS text, {theme} AS theme, p_size AS seconds FROM part"


def _similar_sql(theme: str) -> str:
    return f"""WITH v AS ({_TAGGED.format(theme=theme)}),
        p AS (SELECT a.id AS a, b.id AS b, len(list_intersect(a.tags, b.tags)) / len(list_distinct(list_concat(a.tags, b.tags))) AS tag_similarity, CAST(a.theme = b.theme AS DOUBLE) AS theme_similarity,
                     exp(-abs(ln((a.seconds + 1) / (b.seconds + 1)))) AS duration_similarity
              FROM v a JOIN v b ON a.id < b.id WHERE len(list_intersect(a.tags, b.tags)) >= 0.5 * len(list_distinct(list_concat(a.tags, b.tags)))),
        w AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(regexp_split_to_array(text, '[^a-z0-9_]+')) AS term FROM v) WHERE length(term) >= 2 GROUP BY ALL),
        f AS (SELECT term, ln(((SELECT count(DISTINCT id) FROM w) + 1) / (count(*) + 1)) AS idf FROM w GROUP BY term),
        x AS (SELECT id, term, tf * idf / nullif(sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY id)), 0) AS weight FROM w JOIN f USING (term)),
        c AS (SELECT p.a, p.b, least(1, greatest(0, coalesce(sum(m.weight * n.weight), 0))) AS text_similarity FROM p LEFT JOIN x m ON m.id = p.a LEFT JOIN x n ON n.id = p.b AND n.term = m.term GROUP BY ALL),
        s AS (SELECT a, b, tag_similarity, text_similarity, theme_similarity, duration_similarity, round(0.45 * tag_similarity + 0.35 * text_similarity + 0.10 * theme_similarity + 0.10 * duration_similarity, 6) AS similarity FROM p JOIN c USING (a, b)),
        e AS (SELECT * FROM s UNION ALL SELECT b, a, tag_similarity, text_similarity, theme_similarity, duration_similarity, similarity FROM s)
      SELECT video_id, similar_id, similarity, rank FROM (SELECT a AS video_id, b AS similar_id, similarity, CAST(row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS INTEGER) AS rank FROM e) WHERE rank <= 20"""


@query("similar_videos", _similar_sql("p_type"))
def similar_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best neighbours of each video, put in place of those of the videos worked on, in one step."""
    videos = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("video_id"), parsing.tag_array(F.concat(F.split("p_name", " "), F.array("p_brand")), "array<string>").alias("tags"),
        similarity.tokens(F.concat_ws(" ", "p_name", "p_type")).alias("words"), F.col("p_type").alias("theme"), F.col("p_size").alias("duration_seconds"),
    )
    best = content.similar_videos(videos).select("video_id", "similar_id", "similarity", "rank")
    target = Table(spark, f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}", ["video_id", "similar_id"], by=["video_id"])
    target.overwrite(best.withColumn("similarity", F.lit(0.0)).filter("rank = 1"))  # what an earlier run left
    target.replace(best, videos, ["video_id"])
    return target.read()


# streams


def _messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Records of both platforms as messages of JSON: two streams merged, parsed, and what can't be parsed."""
    schema = table(spark, sf_dir, "events").schema
    parts = []
    for p in ("long", "short"):
        rows = raw(spark, readers.tail(spark, sf_dir, schema, glob="events.parquet"), p)
        parts.append(rows.select(F.to_json(F.struct(*rows.columns)).alias("value"), F.lit(p).alias("platform")))
    value = F.when(F.get_json_object("value", "$.row_id").cast("bigint") % 50 == 49, F.lit("{broken")).otherwise(F.col("value"))
    names = ["row_id", *{n for _, own in content.COLUMNS.values() for n in own} - {"row_id"}]
    return readers.messages(engine.merged(parts).withColumn("value", value), StructType.fromDDL(", ".join(f"`{n}` string" for n in sorted(names))))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = _messages(spark, sf_dir)
    record = {n: [F.col("record")[x] for x in own] for n, (_, own) in content.COLUMNS.items()}
    rows = good.select("platform", *[parsing.first_filled(*c).try_cast(content.COLUMNS[n][0]).alias(n) for n, c in record.items()])
    at = parsing.timestamp_of(F.col("collected_at"))
    score = metrics.kept_or(F.col("viral_score"), metrics.viral_score(F.col("views"), F.col("likes"), F.col("comments")))
    rows = rows.withColumns({"day": F.to_date(at), "tags": parsing.tag_array(F.col("tags")), "viral_score": score})
    return rows.filter(metrics.valid_message(F.col("views"), F.col("likes"), F.col("comments"), F.col("viral_score")) & F.col("day").isNotNull())


_SENT = f"""SELECT row_id, video_id, title, channel_title, CAST(ts AS DATE) AS day, platform, views, likes, comments, tags,
    CASE WHEN score >= 0 THEN CAST(score AS DOUBLE) ELSE round(log10(views) * 0.50 + likes / views * 100 * 0.30 + comments / views * 100 * 0.20, 4) END AS viral_score,
    {themes.theme_sql("CASE WHEN len(tags) > 0 THEN array_to_string(tags, ' ') ELSE title END")} AS theme
  FROM ({_RAW}) WHERE views > 0 AND likes <= views AND row_id % 50 <> 49"""


@query("stream_video_daily_metrics", f"SELECT platform, video_id, day, row_id, title, channel_title, views, likes, comments FROM (SELECT *, row_number() OVER (PARTITION BY platform, video_id, day ORDER BY (channel_title IS NOT NULL)::INT DESC, views DESC, likes DESC, comments DESC, row_id DESC) AS rn FROM ({_SENT})) WHERE rn = 1")
def stream_video_daily_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages parsed, merged and reduced to the best record of each day; each change goes on to a topic, which a second
    query reads and keeps the last state of."""
    rows = _records(spark, sf_dir).select("platform", "video_id", "day", "row_id", "title", "channel_title", "views", "likes", "comments")
    keys = ["platform", "video_id", "day"]
    filled = metrics.completeness(F.col("title"), F.col("channel_title"))
    best = F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), F.struct(filled, "views", "likes", "comments", "row_id")).alias("best")
    at = engine.folder(rows)

    def to_topic(batch: DataFrame, number: int) -> None:
        flat = batch.select(*keys, "best.*").withColumn("batch", F.lit(number))
        sinks.overwrite(sinks.as_messages(flat, keys), f"{at}/topic/batch={number}", "json")  # the same batch, the same place

    def state() -> DataFrame:
        topic = readers.tail(spark, f"{at}/topic", StructType.fromDDL("key string, value string, batch int"), "json")
        kind = StructType.fromDDL("platform string, video_id string, day date, row_id bigint, title string, channel_title string, views bigint, likes bigint, comments bigint, batch int")
        good, _ = readers.messages(topic.select("value"), kind)
        return engine.best_records(good.select("record.*"), keys, [F.col("batch"), F.col("row_id")], f"{at}/second").drop("batch")

    return engine.chained(lambda: engine.run(rows.groupBy(*keys).agg(best), to_topic, f"{at}/first"), [state])[-1]


def _themed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _records(spark, sf_dir)
    return rows.withColumn("theme", themes.theme(parsing.theme_text(F.col("tags"), F.col("title"))))


@query("stream_score_by_theme", f"SELECT platform, theme, count(*) AS n, CAST(sum(CAST(round(viral_score * 10000) AS BIGINT)) AS DOUBLE) / count(*) / 10000 AS avg_score FROM ({_SENT}) GROUP BY ALL")
def stream_score_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = F.round(F.col("viral_score") * 10000).cast("long")
    sums = engine.running(_themed_stream(spark, sf_dir), ["platform", "theme"], {"n": F.count(F.lit(1)), "points": F.sum(points)})
    return sums.select("platform", "theme", "n", (F.col("points") / F.col("n") / 10000).alias("avg_score"))


@query("stream_views_by_theme", f"SELECT theme, day, CAST(sum(views) AS BIGINT) AS total_views, count(*) AS n, CAST(sum(views) AS DOUBLE) / count(*) AS avg_views FROM ({_SENT}) GROUP BY ALL")
def stream_views_by_theme(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = engine.running(_themed_stream(spark, sf_dir), ["theme", "day"], {"total_views": F.sum("views"), "n": F.count(F.lit(1))})
    return sums.withColumn("avg_views", F.col("total_views") / F.col("n"))


@query("stream_platform_score_by_day", f"SELECT platform, theme, day, count(*) AS n, CAST(sum(CAST(round(viral_score * 10000) AS BIGINT)) AS BIGINT) AS points FROM ({_SENT}) WHERE theme <> '{themes.OTHER}' GROUP BY ALL")
def stream_platform_score_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _themed_stream(spark, sf_dir).filter(F.col("theme") != themes.OTHER)
    return engine.running(rows, ["platform", "theme", "day"], {"n": F.count(F.lit(1)), "points": F.sum(F.round(F.col("viral_score") * 10000).cast("long"))})


@query("stream_keywords", "SELECT keyword, count(*) AS n FROM (SELECT unnest(string_split(regexp_replace(lower(p_name || ' 2024 the'), '[^a-z0-9\\s]', '', 'g'), ' ')) AS keyword FROM part) WHERE length(keyword) > 2 AND keyword <> 'the' AND keyword <> '2024' GROUP BY ALL")
def stream_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = readers.tail(spark, sf_dir, table(spark, sf_dir, "part").schema, glob="part.parquet")
    words = parsing.keywords(F.concat("p_name", F.lit(" 2024 the")), ["the"], digits=False)
    return engine.running(rows.select(F.explode(words).alias("keyword")), ["keyword"], {"n": F.count(F.lit(1))})


@query("stream_days_to_peak", _PEAK)
def stream_days_to_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = engine.running(_stream(spark, sf_dir), ["user_id"], {"p": F.max(F.struct("value", "ts")), "start": F.min("ts")})
    return aggregates.peak(best.select("user_id", "p.*", "start"), ["user_id"], "value", "ts", "start")


@query("stream_first_peak", "SELECT user_id, p.value AS peak_value, make_timestamp(-p.at) AS peak_at FROM (SELECT user_id, max({'value': value, 'at': -epoch_us(ts)}) AS p FROM events WHERE value IS NOT NULL GROUP BY 1)")
def stream_first_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The greatest value, of equal ones the first."""
    at = -F.unix_micros(F.col("ts").cast("timestamp"))
    best = engine.running(_stream(spark, sf_dir).filter("value IS NOT NULL"), ["user_id"], {"p": F.max(F.struct("value", at.alias("at")))})
    return best.select("user_id", F.col("p.value").alias("peak_value"), F.timestamp_micros(-F.col("p.at")).cast("timestamp_ntz").alias("peak_at"))


@query(
    "stream_overlap_top20",
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), top AS (SELECT user_id FROM c GROUP BY 1 ORDER BY sum(n) DESC, user_id LIMIT 20)
       SELECT top.user_id, t.event_type, coalesce(c.n, 0) AS n FROM top CROSS JOIN (VALUES ('view'), ('click'), ('purchase'), ('signup'), ('error'), ('share')) t(event_type) LEFT JOIN c ON c.user_id = top.user_id AND c.event_type = t.event_type""",
)
def stream_overlap_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = engine.running(_stream(spark, sf_dir), ["user_id", "event_type"], {"n": F.count(F.lit(1))})
    top = counts.groupBy("user_id").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "user_id").limit(20).select("user_id")
    return aggregates.densified(counts, top, spark.createDataFrame([(k,) for k in (*LONG, *SHORT)], "event_type string"), "n")


_ROWS = "SELECT event_id, CASE WHEN dayofweek(ts) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END AS day_type, CASE WHEN value > 0 THEN (event_id % 7) / value ELSE 0.0 END AS engagement FROM events"


@query("stream_engagement_rows", _ROWS)
def stream_engagement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Engagement and type of day of each record, appended once each."""
    text = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = _stream(spark, sf_dir).select("event_id", parsing.day_type(text).alias("day_type"), F.coalesce(metrics.ratio(F.col("event_id") % 7, F.col("value")), F.lit(0.0)).alias("engagement"))
    return engine.appended(rows)


@query("stream_growth_excluding_trending", _GROWTH)
def stream_growth_excluding_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sums from the stream; growth and the keys that rank everywhere from what it has stored."""
    kinds = engine.running(_stream(spark, sf_dir), ["event_type", "user_id", "day"], {"cents": F.sum("value"), "n": F.count("value")})
    daily = kinds.groupBy("user_id", "day").agg((F.sum("cents") / F.sum("n")).alias("score"))
    rates = aggregates.growth(daily.withColumn("as_of", kinds.agg(F.max("day")).scalar()), "user_id", "day", "score", F.col("as_of"))
    means = kinds.filter(F.col("event_type").isin("view", "click")).groupBy("event_type", "user_id").agg((F.sum("cents") / F.sum("n")).alias("m"))
    from tideframe.operators.ranking import top_n_per_group

    ranked = top_n_per_group(means, ["event_type"], [F.desc("m"), F.asc("user_id")], 15)
    out = aggregates.without_trending(rates, ranked, "user_id", "event_type", "rank", 15, 2)
    return out.select("user_id", *[F.round(c, 6).alias(c) for c in ("recent_avg", "prior_avg", "growth_rate")])


@query(
    "stream_growth_by_state",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, avg(value) AS score FROM events GROUP BY ALL), m AS (SELECT event_type, max(day) AS as_of FROM d GROUP BY 1),
            g AS (SELECT event_type, avg(CASE WHEN date_diff('day', day, as_of) BETWEEN 0 AND 2 THEN score END) AS r, avg(CASE WHEN date_diff('day', day, as_of) BETWEEN 3 AND 5 THEN score END) AS p FROM d JOIN m USING (event_type) GROUP BY 1)
       SELECT event_type, round(r, 6) AS recent_avg, round(p, 6) AS prior_avg, round(CASE WHEN p > 0 THEN (r - p) / p ELSE 0 END, 6) AS growth_rate FROM g WHERE r IS NOT NULL AND p IS NOT NULL""",
)
def stream_growth_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same growth from a processor that keeps, and trims, the daily sums of each key itself."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        rows = engine.growth_state(_stream(spark, sf_dir).filter("value IS NOT NULL"), "event_type", F.datediff("day", F.lit("1970-01-01").cast("date")), F.col("value"))
        at = engine.folder(rows)
        target = Table(spark, f"{at}/table", ["key"], nulls=True)
        engine.run(rows, lambda batch, number: engine.once(target, latest(batch, ["key"], [F.desc("as_of")]), number), at)
    finally:
        spark.conf.unset(provider) if before is None else spark.conf.set(provider, before)
    return target.read().select(F.col("key").alias("event_type"), *[F.round(c, 6).alias(c) for c in ("recent_avg", "prior_avg", "growth_rate")])


@query(
    "stream_growth_against_history",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, round(avg(value), 6) AS score FROM events WHERE value IS NOT NULL GROUP BY ALL),
            h AS (SELECT a.user_id, a.day, a.score, avg(b.score) AS before, count(b.score) AS days FROM d a LEFT JOIN d b ON b.user_id = a.user_id AND date_diff('day', b.day, a.day) BETWEEN 1 AND 3 GROUP BY ALL)
       SELECT user_id, day, score, days, round(CASE WHEN before > 0 THEN (score - before) / before END, 5) AS growth FROM h""",
)
def stream_growth_against_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the mean of the stored days of the three days before it."""
    sums = engine.running(_stream(spark, sf_dir).filter("value IS NOT NULL"), ["user_id", "day"], {"total": F.sum("value"), "n": F.count(F.lit(1))})
    days = sums.select("user_id", "day", F.round(F.col("total") / F.col("n"), 6).alias("score"))
    return aggregates.against_history(days, ["user_id"], "day", "score", 3)


@query("stream_rejected_messages", "SELECT 'invalid_json' AS reason, platform, count(*) AS n FROM (" + _RAW + ") WHERE row_id % 50 = 49 GROUP BY ALL")
def stream_rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What could not be parsed goes to a table of its own, once each."""
    _, bad = _messages(spark, sf_dir)
    return engine.appended(bad.select("reason", "platform", "value")).groupBy("reason", "platform").agg(F.count(F.lit(1)).alias("n"))


@query("drop_reasons", f"SELECT 'no views' AS reason, count(*) AS n FROM ({_RAW}) WHERE views <= 0 UNION ALL SELECT 'more likes than views', count(*) FROM ({_RAW}) WHERE views > 0 AND likes > views UNION ALL SELECT 'kept', count(*) FROM ({_RAW}) WHERE views > 0 AND likes <= views")
def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of dropped records, observed while the others are written."""
    from pyspark.sql import Observation

    rows = table(spark, sf_dir, "events").select(*[F.expr(FIELDS[c]).alias(c) for c in ("row_id", "views", "likes")])
    none, many = F.col("views") <= 0, (F.col("views") > 0) & (F.col("likes") > F.col("views"))
    counts = Observation()
    watched = rows.observe(counts, F.count(F.when(none, 1)).alias("none"), F.count(F.when(many, 1)).alias("many"))
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    sinks.overwrite(watched.filter(~none & ~many), path)
    got = counts.get
    kept = spark.read.parquet(path).count()
    return spark.createDataFrame([("no views", got["none"]), ("more likes than views", got["many"]), ("kept", kept)], "reason string, n bigint")


# files, sorts, companions, arrays


@query("csv_union", "SELECT event_id AS item_id, event_type AS label, CAST(ts AS DATE) AS day, 'events' AS source FROM events UNION ALL SELECT p_partkey, p_name, NULL, 'part' FROM part")
def csv_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two CSV files of text, some of their columns, stacked under common names."""
    at = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    for name in ("events", "part"):
        df = table(spark, sf_dir, name)
        sinks.overwrite(df.select(*[F.col(c).cast("string") for c in df.columns]), f"{at}/{name}", "csv", header="true", quote='"', escape='"')
    columns = {"item_id": ("bigint", ["event_id", "p_partkey"]), "label": ("string", ["event_type", "p_name"]), "day": ("date", ["ts"])}
    wanted = {"events": ["event_id", "event_type", "ts"], "part": ["p_partkey", "p_name"]}
    return readers.stacked([readers.aligned(readers.csv(spark, f"{at}/{n}", columns=c, several_lines=False), columns, source=n) for n, c in wanted.items()])


@query("json_documents", "SELECT event_id, user_id AS owner_user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS owner_k, CASE WHEN event_id % 3 = 0 THEN value END AS late FROM events")
def json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested JSON documents, of which some lack a field, to flat typed columns, loaded with a check of the row count."""
    at = f"{shared_folder(spark)}/files/{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "events").select("event_id", F.struct(F.col("user_id").alias("userId"), F.get_json_object("props", "$.k").alias("k")).alias("owner"), F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("late"))
    sinks.overwrite(rows, at, "json")
    flat = documents.promoted(documents.flattened(readers.documents(spark, at)))
    target = Table(spark, f"{at}-table", ["event_id"])
    target.load(flat)
    return target.read()


@query("sorted_trend", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def sorted_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n")).orderBy("day", F.desc("n"), "event_type")


@query("max_with_companion", "SELECT user_id, max(value) AS max_value, arg_max(event_type, {'v': value, 'i': event_id}) AS event_type FROM events GROUP BY 1")
def max_with_companion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.with_companion(table(spark, sf_dir, "events"), ["user_id"], ["value"], {"event_type": ["value", "event_id"]})


@query("parts_with_total", "SELECT user_id, CAST(sum(n) AS BIGINT) AS total, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS parts, CAST(coalesce(sum(CASE WHEN event_type = 'purchase' THEN n END), 0) AS BIGINT) AS purchases FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) GROUP BY 1")
def parts_with_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of parts with their total, and one part looked up in each array."""
    rows = aggregates.parts_with_total(table(spark, sf_dir, "events").withColumn("n", F.lit(1)), ["user_id"], "event_type", "n")
    texts = F.transform("parts", lambda x: F.concat_ws(":", x["event_type"], x["n"].cast("string")))
    return rows.select("user_id", "total", F.array_join(texts, ",").alias("parts"), parsing.element_where(F.col("parts"), "event_type", F.lit("purchase"), "n", F.lit(0)).alias("purchases"))


@query("relevant_documents", "SELECT doc_id FROM documents WHERE contains(lower(text), 'license') OR contains(lower(text), 'copyright')")
def relevant_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").filter(parsing.mentions(["License", "copyright"], F.col("text"))).select("doc_id")


@query("views_published", f"SELECT d.event_type, count(*) AS n, max(r.rank) AS last_rank FROM ({_DAILY}) d JOIN ({_RANKINGS}) r ON r.event_type = d.event_type GROUP BY 1")
def views_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily, ranks = daily_metrics_with_all(spark, sf_dir), rankings_having(spark, sf_dir)
    return daily.join(ranks, "event_type").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("last_rank"))

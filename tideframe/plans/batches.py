"""Queries over inputs that come in several parts: streams of several micro-batches, merges into a database, documents
whose fields widen, files with broken lines. The SQL goes the short way over the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tideframe.functions import parsing
from tideframe.operators import similarity
from tideframe.operators.ranking import top_n_per_group
from tideframe.plans.registry import _GATED, _snapshots, query, table
from tideframe.session import shared_folder
from tideframe.sources import readers
from tideframe.sources.database import Embedded
from tideframe.sources.inferred import Documents
from tideframe.sources.sinks import Table
from tideframe.streaming import engine, stateful


def _place(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}/{uuid.uuid4().hex}"


def fed(df: DataFrame, part: Column, parts: int) -> DataFrame:
    """A stream of df in so many micro-batches, in the order of `part` (0, 1, ...). Each is as many files as there are cores."""
    spark, path = df.sparkSession, _place(df.sparkSession, "fed")
    rows, files = df.withColumn("_part", part.cast("int")), spark.sparkContext.defaultParallelism
    for i in range(parts):
        rows.filter(F.col("_part") == i).drop("_part").repartition(files).write.mode("append").parquet(path)
        # a task without rows writes no file, but a batch ends after so many
        for _ in range((i + 1) * files - len(spark.read.schema(df.schema).parquet(path).inputFiles())):
            spark.createDataFrame([], df.schema).coalesce(1).write.mode("append").parquet(path)
    return readers.tail(spark, path, df.schema, files=files)


@query(
    "stream_channel_timeline_by_change",
    "SELECT event_type, user_id, CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events WHERE event_id % 11 <> 0 GROUP BY ALL",
)
def stream_channel_timeline_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of records that come twice: first, for some, with another channel or value, then as they are or deleted; in
    three micro-batches, in which the later version may come before the earlier one."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.to_date("ts").alias("day"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    wrong = events.filter("event_id % 3 <> 0").withColumns({"user_id": F.when(F.col("event_id") % 5 == 0, F.col("user_id") + 1).otherwise(F.col("user_id")), "cents": F.when(F.col("event_id") % 7 == 0, F.col("cents") * 2).otherwise(F.col("cents"))})
    both = wrong.withColumns({"version": F.lit(0), "gone": F.lit(False)}).unionByName(events.withColumns({"version": F.lit(1), "gone": F.col("event_id") % 11 == 0}))
    stream = fed(both, F.pmod(F.xxhash64("event_id", "version"), F.lit(3)), 3)
    return stateful.retracted(stream, ["event_id"], ["version"], ["event_type", "user_id", "day"], ["cents"], deleted=F.col("gone"))


@query("stream_snapshot_gate_by_state", _GATED)
def stream_snapshot_gate_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate as state, over three micro-batches in order of time; rows that pass are appended and never touched again."""
    rows = _snapshots(table(spark, sf_dir, "events"))
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    third = F.floor(F.datediff("ts", F.lit(first.date())) * 3 / ((last.date() - first.date()).days + 1))
    return stateful.gated_append(fed(rows, third, 3), ["user_id"], "ts", ["value", "likes"], "score", "event_id")


@query(
    "stream_beside_rankings",
    """WITH e AS (SELECT event_id, event_type, user_id, value, event_id % 3 AS part FROM events),
            u AS (SELECT p.part AS part, event_type, user_id, sum(value) AS total FROM (VALUES (1), (2)) p(part) JOIN e ON e.part < p.part WHERE event_type IN ('view', 'click') GROUP BY ALL),
            r AS (SELECT *, row_number() OVER (PARTITION BY part, event_type ORDER BY total DESC NULLS LAST, user_id) AS rank FROM u),
            t AS (SELECT part, user_id FROM r WHERE rank <= 15 GROUP BY ALL HAVING count(DISTINCT event_type) = 2)
       SELECT event_id, user_id, value FROM e ANTI JOIN t ON t.part = e.part AND t.user_id = e.user_id""",
)
def stream_beside_rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose user doesn't rank on both sides in the table of rankings as it is when their micro-batch comes; the table
    is made anew between the batches from what has come before."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    rankings, at = Table(spark, _place(spark, "tables"), ["event_type", "user_id"], nulls=True), _place(spark, "streams")
    path, out = _place(spark, "fed"), None
    for part in range(3):
        if part:
            sums = events.filter((F.col("event_id") % 3 < part) & F.col("event_type").isin("view", "click")).groupBy("event_type", "user_id").agg(F.sum("value").alias("total"))
            rankings.overwrite(top_n_per_group(sums, ["event_type"], [F.desc_nulls_last("total"), F.asc("user_id")], 15))
        events.filter(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(path)
        out = engine.without_trending(readers.tail(spark, path, events.schema), rankings, "user_id", "event_type", "rank", 15, 2, at)
    return out.select("event_id", "user_id", "value")


@query(
    "stream_growth_within_batches",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, round(avg(CAST(round(value * 100) AS BIGINT)), 4) AS score FROM events WHERE value IS NOT NULL GROUP BY ALL),
            h AS (SELECT a.event_type, a.day, a.score, avg(b.score) AS before, count(b.score) AS days FROM d a LEFT JOIN d b ON b.event_type = a.event_type AND date_diff('day', b.day, a.day) BETWEEN 1 AND 3 GROUP BY ALL)
       SELECT event_type, day, score, days, round(CASE WHEN before > 0 THEN (score - before) / before END, 5) AS growth FROM h""",
)
def stream_growth_within_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day against the stored days of the three days before it, in each of three shuffled micro-batches."""
    rows = table(spark, sf_dir, "events").select("event_type", F.to_date("ts").alias("day"), F.round(F.col("value") * 100).cast("long").alias("cents"), "event_id")
    stream = fed(rows, F.pmod(F.xxhash64("event_id"), F.lit(3)), 3)
    return engine.against_history(stream, ["event_type"], "day", "cents", 3, places=4)


@query(
    "database_merge",
    """SELECT user_id, n, cents, label FROM (SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents, CASE WHEN user_id % 7 = 0 THEN 'old' ELSE 'new' END AS label,
              user_id % 7 = 0 AS old FROM events WHERE user_id % 7 <> 0 OR event_id % 2 = 0 GROUP BY ALL) WHERE user_id % 10 <> 0""",
)
def database_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by user merged twice into a table of a database (Derby, which comes with Spark, in the driver): the second
    time some users' rows are deleted, and some don't fit their column and are set aside, so that those of the first time stay."""
    db = Embedded(spark, f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    db.ensure("user_totals", {"user_id": "BIGINT", "n": "BIGINT", "cents": "BIGINT", "label": "VARCHAR(5)"}, ["user_id"])
    events = table(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    totals = lambda df: df.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
    db.upsert(totals(events.filter("event_id % 2 = 0")).withColumn("label", F.lit("old")), "user_totals", ["user_id"])
    late = totals(events).withColumns({"label": F.when(F.col("user_id") % 7 == 0, "too long a label").otherwise("new"), "n": F.when(F.col("user_id") % 10 == 0, 0).otherwise(F.col("n"))})
    # those of whom nothing is left go, whatever their label
    late = late.withColumn("label", F.when(F.col("n") == 0, "none").otherwise(F.col("label")))
    db.upsert(late, "user_totals", ["user_id"], gone='s."n" = 0')
    return db.read("user_totals")


_DOCUMENTS = """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 3 = 2 THEN 'n' || event_id ELSE CAST(event_id AS VARCHAR) END AS mixed,
       event_id % 2 = 0 AS flag, '{"k":' || user_id || '}' AS owner, CASE WHEN event_id % 3 = 1 THEN 0.5 ELSE user_id END::DOUBLE AS amount,
       CASE WHEN event_id % 3 = 2 THEN user_id END AS late_field FROM events WHERE event_id % 50 <> 49"""


@query("documents_that_widen", _DOCUMENTS)
def documents_that_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts in three batches: a whole number that becomes a fraction, one that becomes text, a field that comes late,
    nested ones, and texts that are no JSON."""
    e, part = table(spark, sf_dir, "events"), F.col("event_id") % 3
    text = F.concat(
        F.lit('{"eventId":'), "event_id", F.when(F.col("event_id") % 4 == 0, "").otherwise(F.concat(F.lit(',"mixed":'), F.when(part == 2, F.concat(F.lit('"n'), "event_id", F.lit('"'))).otherwise(F.col("event_id").cast("string")))),
        F.lit(',"flag":'), (F.col("event_id") % 2 == 0).cast("string"), F.lit(',"owner":{"k":'), "user_id", F.lit('},"amount":'), F.when(part == 1, "0.5").otherwise(F.col("user_id").cast("string")),
        F.when(part == 2, F.concat(F.lit(',"lateField":'), "user_id")).otherwise(""), F.lit("}"),
    )
    rows = e.select(F.when(F.col("event_id") % 50 == 49, F.lit('{"broken')).otherwise(text).alias("value"), part.alias("part"))
    own = Documents(Table(spark, _place(spark, "tables"), ["event_id"]))
    for i in range(3):
        own.load(rows.filter(F.col("part") == i), batch=("documents", i))
    return own.table.read()


@query(
    "csv_with_broken_lines",
    """SELECT event_id, event_type, n, NULL AS line FROM (SELECT event_id, event_type, CAST(round(value * 100) AS BIGINT) AS n FROM events) WHERE event_id % 40 NOT IN (7, 9, 11)
       UNION ALL SELECT NULL, NULL, NULL, CASE event_id % 40 WHEN 7 THEN event_id || ',' || event_type || ',many' WHEN 9 THEN event_id || ',' || event_type ELSE event_id || ',' || event_type || ',1,2' END FROM events WHERE event_id % 40 IN (7, 9, 11)""",
)
def csv_with_broken_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV with a schema: typed rows, and the lines that have too few or many fields, or one of another type."""
    e, at = table(spark, sf_dir, "events"), _place(spark, "files")
    kind, start = F.col("event_id") % 40, F.concat("event_id", F.lit(","), "event_type")
    whole = F.concat(start, F.lit(","), F.round(F.col("value") * 100).cast("long"))
    e.select(F.when(kind == 7, F.concat(start, F.lit(",many"))).when(kind == 9, start).when(kind == 11, F.concat(start, F.lit(",1,2"))).otherwise(whole)).write.text(at)
    good, bad = readers.checked_csv(spark, at, StructType.fromDDL("event_id bigint, event_type string, n bigint"), head=False)
    return good.withColumn("line", F.lit(None).cast("string")).unionByName(bad.select("line"), allowMissingColumns=True)


_TAGS_OF = "list_distinct(list_filter(string_split(p_name, ' ') || [p_type], lambda x: x <> ''))"


@query(
    "minhash_classes",
    f"""WITH t AS (SELECT p_partkey, unnest({_TAGS_OF}) AS tag FROM part),
            f AS (SELECT tag FROM t GROUP BY tag HAVING count(*) >= 2 AND count(*) <= 0.2 * (SELECT count(*) FROM part)),
            s AS (SELECT p_partkey, list_sort(list(tag)) AS tags FROM t SEMI JOIN f USING (tag) GROUP BY p_partkey)
       SELECT p_partkey, min(p_partkey) OVER (PARTITION BY tags) AS class, count(*) OVER (PARTITION BY tags) AS n_copies FROM s""",
)
def minhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose tags, without those too rare or too common, are the same set."""
    parts = table(spark, sf_dir, "part").select("p_partkey", F.filter(F.concat(F.split("p_name", " "), F.array("p_type")), lambda x: x != "").alias("tags"))
    members, _ = similarity.minhash_classes(similarity.item_sets(parts, "p_partkey", "tags", 2, 0.2), "p_partkey")
    sizes = members.groupBy("class").agg(F.count(F.lit(1)).alias("n_copies"))
    return members.join(sizes, "class").select("p_partkey", "class", "n_copies")


@query(
    "document_hashtags",
    "SELECT doc_id, tag, count(*) AS n FROM (SELECT doc_id, lower(regexp_replace(unnest(string_split_regex(text, '\\s+')), '^#', '')) AS tag, unnest(string_split_regex(text, '\\s+')) AS word FROM documents) WHERE word[1] = '#' AND length(word) > 1 GROUP BY ALL",
)
def document_hashtags(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.explode(parsing.hashtags(F.col("text"))).alias("tag"))
    return docs.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "normalised_numbers",
    "SELECT event_id, CASE event_id % 5 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 4 THEN event_id * 10 END AS n FROM events",
)
def normalised_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers from texts such as 12, 12.0, 12.5, words and 1.2e1."""
    i = F.col("event_id")
    text = F.when(i % 5 == 0, i.cast("string")).when(i % 5 == 1, F.concat(i, F.lit(".0"))).when(i % 5 == 2, F.concat(i, F.lit(".5"))).when(i % 5 == 3, "x").otherwise(F.concat(i, F.lit("e1")))
    return table(spark, sf_dir, "events").select("event_id", parsing.whole_number(text).alias("n"))

"""Reading: files with column aliases, and messages of JSON text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tideframe.functions.parsing import first_column


def csv(spark: SparkSession, path: str, schema: StructType | None = None, columns: Sequence[str] | None = None, several_lines: bool = True) -> DataFrame:
    """CSV with a header and quoted fields; all text unless a schema says otherwise; `columns` are those wanted.

    Fields that hold line ends need several_lines, with which a file is one task; without it large files are split.
    """
    reader = spark.read.option("header", True).option("multiLine", several_lines).option("quote", '"').option("escape", '"')
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def checked_csv(spark: SparkSession, path: str, schema: StructType, head: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of CSV with a schema, a record a line: rejected are the lines of too few or too many fields, or with
    a field that its type does not take, as `line`. With head, lines like the first one of the first file are left out.

    Files are split among tasks; fields that hold line ends need csv() with a schema, which rejects nothing.
    """
    lines = spark.read.text(path).filter(F.length("value") > 0)
    first = lines.head() if head else None
    lines = lines.filter(F.col("value") != first["value"]) if first else lines
    whole = StructType([*schema.fields, StructField("_line", StringType())])
    parsed = lines.select("value", F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in whole.fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line", "quote": '"', "escape": '"'}).alias("r"))
    return parsed.filter("r._line IS NULL").select(*[F.col("r").getField(c).alias(c) for c in schema.names]), parsed.filter("r._line IS NOT NULL").select(F.col("value").alias("line"))


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of CSV files, of which only the first line is read."""
    return csv(spark, path, several_lines=False).columns


def documents(spark: SparkSession, path: str, share: float = 1.0) -> DataFrame:
    """JSON documents, one a line, whose schema a share of them decides; what else they hold is left out."""
    return spark.read.option("samplingRatio", share).json(path)


def aligned(df: DataFrame, columns: Mapping[str, tuple[str, Sequence[str]]], **constants: str) -> DataFrame:
    """The canonical columns, each from the first of its names that df has, cast if possible, else null; constants are
    added. columns: name -> (type, names in df)."""
    return df.select(*[first_column(df, names, kind).alias(n) for n, (kind, names) in columns.items()], *[F.lit(v).alias(k) for k, v in constants.items()])


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns that one lacks are null in it."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def messages(df: DataFrame, schema: StructType, value: Column | str = "value") -> tuple[DataFrame, DataFrame]:
    """(records, rejected) of JSON texts that hold an object or an array of objects; NaN counts as a number. A text of
    which only some elements are objects is in both, the others being the reason."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    listed = F.when(F.trim(text).startswith("["), F.trim(text)).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    parsed = df.withColumn("_records", F.from_json(listed, f"array<{schema.simpleString()}>"))
    good = parsed.filter(F.size("_records") > 0).select(*df.columns, F.explode("_records").alias("record"))
    lost = F.col("_records").isNull() | (F.size("_records") <= 0)
    bad = parsed.filter(lost | F.exists("_records", lambda r: r.isNull())).withColumn("reason", F.when(lost, "invalid_json").otherwise("null_record")).drop("_records")
    return good.filter(F.col("record").isNotNull()), bad


def kafka(spark: SparkSession, servers: str, topics: Sequence[str], starting: str = "earliest", **options: str) -> DataFrame:
    """A stream of topics; needs Spark's Kafka package on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics)).option("startingOffsets", starting)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def tail(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", glob: str | None = None, files: int | None = None) -> DataFrame:
    """A stream of the files that come to a folder; the checkpoint of the query knows which it has seen."""
    reader = spark.readStream.schema(schema).format(kind)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.load(path)

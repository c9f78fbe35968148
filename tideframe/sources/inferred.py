"""Documents whose fields and types nobody has declared, loaded into a table that widens with them.

What a field holds is one bit mask: a bit for each kind of value seen. Masks of a sample, of the rows and of later batches
are put together by OR, in any order, and the mask decides the column's type. A batch is parsed once; what is stored is
only written anew when a type must widen or a field is new.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tideframe.functions.parsing import snake_name
from tideframe.sources.sinks import Table

BOOLEAN, WHOLE, HUGE, NUMBER, TIME, TEXT, NESTED = (1 << i for i in range(7))


def kind_of(mask: int) -> str:
    """The narrowest type that takes all kinds of a mask. What is nested becomes JSON text; what is mixed, text."""
    if mask == BOOLEAN:
        return "boolean"
    if mask == WHOLE:
        return "bigint"
    if mask and not mask & ~(WHOLE | HUGE):
        return "decimal(38,0)"
    if mask and not mask & ~(WHOLE | HUGE | NUMBER):
        return "double"
    return "timestamp" if mask == TIME else "string"


def parsed(df: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """`doc`, a variant, of the texts that are JSON objects, and the other texts."""
    out = df.select(F.col(value).cast("string").alias("value")).withColumn("doc", F.try_parse_json("value"))
    whole = F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False))
    return out.filter(whole).select("doc"), out.filter(~whole).select("value")


def _mask(value: Column) -> Column:
    kind = F.schema_of_variant(value)
    is_time = F.try_to_timestamp(F.try_variant_get(value, "$", "string")).isNotNull()
    return (
        F.when(kind == "VOID", 0).when(kind == "BOOLEAN", BOOLEAN).when(kind == "BIGINT", WHOLE).when(kind.rlike(r"^DECIMAL\(\d+,0\)$"), HUGE)
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), NUMBER).when(kind.rlike("^(OBJECT|ARRAY)"), NESTED).when((kind == "STRING") & is_time, TIME).otherwise(TEXT)
    )


def masks(docs: DataFrame) -> dict[str, int]:
    """The mask of every field of the documents: as many rows as there are fields come to the driver."""
    fields = docs.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("doc").outer())).select("key", _mask(F.col("value")).alias("m"))
    return {r["key"]: r["m"] for r in fields.groupBy("key").agg(F.bit_or("m").alias("m")).orderBy("key").collect()}


def together(a: Mapping[str, int], b: Mapping[str, int]) -> dict[str, int]:
    return {k: a.get(k, 0) | b.get(k, 0) for k in [*a, *[k for k in b if k not in a]]}


def names(fields: list[str]) -> dict[str, str]:
    """Fields to column names: snake case, with a number where two would be alike."""
    out: dict[str, str] = {}
    for f in fields:
        base, n = snake_name(f), 1
        own = base
        while own in out.values():
            n += 1
            own = f"{base}_{n}"
        out[f] = own
    return out


def _value(field: str, mask: int) -> Column:
    quote = "'" if "'" not in field else '"'
    if quote in field:
        raise ValueError(f"a field may not hold both quotes: {field}")
    path, kind = f"$[{quote}{field}{quote}]", kind_of(mask)
    if mask & NESTED:
        return F.to_json(F.try_variant_get("doc", path, "variant"))
    if kind == "timestamp":
        return F.try_to_timestamp(F.try_variant_get("doc", path, "string"))
    return F.try_variant_get("doc", path, kind)


def typed(docs: DataFrame, found: Mapping[str, int]) -> DataFrame:
    """A column for each field, of the type that its mask asks for; null where a document has none."""
    columns = names([*found])
    return docs.select(*[_value(f, m).alias(columns[f]) for f, m in found.items()])


def _widened(old: Column, before: int, after: int) -> Column:
    """A stored column as one of the wider type."""
    if before and not before & NESTED and after & NESTED:  # plain values as JSON
        quoted = kind_of(before) in ("string", "timestamp")
        whole = F.to_json(F.struct(old.cast("string").alias("x")))  # {"x":"..."}, whose text is escaped as JSON asks for
        return F.when(old.isNotNull(), F.substring(whole, 6, F.length(whole) - 6) if quoted else old.cast("string"))
    return old.cast(kind_of(after))


class Documents:
    """A table of documents and the masks of its fields, in one store. Rows have no key: loading twice doubles them, unless
    batches are named."""

    def __init__(self, table: Table):
        self.table = table
        self.table.unique = False
        self.fields = Table(table.spark, table.path, ["field"], f"{table.name}_fields", buckets=1)

    def masks(self, manifest: dict | None = None) -> dict[str, int]:
        entry = self.fields._entry(manifest)
        return {} if entry is None else {r["field"]: r["mask"] for r in self.fields._frame(entry).orderBy("place").collect()}

    def load(self, df: DataFrame, value: str = "value", sample: Mapping[str, int] | None = None, batch: tuple[str, int] | None = None) -> DataFrame:
        """Add the documents of df, texts of JSON; the texts that are none.

        sample: masks known beforehand. A field that comes late is a new column, null in what is stored; one whose mask
        outgrows its type makes the stored column wider. Rows, masks and the number of the batch are one commit.
        """
        base, manifest = self.table.store.current()
        docs, broken = parsed(df, value)
        if batch and manifest["batches"].get(batch[0], -1) >= batch[1]:
            return broken
        docs = docs.persist()
        try:
            before = self.masks(manifest)
            after = together(together(before, sample or {}), masks(docs))
            if not after:
                return broken
            own, columns = typed(docs, after), names([*after])
            entry = self.table._entry(manifest)
            same = entry is not None and [*before] == [*after] and all((kind_of(before[f]), before[f] & NESTED) == (kind_of(m), m & NESTED) for f, m in after.items())
            if same:
                new = self.table.stage(own, entry["n"])
                for what in ("buckets", "bytes"):
                    for b, x in entry[what].items():
                        new[what][b] = x + new[what].get(b, [] if what == "buckets" else 0)
            elif entry is None:
                new = self.table.stage(own)
            else:
                old = self.table._frame(entry).select(*[_widened(F.col(columns[f]), before[f], m).alias(columns[f]) if f in before else F.lit(None).cast(kind_of(m)).alias(columns[f]) for f, m in after.items()])
                new = self.table.stage(old.unionByName(own), entry["n"])
            rows = [(f, columns[f], m, i) for i, (f, m) in enumerate(after.items())]
            fields = self.fields.stage(self.table.spark.createDataFrame(rows, "field string, column string, mask int, place int"))
            self.table.store.commit({self.table.name: self.table._wider(new), self.fields.name: fields}, base, batch)
        finally:
            docs.unpersist()
        return broken

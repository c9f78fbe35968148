"""Nested documents to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from tideframe.functions.parsing import snake_name


def flattened(df: DataFrame, depth: int = 3) -> DataFrame:
    """Structs opened to `depth` levels into columns of snake-case names, deeper ones and arrays of structs as JSON."""
    out: list[Column] = []
    used: dict[str, int] = {}

    def walk(column: Column, name: str, kind, level: int) -> None:
        if isinstance(kind, StructType) and level < depth:
            for f in kind.fields:
                walk(column[f.name], f"{name}_{f.name}", f.dataType, level + 1)
            return
        own = snake_name(name)
        used[own] = used.get(own, 0) + 1
        own = own if used[own] == 1 else f"{own}_{used[own]}"
        simple = not (isinstance(kind, StructType) or "struct" in kind.simpleString())
        out.append((column if simple else F.to_json(column)).alias(own))

    for f in df.schema.fields:
        walk(F.col(f"`{f.name}`"), f.name, f.dataType, 0)
    return df.select(*out)


def promoted(df: DataFrame) -> DataFrame:
    """Text columns cast to the narrowest of long, double, boolean and timestamp that takes every value they have.

    One aggregation over all rows decides; a column of mixed or no values stays text.
    """
    kinds = ("bigint", "double", "boolean", "timestamp")
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return df
    tests = [F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").try_cast(k).isNotNull()).alias(f"{c}\0{k}") for c in texts for k in kinds]
    found = df.agg(*tests, *[F.count(f"`{c}`").alias(f"{c}\0n") for c in texts]).first().asDict()
    cast = {c: next((k for k in kinds if found[f"{c}\0{k}"]), "string") for c in texts if found[f"{c}\0n"]}
    return df.withColumns({c: F.col(f"`{c}`").try_cast(k) for c, k in cast.items() if k != "string"})

"""Ranking within groups: top N, latest row, best observation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows of each group by `order`, which must end in a unique column to be repeatable.

    The filter stands right above the window, so that Spark keeps n rows a group before the shuffle.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= n)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group by `order`."""
    return top_n_per_group(df, keys, order, 1, "_rank").drop("_rank")


def best_observation(df: DataFrame, keys: Sequence[str], fields: Sequence[str], ties: Sequence[Column]) -> DataFrame:
    """One row for each key: that with most of the fields filled, then the greater field values in order, then by ties."""
    filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in fields), F.lit(0))
    return latest(df, keys, [filled.desc(), *[F.col(c).desc_nulls_last() for c in fields], *ties])


def percent_ranks(df: DataFrame, by: Sequence[str], columns: dict[str, str], parts: int = 64) -> DataFrame:
    """df with 100 times the percent rank of each column within its group, to 2 places; columns: name -> new name.

    Ranks follow from how many rows have each value, so rows are counted by group and value and never put in order: a value
    that many rows share is one row of the counts. A group may have any number of values, so they are cut at quantiles into
    parts, each a window of its own, to which the rows of the parts before are added. Nulls come first, as in a window.
    """
    for old, new in columns.items():
        df = _with_rank(df, list(by), old, new, parts)
    return df


def _with_rank(df: DataFrame, by: list[str], old: str, new: str, parts: int) -> DataFrame:
    counts = df.groupBy(*by, old).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by)
    cuts = counts.groupBy(*by).agg(F.percentile_approx(old, [k / parts for k in range(1, parts)], 1000).alias("_cuts"))
    counts = _with_group(counts, cuts, by).withColumn("_part", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(old))), F.lit(0))).drop("_cuts")
    sizes = counts.groupBy(*by, "_part").agg(F.sum("_n").alias("_size"))
    before = F.coalesce(F.sum("_size").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(*by, "_part", before.alias("_before"), F.sum("_size").over(group).alias("_all"))
    counts = _with_group(counts, sizes, [*by, "_part"])
    below = F.coalesce(F.sum("_n").over(Window.partitionBy(*by, "_part").orderBy(old).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = F.when(F.col("_all") > 1, (F.col("_before") + below) / F.nullif(F.col("_all") - 1, F.lit(0))).otherwise(0.0)
    return _with_group(df, counts.select(*by, old, F.round(share * 100, 2).alias(new)), [*by, old])


def _with_group(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with what is known of its groups; null keys are equal."""
    right = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    return df.join(right, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_g_{k}`")) for k in keys]).drop(*[f"_g_{k}" for k in keys])


def quadrants(df: DataFrame, a: str, b: str, names: Sequence[str], cut: float = 50) -> DataFrame:
    """df with `quadrant`: names for both, only a, only b and neither at or over the cut."""
    high_a, high_b = F.col(a) >= cut, F.col(b) >= cut
    return df.withColumn("quadrant", F.when(high_a & high_b, names[0]).when(high_a, names[1]).when(high_b, names[2]).otherwise(names[3]))

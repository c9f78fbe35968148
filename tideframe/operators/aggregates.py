"""Rollups, spans, peaks, delays, growth and counts of tokens and pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideframe.functions import parsing


def median(column: str) -> Column:
    """The discrete median, as a sketch of bounded size (exact below 10,000 distinct values)."""
    return F.percentile_approx(column, 0.5, 10_000)


def with_all(df: DataFrame, part: str, keys: Sequence[str], metrics: dict[str, Column], name: str = "All", within: dict[str, Column] | None = None) -> DataFrame:
    """Metrics by part and keys, and over all parts under `name`: one scan, by grouping sets.

    within: what to count the distinct values of, as known within their part, so that the number over all parts is the sum
    of those of the parts. They are counted beside the metrics: in one aggregation Spark would keep the metrics' states,
    sketches of medians among them, for each distinct value. Null keys and parts are groups; null values don't count.
    """
    group = [part, *keys]
    sets = [group, [*keys]]
    out = df.groupingSets(sets, *group).agg(F.grouping(part).alias("_all"), *[m.alias(n) for n, m in metrics.items()])
    if within:
        own = df.groupBy(*group).agg(*[F.count_distinct(c).alias(n) for n, c in within.items()])
        counted = own.groupingSets(sets, *group).agg(F.grouping(part).alias("_all"), *[F.sum(n).alias(n) for n in within])
        both = out.unionByName(counted, allowMissingColumns=True)
        out = both.groupBy(*group, "_all").agg(*[F.first(n, ignorenulls=True).alias(n) for n in (*metrics, *within)])
    return out.select(F.when(F.col("_all") == 1, F.lit(name)).otherwise(F.col(part)).alias(part), *keys, *metrics, *(within or ()))


def bucketed(value: Column, limits: Sequence[tuple[float, str]], above: str) -> Column:
    """The name of the first limit that the value doesn't exceed; `above` for greater values and nulls."""
    out = F
    for limit, name in limits:
        out = out.when(value <= limit, name)
    return out.otherwise(above)


def token_counts(df: DataFrame, keys: Sequence[str], tokens: Column, count: str = "frequency", token: str = "token") -> DataFrame:
    """How often each token stands in the arrays of each group."""
    return df.select(*keys, F.explode(tokens).alias(token)).groupBy(*keys, token).agg(F.count(F.lit(1)).alias(count))


def keyword_counts(df: DataFrame, keys: Sequence[str], text: Column, stop: Sequence[str], count: str = "frequency") -> DataFrame:
    """How often each of parsing.keywords() stands in the texts of each group. Words are counted as they are, and only
    different ones cleaned, as cleaning leaves white space where it is."""
    words = token_counts(df, keys, F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), "_n", "_word")
    clean = words.select(*keys, F.explode(parsing.keywords(F.col("_word"), stop)).alias("keyword"), "_n")
    return clean.groupBy(*keys, "keyword").agg(F.sum("_n").alias(count))


def pairs_of(array: Column, join: str = " + ") -> Column:
    """All unordered pairs of an array's distinct elements, as texts, the lesser first.

    Pairs grow with the square of an array, so this is for arrays that are short by nature, such as tags.
    """
    own = F.array_sort(F.array_distinct(array))
    return F.flatten(F.transform(own, lambda x, i: F.transform(F.filter(own, lambda y: y > x), lambda y: F.concat(x, F.lit(join), y))))


def span_days(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """First and last day of each group and the days between."""
    out = df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return out.withColumn("span_days", F.datediff("last_day", "first_day"))


def peak(df: DataFrame, keys: Sequence[str], value: str, at: str, start: str) -> DataFrame:
    """The greatest value of each group (of equal ones the latest), when it was, and days since `start`, 0 at least."""
    best = df.groupBy(*keys).agg(F.max(F.struct(value, at)).alias("p"), F.min(start).alias("start"))
    days = (F.unix_micros(F.col("p")[at].cast("timestamp")) - F.unix_micros(F.col("start").cast("timestamp"))) / 86_400_000_000
    return best.select(*keys, F.col("p")[value].alias("peak_value"), F.col("p")[at].alias("peak_at"), F.round(F.greatest(days, F.lit(0.0)), 2).alias("days_to_peak"))


def first_seen_delay(df: DataFrame, keys: Sequence[str], side: str, day: str, a: str, b: str, tie: str) -> DataFrame:
    """Which side saw each key first, and by how many days; keys that both have seen."""
    out = df.groupBy(*keys).agg(F.min(F.when(F.col(side) == a, F.col(day))).alias("first_a"), F.min(F.when(F.col(side) == b, F.col(day))).alias("first_b"))
    out = out.filter("first_a IS NOT NULL AND first_b IS NOT NULL")
    return out.select(
        *keys, "first_a", "first_b",
        F.when(F.col("first_a") < F.col("first_b"), a).when(F.col("first_a") > F.col("first_b"), b).otherwise(tie).alias("leader"),
        F.abs(F.datediff("first_a", "first_b")).alias("delay_days"),
    )


def growth(df: DataFrame, key: str, day: str, value: str, as_of: Column, days: int = 3) -> DataFrame:
    """The mean of the last `days` days against that of as many before, for keys with both: (r - p) / p, 0 if p <= 0."""
    age = F.datediff(as_of, F.col(day))
    means = df.groupBy(key).agg(F.avg(F.when(age.between(0, days - 1), F.col(value))).alias("recent_avg"), F.avg(F.when(age.between(days, 2 * days - 1), F.col(value))).alias("prior_avg"))
    rate = F.when(F.col("prior_avg") > 0, (F.col("recent_avg") - F.col("prior_avg")) / F.col("prior_avg")).otherwise(0.0)
    return means.dropna().withColumn("growth_rate", rate)


def against_history(df: DataFrame, keys: Sequence[str], day: str, value: str, days: int) -> DataFrame:
    """df (one row a key and day) with `days`, how many of so many days before have a row, and `growth` against their mean
    (null if that isn't positive)."""
    number = F.datediff(day, F.lit("1970-01-01").cast("date"))
    past = Window.partitionBy(*keys).orderBy(number).rangeBetween(-days, -1)
    before = F.avg(value).over(past)
    return df.select(*df.columns, F.count(value).over(past).alias("days"), F.round(F.when(before > 0, (F.col(value) - before) / before), 5).alias("growth"))


def without_trending(df: DataFrame, ranked: DataFrame, key: str, side: str, rank: str, top: int, sides: int) -> DataFrame:
    """df without the keys that rank among the first `top` on every one of so many sides."""
    everywhere = ranked.filter(F.col(rank) <= top).groupBy(key).agg(F.count_distinct(side).alias("_n")).filter(F.col("_n") >= sides).select(key)
    return df.join(everywhere, key, "left_anti")


def densified(df: DataFrame, keys: DataFrame, dimension: DataFrame, value: str) -> DataFrame:
    """Every key with every value of a dimension; 0 where df has none. keys and dimension: one column or more each.

    The dimension is gathered into one array, which each key explodes.
    """
    on = [*keys.columns, *dimension.columns]
    values = dimension.distinct().agg(F.collect_list(F.struct(*dimension.columns)).alias("v")).scalar()
    grid = keys.distinct().withColumn("_v", values).withColumn("_d", F.explode("_v")).select(*keys.columns, "_d.*")
    return grid.join(df.select(*on, value), on, "left").fillna(0, [value])


def with_companion(df: DataFrame, keys: Sequence[str], maxima: Sequence[str], companion: dict[str, Sequence[str]]) -> DataFrame:
    """The maxima of each group, and columns of the row that has a maximum: companion: column -> order, greatest first."""
    extra = [F.max_by(c, F.struct(*order)).alias(c) for c, order in companion.items()]
    return df.groupBy(*keys).agg(*[F.max(c).alias(f"max_{c}") for c in maxima], *extra)


def parts_with_total(df: DataFrame, keys: Sequence[str], part: str, value: str) -> DataFrame:
    """Of each group the total and an array of its parts (structs of part and value, in the order of part)."""
    sums = df.groupBy(*keys, part).agg(F.sum(value).alias(value))
    return sums.groupBy(*keys).agg(F.sum(value).alias("total"), F.array_sort(F.collect_list(F.struct(part, value))).alias("parts"))

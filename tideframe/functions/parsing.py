"""Parsing of what collected records hold: times, durations, tags, hashtags, numbers, names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def first_column(df: DataFrame, names: Sequence[str], kind: str) -> Column:
    """The first of these columns that df has, cast if possible; a null of that type if it has none."""
    name = next((n for n in names if n in df.columns), None)
    return F.lit(None).cast(kind) if name is None else F.col(f"`{name}`").try_cast(kind)


def column_like(df: DataFrame, names: Sequence[str], kind: str = "string") -> Column:
    """The first of these columns, whatever its case, that is neither null nor blank in a row, cast if possible; names
    that df lacks are passed over."""
    have = {c.lower(): c for c in df.columns}
    found = [have[n.lower()] for n in names if n.lower() in have]
    return first_filled(*[F.col(f"`{c}`") for c in found]).try_cast(kind) if found else F.lit(None).cast(kind)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor blank nor the text NaN."""
    return F.coalesce(*[F.when((F.trim(c.cast("string")) != "") & (F.lower(F.trim(c.cast("string"))) != "nan"), c.cast("string")) for c in columns])


def whole_number(value: Column) -> Column:
    """A whole number, also of a text such as 12.0 or 1e3; null for what isn't one (12.5, NaN, words) or doesn't fit."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    exact = text.try_cast("decimal(38,6)")
    return F.coalesce(text.try_cast("bigint"), F.when(F.abs(number) < 1e18, F.when(exact == F.floor(exact), exact)).try_cast("bigint"))


def theme_text(tags: Column, *texts: Column) -> Column:
    """What a theme is looked for in: the tags if there are any, else the texts."""
    return F.when(F.size(tags) > 0, F.concat_ws(" ", tags)).otherwise(F.concat_ws(" ", *[F.coalesce(t.cast("string"), F.lit("")) for t in texts]))


def mentions(keywords: Sequence[str], *texts: Column) -> Column:
    """Whether one of the keywords stands in one of the texts, whatever its case; nulls hold none."""
    low = F.lower(F.concat_ws(" ", *texts))
    out = F.lit(False)
    for k in keywords:
        out = out | low.contains(k.lower())
    return out


def element_where(array: Column, field: str, value: Column, wanted: str, default: Column) -> Column:
    """Of the first struct in an array whose field has that value, another field; the default if there is none."""
    return F.coalesce(F.get(F.filter(array, lambda x: x[field] == value), F.lit(0))[wanted], default)


def day_type(text: Column, strict: bool = False) -> Column:
    """Weekend or Weekday of a time, a text or not; what can't be read as a time is a Weekday, or null if strict."""
    day = timestamp_of(text.cast("string"))
    return F.when(F.dayofweek(day).isin(1, 7), "Weekend").when(day.isNotNull() | F.lit(not strict), "Weekday")


def timestamp_of(text: Column) -> Column:
    """A time from ISO text (UTC if it has no zone), epoch seconds or epoch milliseconds; null if it is neither."""
    t = F.trim(text.cast("string"))
    number = t.try_cast("double")
    return (
        F.when(t.rlike(r"^\d{10}(\.\d+)?$"), F.timestamp_millis((number * 1000).cast("long")))
        .when(t.rlike(r"^\d{13}$"), F.timestamp_millis(number.cast("long")))
        .otherwise(F.try_to_timestamp(t))
    )


def iso_duration_seconds(text: Column) -> Column:
    """Seconds of PT1H2M3S; null if it is no such text."""
    def part(unit: str) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, rf"(\d+){unit}", 1), F.lit("")).try_cast("int"), F.lit(0))

    return F.when(text.rlike(r"^PT(\d+H)?(\d+M)?(\d+S)?$") & (text != "PT"), part("H") * 3600 + part("M") * 60 + part("S"))


def clock_seconds(text: Column) -> Column:
    """Seconds of m:ss or of a number of seconds; null for other texts."""
    t = F.trim(text)
    parts = F.split(t, ":")
    return F.when(t.rlike(r"^\d+:\d{1,2}$"), parts[0].try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int")).otherwise(t.try_cast("double").try_cast("int"))


def seconds_clock(seconds: Column) -> Column:
    """m:ss of seconds."""
    return F.concat(F.floor(seconds / 60).cast("string"), F.lit(":"), F.lpad((seconds % 60).cast("int").cast("string"), 2, "0"))


def _plain_tags(tags: Column) -> Column:
    """Lower case, without # in front and spare blanks, each once, sorted; nulls and the words none, null and nan go."""
    plain = F.transform(tags, lambda t: F.regexp_replace(F.trim(F.regexp_replace(F.lower(F.trim(t)), r"^#+", "")), r"\s+", " "))
    return F.array_sort(F.array_distinct(F.filter(plain, lambda t: (t != "") & ~t.isin("none", "null", "nan"))))


def tag_array(value: Column, kind: str = "string") -> Column:
    """Distinct lower-case tags, sorted, of an array, of the text of a JSON array, of a text parted by comma, semicolon
    or bar (in which brackets and quotes around a tag go), or of hashtags parted by blanks. A null gives none."""
    if kind.startswith("array"):
        return _plain_tags(F.coalesce(value.cast("array<string>"), F.array().cast("array<string>")))
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    text = F.when(text.rlike(r"^#[^,;|\[\]]*\s[^,;|\[\]]*$"), F.regexp_replace(text, r"\s+", ",")).otherwise(text)  # '#a #b'
    listed = F.when(text.startswith("[") & text.endswith("]"), F.from_json(text, "array<string>"))
    parted = F.transform(F.split(F.regexp_replace(text, r"^\[|\]$", ""), r"[,;|]"), lambda t: F.regexp_replace(F.trim(t), r"""^["']|["']$""", ""))
    return _plain_tags(F.coalesce(listed, parted))


def hashtag_names(text: Column) -> Column:
    """The names in 'name': '..' pairs of a text."""
    return F.regexp_extract_all(text, F.lit(r"""['"]name['"]\s*:\s*['"]([^'"]*)['"]"""), F.lit(1))


def hashtags(text: Column) -> Column:
    """The words of a text that begin with #, without it, in lower case."""
    return F.transform(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w.rlike("^#.")), lambda w: F.lower(F.regexp_replace(w, "^#", "")))


def keywords(text: Column, stop: Sequence[str], shortest: int = 3, digits: bool = True) -> Column:
    """The words of a text, lower-case and without punctuation, but for short ones and stop words."""
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9šđčćž\s]", ""), r"\s+")
    keep = F.filter(words, lambda w: (F.length(w) >= shortest) & ~w.isin(*stop))
    return keep if digits else F.filter(keep, lambda w: ~w.rlike(r"^\d+$"))


def short_title(text: Column, most: int = 100) -> Column:
    """A text of at most `most` characters, the last three of a longer one being dots."""
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def squeezed(text: Column) -> Column:
    """Lower case, white space as single spaces, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def snake_name(name: str, most: int = 63) -> str:
    """A column name in snake case that no database refuses."""
    out = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    out = re.sub(r"\W+", "_", out).strip("_").lower() or "column"
    return (f"c_{out}" if out[0].isdigit() else out)[:most]

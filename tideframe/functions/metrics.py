"""Scores and ratios of observations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole; null where whole is not positive."""
    return F.when(whole > 0, part / whole)


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole, with 1 for a whole of 0."""
    return part / F.when(whole == 0, F.lit(1)).otherwise(whole)


def exact_mean(value: Column, places: int) -> Column:
    """The mean of values rounded to so many places: sums of whole numbers, which come out alike in any order."""
    unit = 10**places
    return F.sum(F.round(value * unit).cast("long")) / F.count(value) / unit


def finite(value: Column) -> Column:
    """The value if it is neither null, NaN, infinite nor negative, else null."""
    return F.when(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf")) & (value >= 0), value)


def viral_score(views: Column, likes: Column, comments: Column) -> Column:
    """0.5 log10(views) + 30 likes / views + 20 comments / views, to 4 places; null without views."""
    return F.when(views > 0, F.round(F.log10(views) * 0.50 + likes / views * 100 * 0.30 + comments / views * 100 * 0.20, 4))


def viral_score_shares(views: Column, likes: Column, comments: Column, shares: Column) -> Column:
    """The variant with shares: 0.35 log10(views) + 25, 20 and 20 times the ratios; at least one view."""
    v = F.greatest(views, F.lit(1))
    return F.log10(v) * 0.35 + likes / v * 100 * 0.25 + comments / v * 100 * 0.20 + shares / v * 100 * 0.20


def plausible(views: Column, likes: Column, most: int) -> Column:
    """Positive views up to `most`, and no more likes than views."""
    return (views > 0) & (likes <= views) & (views <= most)


def kept_or(value: Column, derived: Column) -> Column:
    """A prepared value if it is a number from 0, else the derived one."""
    return F.coalesce(finite(value), derived)


def valid_message(views: Column, likes: Column, comments: Column, score: Column) -> Column:
    """Whether a record counts: finite values, positive views, no negative ones, no more likes than views; false for nulls."""
    numbers = [finite(c.cast("double")).isNotNull() for c in (views, likes, comments, score)]
    fine = numbers[0] & numbers[1] & numbers[2] & numbers[3] & (views > 0) & (likes <= views)
    return F.coalesce(fine, F.lit(False))


def completeness(*columns: Column) -> Column:
    """How many of the columns are not null."""
    out = F.lit(0)
    for c in columns:
        out = out + F.when(c.isNotNull(), 1).otherwise(0)
    return out


def duration_similarity(a: Column, b: Column) -> Column:
    """exp(-|log((a + 1) / (b + 1))|); 0 if a duration is null or negative."""
    fine = a.isNotNull() & b.isNotNull() & (a >= 0) & (b >= 0)
    return F.when(fine, F.exp(-F.abs(F.log((a + 1) / (b + 1))))).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """Common over all elements of two arrays; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(0.0)


def blend(tags: Column, text: Column, theme: Column, duration: Column, shares: tuple[float, float, float, float] = (0.45, 0.35, 0.10, 0.10)) -> Column:
    """The similarities' weighted sum."""
    return tags * shares[0] + text * shares[1] + theme.cast("double") * shares[2] + duration * shares[3]


def change(old: Column, new: Column) -> Column:
    """|new - old| / old; 1 for an old value of 0."""
    return F.when(old == 0, F.lit(1.0)).otherwise(F.abs(new - old) / old)

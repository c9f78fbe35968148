"""Snapshots that are stored only if they differ enough from the one stored last."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

RELATIVE, ABSOLUTE = 0.05, 0.2


def moved(last: tuple, now: tuple) -> bool | None:
    """Whether a snapshot differs enough: a relative value by more than 5 % (any move from 0 does), or the last value,
    which is absolute, by more than 0.2. None, as in SQL, if a null leaves it open."""
    if last[-1] is None or now[-1] is None:
        tests: list[bool | None] = [None]
    else:
        tests = [abs(now[-1] - last[-1]) > ABSOLUTE]
    for a, b in zip(last[:-1], now[:-1]):
        tests.append(None if a is None else True if a == 0 else None if b is None else abs(b - a) / a > RELATIVE)
    return True if True in tests else None if None in tests else False


def change_gated(df: DataFrame, keys: Sequence[str], order: str, relative: Sequence[str], absolute: str, tie: str) -> DataFrame:
    """Of each key's rows in order: the first, and those in which one of `relative` moved by more than 5 % or `absolute`
    by more than 0.2 against the row kept last (a comparison that a null leaves open doesn't keep a row).

    Whether a row stays depends on the last one that stayed, which no window frame expresses: the rows stream, sorted by
    key and order, past one state for each partition, so that a key may have any number of rows.
    """
    columns = [*keys, order, tie, *relative, absolute]
    rows = df.select(*columns)
    n, size = len(keys), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last = None, None
        for batch in batches:
            keep = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                own, value = row[:n], row[n + 2 : size]
                stays = own != key or last is None or moved(last, value) is True
                if stays:
                    key, last = own, value
                keep.append(stays)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.repartition(*keys).sortWithinPartitions(*keys, order, tie).mapInArrow(run, rows.schema)

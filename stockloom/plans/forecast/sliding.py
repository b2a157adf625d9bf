"""Percentiles of the year before each snapshot, from one sorted run per key."""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

# Days on a calendar whose months all have 31: dates are as far apart on it as
# their year, month and day say, so the year before a date is a fixed distance.
MONTH, YEAR = 31, 372


def interpolated(run: Sequence[float], copies: int, p: float) -> float | None:
    """Percentile of a sorted run whose values each occur ``copies`` times."""
    if not run:
        return None
    place = (len(run) * copies - 1) * p
    low = run[math.floor(math.floor(place) / copies)]
    high = run[math.floor(math.ceil(place) / copies)]
    return low + (high - low) * (place - math.floor(place))


def year_before(days: Sequence[int], groups: Sequence[Sequence[float]], copies: Sequence[int], shares: Sequence[float]) -> list[list[float | None]]:
    """Per share, the percentile at each of the rising ``days`` of the groups
    dated less than a year before it.

    Every value enters the run once and leaves it once.
    """
    run: list[float] = []
    first = 0
    out: list[list[float | None]] = [[] for _ in shares]
    for t, day in enumerate(days):
        if t:
            for v in groups[t - 1]:
                insort(run, v)
        while first < t and days[first] <= day - YEAR:
            for v in groups[first]:
                del run[bisect_left(run, v)]
            first += 1
        for column, p in zip(out, shares):
            column.append(interpolated(run, copies[t], p))
    return out


def percentile_batches(shares: Sequence[float]):
    """For ``mapInArrow`` over one row per key: agg_level, dts, days, sizes (of
    the groups), copies and the groups' values in one list."""

    def lists(column: pa.ListArray) -> list[np.ndarray]:
        ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(ends) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: list[list] = [[] for _ in shares]
            for days, sizes, copies, values in zip(*(lists(b.column(c)) for c in ("days", "sizes", "copies", "vals"))):
                groups = [g.tolist() for g in np.split(values, np.cumsum(sizes)[:-1])]
                for column, row in zip(found, year_before(days.tolist(), groups, copies.tolist(), shares)):
                    column.append(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("agg_level"), b.column("dts"), *[pa.array(c, pa.list_(pa.float64())) for c in found]],
                ["agg_level", "dts", *[f"p{i}" for i in range(len(shares))]])

    return run

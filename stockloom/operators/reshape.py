"""Unions, pivots, unnesting and report order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def union_all(dfs: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with equally named columns."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of both frames, duplicates removed."""
    return a.unionByName(b).distinct()


def pivot_sum(
    df: DataFrame,
    row: str,
    name: str,
    value: str,
    names: Sequence[str] | None = None,
    drop: str | None = "All",
    most_names: int = 10_000,
) -> DataFrame:
    """Long measures to one column each, summed; the overall row is dropped.

    ``names`` lists the measures wanted as columns.  Without it they are the
    distinct non-NULL names found, in order; more than ``most_names`` of them
    are an error, never a cut.
    """
    if drop is not None:
        df = df.filter(~F.col(row).cast("string").eqNullSafe(F.lit(drop)))
    if names is None:
        rows = df.select(name).filter(F.col(name).isNotNull()).distinct().limit(most_names + 1).collect()
        if len(rows) > most_names:
            raise ValueError(f"more than {most_names} measure names in {name}")
        names = sorted(r[0] for r in rows)
    return df.groupBy(row).pivot(name, list(names)).agg(F.sum(value))


def unnest(df: DataFrame, c: str, name: str, pos: str | None = None) -> DataFrame:
    """One row per array element, optionally with its position from zero."""
    rest = [x for x in df.columns if x != c]
    if pos is None:
        return df.select(*rest, F.explode(c).alias(name))
    return df.select(*rest, F.posexplode(c).alias(pos, name))


def report_order(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in report order; meant for the last step before an export."""
    return df.orderBy(*cols)


def sort_desc(df: DataFrame, c: str) -> DataFrame:
    return df.orderBy(F.desc(c))

"""Helpers shared by the corpus operators: global order, words, letters."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from stockloom.session import materialise

WORD = r"[^\x20\x09-\x0D]+"


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tasks_of(df: DataFrame, at_least: int = 8) -> int:
    """Number of range partitions: the session's shuffle partitions."""
    return max(at_least, partitions(df.sparkSession))


def in_ranges(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """A stage cut into ranges of ``order``; column ``part`` numbers the ranges.

    Written, so that the cut stays the same when a task is run again.  Callers
    pass narrow rows and end ``order`` with a column that breaks ties, so that
    no range holds a hot key's rows alone.
    """
    cut = df.repartitionByRange(tasks_of(df), *order)
    return materialise(cut.withColumn("part", F.spark_partition_id()), name)


def with_before(staged: DataFrame, order: list[str], amounts: dict[str, Column]) -> DataFrame:
    """Adds, per name, the sum of ``amounts[name]`` over all rows before the row.

    ``staged`` comes from ``in_ranges``: sums run inside each range and the
    totals of the ranges, one row each, are added from a broadcast.
    """
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = staged.groupBy("part").agg(*[F.sum(a).alias(f"total_{n}") for n, a in amounts.items()])
    offsets = totals.select("part", *[
        F.coalesce(F.sum(f"total_{n}").over(over_parts), F.lit(0)).alias(f"offset_{n}") for n in amounts])
    out = staged.join(F.broadcast(offsets), "part")  # one row per range
    for n, a in amounts.items():
        out = out.withColumn(n, F.coalesce(F.sum(a).over(inside), F.lit(0)) + F.col(f"offset_{n}"))
    return out.drop("part", *[f"offset_{n}" for n in amounts])


def text_key(id_col: str, text_col: str) -> Column:
    """128-bit name of a row's id and whole text."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"),
                          F.coalesce(F.col(text_col), F.lit(""))))


_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 bytes."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of unsigned 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TOKEN = re.compile(r"[^\W_]+")


def plain_tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _TOKEN.findall((text or "").lower())


_EAST = r"\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff"
_UNIT = re.compile(rf"[{_EAST}]|[^\W_{_EAST}]+")


def plain_units(text: str | None) -> list[str]:
    """As ``plain_tokens``, but ideographs, kana and Hangul one by one."""
    low = (text or "").lower()
    return (_TOKEN if low.isascii() else _UNIT).findall(low)


def with_python(df: DataFrame, make: Callable[[pa.RecordBatch], dict[str, list]], added: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``df`` without ``drop`` and with the columns that ``make`` gives per batch.

    Columns that stay are handed on as Arrow arrays, so nulls and large numbers
    keep their value.
    """
    new = T.StructType.fromDDL(added)
    names = [f.name for f in df.schema if f.name not in drop]
    kinds = [(f.name, to_arrow_type(f.dataType)) for f in new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = make(b)
            arrays = [*[b.column(n) for n in names], *[pa.array(made[n], k) for n, k in kinds]]
            yield pa.RecordBatch.from_arrays(arrays, [*names, *[n for n, _ in kinds]])

    return df.mapInArrow(run, T.StructType([*[f for f in df.schema if f.name in names], *new]))


def where_python(df: DataFrame, keep: Callable[[pa.RecordBatch], list[bool]]) -> DataFrame:
    """The rows of ``df`` for which ``keep`` gives true; all columns as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(keep(b), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def with_neighbours(staged: DataFrame, order: list[str], around: bool = False) -> DataFrame:
    """Adds structs ``previous`` and ``next`` of the order columns of the rows
    before and after in the whole table; ``around`` joins its two ends.

    ``staged`` comes from ``in_ranges``; the ends of the ranges, one row each,
    are matched in a broadcast.
    """
    inside, over_parts = Window.partitionBy("part").orderBy(*order), Window.orderBy("part")
    row = F.struct(*order)
    ends = staged.groupBy("part").agg(F.min(row).alias("first"), F.max(row).alias("last"))
    before, after = F.lag("last").over(over_parts), F.lead("first").over(over_parts)
    if around:
        whole = over_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        before = F.coalesce(before, F.last("last").over(whole))
        after = F.coalesce(after, F.first("first").over(whole))
    ends = ends.select("part", before.alias("before"), after.alias("after"))
    return (staged.join(F.broadcast(ends), "part")  # one row per range
            .withColumn("previous", F.coalesce(F.lag(row).over(inside), "before"))
            .withColumn("next", F.coalesce(F.lead(row).over(inside), "after"))
            .drop("part", "before", "after"))

"""Window-shaped steps.

Two families:

* Steps over a *period series* (neighbours, trailing statistics, following
  dates) use Spark windows.  A key has at most one row per calendar period, so
  a window partition is bounded by the calendar however large the data.
* Steps over arbitrary rows (shares, ranks, percentiles, group maxima) must
  stand a key that holds a third of all rows.  They aggregate partially and
  join back, or cut all rows into ranges that are summed separately and offset
  by the totals of earlier ranges, which gives exact results.  A NULL key is a
  group of its own throughout.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.session import materialise



def join_back(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Columns of ``side`` attached to the rows of the same key; NULL is a key
    like any other, as it is in a window.

    ``side`` has about one row per key and is written, so that its true size is
    known when the join is planned: that of a few hot keys goes to the rows,
    which are not shuffled by them; only a large one, of many keys, is sorted.
    """
    renamed = side.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[c for c in side.columns if c not in keys])
    named = materialise(renamed, "per-key")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(named, reduce(lambda a, b: a & b, same, F.lit(True)), how).drop(*[f"_key_{k}" for k in keys])


def split_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    weight: Column,
    name: str,
    total: str | None = None,
    ties: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Running sum of ``weight`` by ``order`` within key, the row included.

    Optionally adds the key's ``total``.  ``order`` may have any type that
    sorts; NULLs come first, or last if ``descending``; ``ties`` orders equal
    values, and rows equal in those too come in any order.

    Rows are cut into ranges of (key, order, ties), as many as the session has
    shuffle partitions, so their number follows the volume.  A key or a value
    that holds most of the rows spans many ranges.  Sums run inside the ranges
    and are offset by the totals of the key's earlier ranges.  The cut is
    written, since both steps must see the same one.
    """
    place = F.col(order).desc() if descending else F.col(order).asc()
    sort = [place, *[F.asc(t) for t in ties], F.asc("_row")]
    count = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.withColumn("_w", weight).withColumn("_row", F.monotonically_increasing_id())
    cut = rows.repartitionByRange(count, *[F.asc(k) for k in keys], *sort)
    marked = materialise(cut.withColumn("_range", F.spark_partition_id()), "ranges")
    side = [*keys, "_range"]
    sizes = marked.groupBy(*side).agg(F.sum("_w").alias("_size"))
    over_ranges = Window.partitionBy(*keys).orderBy("_range")
    offsets = sizes.select(
        *side,
        (
            F.sum("_size").over(over_ranges.rowsBetween(Window.unboundedPreceding, 0))
            - F.col("_size")
        ).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("_total"),
    )
    inside = Window.partitionBy(*side).orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    local = marked.withColumn("_local", F.sum("_w").over(inside))
    joined = join_back(local, offsets, side, "inner").withColumn(
        name, F.col("_offset") + F.col("_local")
    )
    if total is not None:
        joined = joined.withColumn(total, F.col("_total"))
    return joined.drop("_range", "_row", "_w", "_offset", "_local", "_total")


def share_of_total(df: DataFrame, keys: Sequence[str], x: str, name: str) -> DataFrame:
    """Value over its key's total; NULL for a zero total."""
    totals = df.groupBy(*keys).agg(F.sum(x).alias("_total"))
    joined = join_back(df, totals, keys)
    return joined.withColumn(name, F.try_divide(F.col(x), F.col("_total"))).drop("_total")


def period_rank(calendar: DataFrame, date: str, name: str = "period_rank") -> DataFrame:
    """Distinct dates of a calendar with their running number.

    The window has no partition key: it only ever sees distinct dates.
    """
    return (
        calendar.select(date)
        .distinct()
        .withColumn(name, F.dense_rank().over(Window.orderBy(date)))
    )


def row_number_by(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    ties: Sequence[str] = (),
    descending: bool = False,
    name: str = "rn",
) -> DataFrame:
    """Row number within key, safe for keys too large for one task."""
    return split_running_sum(
        df, keys, order, F.lit(1).cast("long"), name, ties=ties, descending=descending
    )


def count_over(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows per key attached to every row."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_back(df, counts, keys)


def neighbours(
    df: DataFrame, keys: Sequence[str], order: str, c: str, prev: str, nxt: str
) -> DataFrame:
    """Value of the previous and next row of a period series."""
    window = Window.partitionBy(*keys).orderBy(order)
    return df.withColumns({prev: F.lag(c).over(window), nxt: F.lead(c).over(window)})


def trailing_stats(
    df: DataFrame, keys: Sequence[str], order: str, x: str, n: int, avg: str, count: str
) -> DataFrame:
    """Mean and count of the ``n`` preceding rows of a period series."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    return df.withColumns({avg: F.avg(x).over(window), count: F.count(x).over(window)})


def next_h_array(df: DataFrame, keys: Sequence[str], order: str, h: int, name: str) -> DataFrame:
    """The next ``h`` order values as an array, shorter at the end."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, h)
    return df.withColumn(name, F.collect_list(order).over(window))


def partition_percentile(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    ps: Sequence[float],
    names: Sequence[str],
) -> DataFrame:
    """Exact interpolated percentiles per key.

    Values are first counted, then located by their running count, so no task
    ever holds all values of a key.  NULL values are ignored.
    """
    counted = (
        df.filter(F.col(x).isNotNull())
        .groupBy(*keys, F.col(x).cast("double").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    placed = split_running_sum(counted, keys, "_x", F.col("_n"), "_upto", total="_all")
    found = []
    for i, p in enumerate(ps):
        position = (F.col("_all") - 1) * F.lit(float(p))
        for side, place in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_n"))
            found.append(F.max(F.when(here, F.col("_x"))).alias(f"_{side}{i}"))
    ends = placed.groupBy(*keys).agg(F.max("_all").alias("_all"), *found)
    results = []
    for i, (p, name) in enumerate(zip(ps, names, strict=True)):
        position = (F.col("_all") - 1) * F.lit(float(p))
        low, high = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ends.select(*keys, *results)


def leave_one_out_mean(df: DataFrame, keys: Sequence[str], x: str, name: str) -> DataFrame:
    """Mean of the key's other non-NULL values; NULL if there are none."""
    sums = df.groupBy(*keys).agg(F.sum(x).alias("_sum"), F.count(x).alias("_cnt"))
    own = F.coalesce(F.col(x), F.lit(0.0))
    others = F.col("_cnt") - F.when(F.col(x).isNotNull(), 1).otherwise(0)
    return (
        join_back(df, sums, keys)
        .withColumn(name, F.try_divide(F.col("_sum") - own, others))
        .drop("_sum", "_cnt")
    )


def max_over(df: DataFrame, keys: Sequence[str], c: str, name: str) -> DataFrame:
    """Largest value of the key attached to every row."""
    tops = df.groupBy(*keys).agg(F.max(c).alias(name))
    return join_back(df, tops, keys)


def top1_min(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """The row with the smallest ``order`` per key, as a partial aggregate."""
    entry = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols if c not in order])
    best = df.groupBy(*keys).agg(F.min(entry).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cols])

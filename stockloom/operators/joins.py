"""Join shapes.

No step here hints a broadcast: Spark broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
with AQE splitting hot keys.  Nothing is a cross join and nothing emits all
pairs of a group; where the task asks for a grid or a range, the smaller,
calendar-bounded side is turned into an array or a bucket key first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def inner_equi(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equally named columns."""
    return left.join(right, list(keys), "inner")


def left_default(
    left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: Mapping[str, object]
) -> DataFrame:
    """Left join; the named right-hand columns get a default where missing."""
    joined = left.join(right, list(keys), "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    )


def previous_period_join(
    df: DataFrame, keys: Sequence[str], rank: str, cols: Sequence[str]
) -> DataFrame:
    """Attach ``prev_<col>`` from the same key's row one period rank earlier.

    The rank is part of the join key, so a hot key is spread over its periods.
    """
    earlier = df.select(
        *keys,
        (F.col(rank) + 1).alias(rank),
        *[F.col(c).alias(f"prev_{c}") for c in cols],
    )
    return df.join(earlier, [*keys, rank], "left")


def date_array(df: DataFrame, col: str) -> Column:
    """Sorted distinct dates of a column as one array value.

    The array is a scalar subquery, computed once with partial aggregation.  It
    has one entry per calendar day that occurs, however many rows there are.
    """
    return df.agg(F.sort_array(F.collect_set(F.col(col).cast("date"))).alias("dates")).scalar()


def cross_grid(
    keys: DataFrame,
    dates: Column,
    name: str,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """One row per key row and date, dates optionally limited by key columns.

    ``dates`` comes from :func:`date_array`.  Each key row is expanded in
    place, so the grid needs no join and no shuffle.
    """
    chosen = F.col("_dates")
    if start is not None:
        chosen = F.filter(chosen, lambda d: d >= F.col(start))
    if end is not None:
        chosen = F.filter(chosen, lambda d: d <= F.col(end))
    expanded = keys.withColumn("_dates", dates).withColumn(name, F.explode(chosen))
    return expanded.drop("_dates")


def range_join(
    left: DataFrame,
    right: DataFrame,
    left_value: str,
    right_value: str,
    lo: int,
    hi: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pairs with ``lo <= right_value - left_value <= hi`` for integer values.

    Values are cut into buckets as wide as the range.  A left row then meets
    at most two buckets, which makes this an equi-join on the bucket.
    """
    if hi < lo:
        raise ValueError("empty range")
    width = hi - lo + 1
    first = F.floor((F.col(left_value) + lo) / width)
    last = F.floor((F.col(left_value) + hi) / width)
    spread = left.withColumn("_bucket", F.explode(F.array_distinct(F.array(first, last))))
    placed = right.withColumn("_bucket", F.floor(F.col(right_value) / width))
    gap = F.col(right_value) - F.col(left_value)
    return (
        spread.join(placed, [*keys, "_bucket"], "inner")
        .filter(gap.between(lo, hi))
        .drop("_bucket")
    )


def effective_at(df: DataFrame, as_of, begin: str, end: str) -> DataFrame:
    """Rows whose validity interval contains a date, both ends included."""
    day = F.lit(as_of).cast("date")
    return df.filter((F.col(begin) <= day) & (F.col(end) >= day))


def rolling_reference(
    df: DataFrame, keys: Sequence[str], date: str, value: str, months: int = 12
) -> DataFrame:
    """Values of the same key dated within ``months`` before each row.

    Adds ``reference``, the sorted values dated after ``date - months`` and
    before ``date``.  It is a range window, so no row pairs are produced; rows
    per key and date must be bounded, as they are in a period series.
    """
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    reach = 31 * months
    window = (
        Window.partitionBy(*keys).orderBy(day).rangeBetween(-reach, -1)
    )
    entry = F.struct(F.col(date).alias("d"), F.col(value).alias("v"))
    near = F.collect_list(entry).over(window)
    begin = F.add_months(F.col(date), -months)
    inside = F.filter(F.col("_near"), lambda e: (e["d"] > begin) & e["v"].isNotNull())
    return (
        df.withColumn("_near", near)
        .withColumn("reference", F.array_sort(F.transform(inside, lambda e: e["v"])))
        .drop("_near")
    )


def semi_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows that have a match."""
    return left.join(right, list(keys), "left_semi")


def anti_missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows without a match; NULLs on the right do not empty the result."""
    return left.join(right, list(keys), "left_anti")


def contains_any(
    df: DataFrame, csv_col: str, items: DataFrame, item_col: str, id_cols: Sequence[str],
    flag: str = "contains_any",
) -> DataFrame:
    """Flag rows whose comma list holds at least one of the items.

    Lists are unnested and semi-joined with the distinct items, so the cost is
    linear in list entries; whole entries are compared, never substrings.
    """
    wanted = items.select(F.col(item_col).cast("string").alias("_item")).distinct()
    entries = df.select(*id_cols, F.explode(F.split(F.col(csv_col), ",")).alias("_item"))
    hits = (
        entries.join(wanted, "_item", "left_semi")
        .select(*id_cols)
        .distinct()
        .withColumn(flag, F.lit(True))
    )
    return df.join(hits, list(id_cols), "left").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def latest_version(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """Rows carrying their key's latest date; all of them when several tie.

    A partial aggregate and a semi-join, rather than a ranking window that
    would pull every version of a hot key into one task.
    """
    newest = df.groupBy(*keys).agg(F.max(date).alias(date))
    return df.join(newest, [*keys, date], "left_semi")


def with_scalar(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame to every row, as scalar subqueries."""
    return df.withColumns({c: one_row.select(c).scalar() for c in one_row.columns})


def update_from(
    target: DataFrame, source: DataFrame, keys: Sequence[str], sets: Mapping[str, Column]
) -> DataFrame:
    """New frame with columns of matched rows replaced.

    Expressions in ``sets`` may name target columns directly and source
    columns as ``s_<name>``.  Unmatched rows keep their values.
    """
    side = source.select(
        *[F.col(k) for k in keys],
        *[F.col(c).alias(f"s_{c}") for c in source.columns if c not in keys],
        F.lit(True).alias("_matched"),
    )
    joined = target.join(side, list(keys), "left")
    columns = [
        F.when(F.col("_matched"), sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
        for c in target.columns
    ]
    return joined.select(*columns)


def two_grain_override(
    df: DataFrame, overrides: DataFrame, sku: str, store: str, value: str, as_of
) -> DataFrame:
    """Replace a value by the override in force at store or SKU level.

    ``overrides`` has columns sku, str, ovrd_type, ovrd_qty, min_ovrd_qty,
    max_ovrd_qty, beg_dt, end_dt.  Overlapping rows fan out.
    """
    from stockloom.functions.scalar import override_value

    live = effective_at(overrides, as_of, "beg_dt", "end_dt").drop("beg_dt", "end_dt")
    fine = live.alias("ovr_store")
    coarse = live.alias("ovr_sku")
    base = df.alias("base")
    joined = base.join(
        fine,
        (F.col(f"base.{sku}") == F.col("ovr_store.sku"))
        & (F.col(f"base.{store}") == F.col("ovr_store.str")),
        "left",
    ).join(coarse, F.col(f"base.{sku}") == F.col("ovr_sku.sku"), "left")
    new_value = override_value(F.col(f"base.{value}"), "ovr_store", "ovr_sku")
    return joined.select(
        *[new_value.alias(c) if c == value else F.col(f"base.{c}") for c in df.columns]
    )


def _null_store(df: DataFrame, stores: DataFrame, store: str) -> DataFrame:
    """Rows of no store in particular; they meet overrides of their SKU only."""
    return df.withColumn(store, F.lit(None).cast(stores.schema[store].dataType))


def _dealt(df: DataFrame, tasks: int) -> DataFrame:
    """Few rows that a join turns into many: complete before it, and in tasks
    enough for the many."""
    return df.repartition(max(8, tasks))


# Stores that a row is spread to together.
STORE_BLOCK = 512


def _spread(df: DataFrame, stores: DataFrame, market: str, store: str) -> DataFrame:
    """Rows of a market, each once per store in it.

    The rows are dealt out evenly and meet the market's stores in every part, so
    a market is as many tasks' work as the session has shuffle partitions,
    whether or not its stores could be broadcast.  They come out by block of
    stores, row by row: a row's own columns then are runs, and the stores a short
    sequence that repeats, which a columnar file holds in a fraction of the space
    that the stores in any other order take.  The merge join keeps that order.
    """
    tasks = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = _dealt(df, tasks).withColumn("_part", F.spark_partition_id() % tasks)
    # Numbering a market's stores is nothing beside the rows that come of them.
    number = F.row_number().over(Window.partitionBy(market).orderBy(store))
    numbered = stores.filter(F.col(market).isNotNull()).withColumn("_block", F.floor((number - 1) / STORE_BLOCK))
    # Structs, since collect_list skips NULLs.
    together = F.sort_array(F.collect_list(F.struct(store)))
    blocks = (
        numbered.groupBy(F.col(market).alias("_market"), "_block")
        .agg(F.transform(together, lambda s: s[store]).alias("_stores"))
        .select("_market", "_stores", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("_of_part"))
    )
    met = blocks.repartition(tasks, "_market", "_of_part").hint("merge").join(
        rows.repartition(tasks, market, "_part"),
        (F.col("_market") == F.col(market)) & (F.col("_of_part") == F.col("_part")),
    )
    return met.select(*df.columns, F.explode("_stores").alias(store))


def market_override(
    df: DataFrame, stores: DataFrame, overrides: DataFrame, sku: str, market: str, store: str, value: str, as_of
) -> DataFrame:
    """:func:`two_grain_override` for rows of a market, each once per store in it.

    ``stores`` has columns ``market`` and ``store``.  Stores without any
    override of their own share the rows of their market: those are overridden
    once and spread last, so the grid's rows meet no further join.
    """
    named = effective_at(overrides, as_of, "beg_dt", "end_dt").select(F.col("str").alias(store))
    own = _spread(df, semi_in(stores, named, [store]), market, store)
    fine = two_grain_override(own, overrides, sku, store, value, as_of)
    coarse = two_grain_override(_null_store(df, stores, store), overrides, sku, store, value, as_of)
    return fine.unionByName(_spread(coarse.drop(store), anti_missing(stores, named, [store]), market, store))


def market_override_totals(
    df: DataFrame, stores: DataFrame, overrides: DataFrame, sku: str, market: str, store: str, value: str, as_of,
    count: str, total: str,
) -> DataFrame:
    """Row count and sum of ``value`` by SKU and store of :func:`market_override`.

    The grid is never made: a pair of SKU and store without an override of its
    own has its market's totals, and only other pairs are joined to the rows.
    NULL SKUs and stores are groups like any other.
    """
    def summed(rows: DataFrame, place: str) -> DataFrame:
        over = two_grain_override(rows, overrides, sku, store, value, as_of)
        return over.groupBy(sku, place).agg(F.count("*").alias(count), F.sum(value).alias(total))

    pairs = effective_at(overrides, as_of, "beg_dt", "end_dt").select(
        F.col("sku").alias(sku), F.col("str").alias(store)).distinct()
    # One task a core: each holds the aggregates' memory, and its rows are few.
    tasks = df.sparkSession.sparkContext.defaultParallelism
    rows = df.select(sku, market, value)
    fine = summed(_dealt(rows, tasks).join(stores.join(pairs, store), [sku, market]), store)
    spread = _dealt(summed(_null_store(rows, stores, store), market), tasks).join(stores, market)
    shared = anti_missing(spread, pairs, [sku, store]).drop(market)
    return fine.unionByName(shared).groupBy(sku, store).agg(F.sum(count).alias(count), F.sum(total).alias(total))

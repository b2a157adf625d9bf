"""Grouped aggregates.  All of them combine on the map side first."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockloom.operators.windows import join_back
from stockloom.functions.scalar import safe_divide


def group_agg(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """Named aggregates by key."""
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def distinct_count(df: DataFrame, keys: Sequence[str], c: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.countDistinct(c).alias(name))


def sample_stddev(df: DataFrame, keys: Sequence[str], c: str, name: str) -> DataFrame:
    """Sample standard deviation; NULL for a single row."""
    return df.groupBy(*keys).agg(F.stddev(c).alias(name))


def having(df: DataFrame, keys: Sequence[str], aggs: Mapping[str, Column], pred: Column) -> DataFrame:
    """Groups whose aggregates satisfy a predicate."""
    return group_agg(df, keys, aggs).filter(pred)


def conditional_sum(
    df: DataFrame, keys: Sequence[str], sums: Mapping[str, tuple[Column, Column]]
) -> DataFrame:
    """Sums over the rows meeting a condition each, zero elsewhere."""
    return df.groupBy(*keys).agg(
        *[F.sum(F.when(cond, value).otherwise(0)).alias(n) for n, (cond, value) in sums.items()]
    )


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def dedup_all(df: DataFrame) -> DataFrame:
    """Fully equal rows reduced to one."""
    return df.dropDuplicates()


def with_total(
    df: DataFrame, key: str, aggs: Mapping[str, Column], label: str = "TOTAL"
) -> DataFrame:
    """Detail rows by key plus one grand total row, in a single pass."""
    rolled = df.rollup(key).agg(
        F.grouping(key).alias("_total"), *[expr.alias(n) for n, expr in aggs.items()]
    )
    named = F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(key).cast("string"))
    return rolled.withColumn(key, named).drop("_total")


def ordered_array(
    df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], name: str
) -> DataFrame:
    """Rows of a key nested as an array ordered by a column.

    Meant for period series, where a key has at most one entry per period.
    """
    entry = F.struct(F.col(order), *[F.col(c) for c in cols])
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias(name))


def wape(
    df: DataFrame, keys: Sequence[str], forecasts: Sequence[str], actual: str
) -> DataFrame:
    """Sum of absolute errors over sum of actuals, per forecast column."""
    return df.groupBy(*keys).agg(
        *[
            safe_divide(F.sum(F.abs(F.col(f) - F.col(actual))), F.sum(actual)).alias(f"{f}_mape")
            for f in forecasts
        ]
    )


def weighted_pop_sd(df: DataFrame, keys: Sequence[str], x: str, n: str) -> DataFrame:
    """Count, mean and population deviation of values that carry counts."""
    x, n = F.col(x).cast("double"), F.col(n).cast("double")
    rows = df.select(*keys, x.alias("_x"), n.alias("_n"))
    means = rows.groupBy(*keys).agg(
        F.sum("_n").alias("_cnt"), F.try_divide(F.sum(F.col("_n") * F.col("_x")), F.sum("_n")).alias("_mean")
    )
    # Deviations are summed in a second pass: differences of large sums of
    # squares would lose their digits.
    gap = F.col("_x") - F.col("_mean")
    return (
        join_back(rows, means, keys)
        .groupBy(*keys)
        .agg(
            F.max("_cnt").alias("cnt"),
            F.max("_mean").alias("mean"),
            F.sqrt(F.try_divide(F.sum(F.col("_n") * gap * gap), F.max("_cnt"))).alias("sd"),
        )
    )

"""Row filters and percentile clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockloom.functions.scalar import clip
from stockloom.operators.windows import join_back, partition_percentile

# Codes and limits the filters test for.
SALE_TYPE, NORMAL_STATUS = "S", "NO"
SALES_DAYS = 364
ACTIVE_STATUS = (100, 200, 300)
SLOW_VELOCITY = ("D", "E")
ANY_VELOCITY_DEPTS = (25, 28)


def clip_percentile(
    df: DataFrame, keys: Sequence[str], x: str, lo: float, hi: float, name: str
) -> DataFrame:
    """Winsorise a value to two percentiles of its key; NULL stays NULL."""
    bounds = partition_percentile(df, keys, x, [lo, hi], ["_lo", "_hi"])
    joined = join_back(df, bounds, keys)
    return joined.withColumn(name, clip(x, F.col("_lo"), F.col("_hi"))).drop("_lo", "_hi")


def current_period(df: DataFrame, as_of, begin: str, end: str) -> DataFrame:
    """Calendar rows of the period that contains a date."""
    day = F.lit(as_of).cast("date")
    return df.filter((F.col(begin) <= day) & (F.col(end) >= day))


def normal_sales(df: DataFrame, as_of) -> DataFrame:
    """Completed, non-training sale lines of the trailing year.

    Columns: trans_type, trans_status, training, sls_dt, unt_sls.
    """
    day = F.lit(as_of).cast("date")
    return df.filter(
        (F.col("trans_type") == SALE_TYPE)
        & (F.col("trans_status") == NORMAL_STATUS)
        & (~F.col("training"))
        & (F.col("unt_sls") > 0)
        & F.col("sls_dt").between(F.date_sub(day, SALES_DAYS), F.date_sub(day, 1))
    )


def active_items_filter(df: DataFrame) -> DataFrame:
    """Active, replenished items; slow movers only in some departments.

    Columns: sku_stat_cd, reple_ind, vlcty_cd, dept_nbr.
    """
    always = F.col("dept_nbr").isin(*ANY_VELOCITY_DEPTS)
    return df.filter(
        F.col("sku_stat_cd").isin(*ACTIVE_STATUS)
        & (F.col("reple_ind") == 1)
        & (always | ~F.col("vlcty_cd").isin(*SLOW_VELOCITY))
    )

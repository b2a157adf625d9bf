"""Fiscal calendar dimension, generated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _year_start(year: Column) -> Column:
    """First Monday on or after 29 January."""
    anchor = F.make_date(year, F.lit(1), F.lit(29))
    return F.date_add(anchor, F.pmod(F.lit(9) - F.dayofweek(anchor), F.lit(7)))


def fiscal_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day with its fiscal week, period and year.

    Weeks run Monday (1) to Sunday (7).  Years start on the first Monday on or
    after 29 January and have 52 or 53 weeks in 4-5-4 periods; a 53rd week
    extends the last period.  The number of rows follows from the arguments.
    """
    days = (end - start).days + 1
    if days <= 0:
        raise ValueError(f"the calendar would end {end} before it starts {start}")
    first = F.lit(start.isoformat()).cast("date")
    day = spark.range(0, days, 1, 1).select(F.date_add(first, F.col("id").cast("int")).alias("cal_dt"))
    this_start = _year_start(F.year("cal_dt"))
    year = F.year("cal_dt") - F.when(F.col("cal_dt") < this_start, 1).otherwise(0)
    dated = day.withColumn("fscl_yr", year)
    dated = dated.withColumn("_start", _year_start(F.col("fscl_yr")))
    week = (F.floor(F.datediff("cal_dt", "_start") / 7) + 1).cast("int")
    dated = dated.withColumn("fscl_wk_nbr", week)
    quarter = F.least(F.floor((F.col("fscl_wk_nbr") - 1) / 13), F.lit(3)).cast("int")
    in_quarter = F.col("fscl_wk_nbr") - 1 - quarter * 13
    month = F.when(in_quarter < 4, 1).when(in_quarter < 9, 2).otherwise(3)
    last_week = quarter * 13 + F.when(month == 1, 4).when(month == 2, 9).otherwise(13)
    period = (quarter * 3 + month).cast("int")
    period_end = F.when(
        period == 12, F.date_sub(_year_start(F.col("fscl_yr") + 1), 1)
    ).otherwise(F.date_add(F.col("_start"), (last_week * 7 - 1).cast("int")))
    weekday = (F.pmod(F.dayofweek("cal_dt") - 2, F.lit(7)) + 1).cast("int")
    key = (F.col("fscl_yr") * 100 + F.col("fscl_wk_nbr")).cast("string")
    return dated.select(
        "cal_dt",
        F.date_sub("cal_dt", weekday - 1).alias("fscl_wk_bgn_dt"),
        F.date_add("cal_dt", 7 - weekday).alias("fscl_wk_end_dt"),
        "fscl_wk_nbr",
        period.alias("fscl_prd_nbr"),
        period_end.alias("fscl_prd_end_dt"),
        "fscl_yr",
        key.alias("fscl_yr_wk_key_val"),
        weekday.alias("day_of_wk_nbr"),
    )


def covering_calendar(df: DataFrame, date: str, before: int = 2, after: int = 2) -> DataFrame:
    """Whole years around the dates of a column: ``before`` years of padding for
    smoothing and comparison, ``after`` for the horizon."""
    low, high = df.agg(F.year(F.min(F.col(date).cast("date"))), F.year(F.max(F.col(date).cast("date")))).first()
    if low is None:
        raise ValueError(f"no dates in {date} to build a calendar for")
    return fiscal_calendar(df.sparkSession, dt.date(low - before, 1, 1), dt.date(high + after, 12, 31))


def in_calendar(df: DataFrame, date: str, calendar: DataFrame) -> DataFrame:
    """``df`` with the calendar's columns at a date; a date without a calendar
    row is an error, not a lost row."""
    marked = calendar.withColumn("_known", F.lit(True))
    joined = df.join(marked, F.col(date) == F.col("cal_dt"), "left")
    missing = F.concat(F.lit("outside the calendar: "), F.coalesce(F.col(date).cast("string"), F.lit("no date")))
    sure = {
        f.name: F.when(F.col("_known"), F.col(f.name)).otherwise(F.raise_error(missing).cast(f.dataType))
        for f in calendar.schema if f.name != "cal_dt"
    }
    return joined.withColumns(sure).drop("_known", "cal_dt")


def period_dates(calendar: DataFrame, spec) -> DataFrame:
    """Dates that stand for a period: week ends, or every day."""
    if spec.freq == "week":
        calendar = calendar.filter(F.col("cal_dt") == F.col("fscl_wk_end_dt"))
    return calendar.select(F.col("cal_dt").alias("dt"))

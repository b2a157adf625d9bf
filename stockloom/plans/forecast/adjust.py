"""Forecast adjustments and accuracy reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.functions import output_transform, period_index
from stockloom.operators.aggregates import wape
from stockloom.operators.joins import update_from
from stockloom.spec import SeriesSpec

FORECASTS = ("forecast1", "forecast2", "forecast3", "forecast4", "one_forecast")
REACTIVE = FORECASTS[:3]
# Fixed value: periods that must err the same way before a correction.
TREND = 3


def reactive_adjust(fact: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Correct own-period forecasts for a persistent error.

    If the last three errors (forecast minus actual) have the same strict sign
    their mean is subtracted, not below zero.  Results are rounded half up.
    Only own-period rows between the dates are changed.
    """
    own = fact.filter(
        (F.col("snpsht") == F.col("fcst")) & F.col("fcst").between(F.lit(start), F.lit(end))
    )
    in_order = Window.partitionBy("agg_level").orderBy("fcst")

    def adjusted(name: str) -> Column:
        error = F.col(name) - F.col("actual")
        last = [F.lag(error, i).over(in_order) for i in range(1, TREND + 1)]
        low, high = F.least(*last), F.greatest(*last)
        known = last[0].isNotNull() & last[1].isNotNull() & last[2].isNotNull()
        steady = known & ((low > 0) | (high < 0))
        moved = F.greatest(F.col(name) - (last[0] + last[1] + last[2]) / TREND, F.lit(0.0))
        value = F.when(steady, moved).otherwise(F.col(name))
        return F.floor(F.coalesce(value, F.lit(0.0)) + 0.5).cast("double")

    changed = own.select(
        "snpsht", "fcst", "agg_level", *[adjusted(f).alias(f) for f in REACTIVE]
    )
    return update_from(
        fact, changed, ["snpsht", "fcst", "agg_level"], {f: F.col(f"s_{f}") for f in REACTIVE}
    )


def percent_adjust(fact: DataFrame, percent: float, sign: int, spec: SeriesSpec) -> DataFrame:
    """All forecasts but the chosen one raised or lowered by a percentage."""
    factor = 1 + abs(percent) / 100 if sign > 0 else 1 - abs(percent) / 100

    def scaled(name: str) -> Column:
        x = F.col(name) * F.lit(factor)
        value = output_transform(x, spec.round_output, spec.nonneg_output)
        return F.when(F.col(name).isNotNull(), value)

    return fact.withColumns({f: scaled(f) for f in FORECASTS[:4]})


def _at_lag(fact: DataFrame, lag: int, start: dt.date, end: dt.date, spec: SeriesSpec) -> DataFrame:
    gap = period_index("fcst", spec.freq) - period_index("snpsht", spec.freq)
    return fact.filter(
        (gap == lag - 1)
        & F.col("actual").isNotNull()
        & F.col("fcst").between(F.lit(start), F.lit(end))
    )


def error_report(
    fact: DataFrame, lag: int, start: dt.date, end: dt.date, spec: SeriesSpec
) -> DataFrame:
    """Weighted error ratio of each forecast per snapshot and target."""
    return wape(_at_lag(fact, lag, start, end, spec), ["snpsht", "fcst"], FORECASTS, "actual")


def value_report(
    fact: DataFrame, lag: int, start: dt.date, end: dt.date, spec: SeriesSpec
) -> DataFrame:
    """Summed forecasts and actuals per snapshot and target."""
    return _at_lag(fact, lag, start, end, spec).groupBy("snpsht", "fcst").agg(
        *[F.sum(f).alias(f"{f}_value") for f in FORECASTS], F.sum("actual").alias("actual_value")
    )

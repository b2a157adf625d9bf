"""Scoring the forecasts and choosing one by rules."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from stockloom.calendar import period_dates
from stockloom.functions import (
    period_index,
    safe_divide,
    select_by_least,
    strict_greatest,
    strict_least,
    trunc_period,
)
from stockloom.operators.joins import date_array, update_from
from stockloom.spec import SeriesSpec

# Periods of the medium, short and long error windows.
ERROR_WINDOWS = (6, 2, 52)
FACT_KEYS = ["snpsht", "fcst", "agg_level"]


def external_forecast(fact: DataFrame, external: DataFrame) -> DataFrame:
    """The fact with forecast 4 taken from an outside forecast.

    ``external`` has columns snpsht, fcst, agg_level, value.
    """
    return update_from(fact, external, FACT_KEYS, {"forecast4": F.col("s_value")})


def selection_base(
    fact: DataFrame, as_of: dt.date, spec: SeriesSpec, use_forecast4: bool = False
) -> DataFrame:
    """Forecasts for their own snapshot period with absolute percent errors.

    With ``use_forecast4`` the outside forecast competes in place of the third.
    Columns: fcst, agg_level, actual, forecast1..3, mape1..3.
    """
    third = "forecast4" if use_forecast4 else "forecast3"
    zero = F.lit(0.0)

    def error(name: str) -> Column:
        miss = F.abs(F.coalesce(F.col(name), zero) - F.col("actual"))
        return F.coalesce(safe_divide(miss, "actual"), F.lit(1.0))

    last = trunc_period(F.lit(as_of), spec.freq)
    return fact.filter((F.col("snpsht") == F.col("fcst")) & (F.col("fcst") <= last)).select(
        "fcst",
        "agg_level",
        "actual",
        F.greatest(F.coalesce("forecast1", zero), zero).alias("forecast1"),
        F.coalesce("forecast2", zero).alias("forecast2"),
        strict_greatest(F.col(third), zero).alias("forecast3"),
        error("forecast1").alias("mape1"),
        error("forecast2").alias("mape2"),
        error(third).alias("mape3"),
    )


# Errors are summed in whole units of this size, so that a difference of two
# running sums is exact.
ERROR_UNITS, WHOLE = 1e9, "decimal(38,0)"


def _running_sums(frame: WindowSpec) -> dict[str, Column]:
    """Rows, and count, sum and sum of squares of the three errors, in a frame
    that grows with the row: each costs one addition per row."""
    out = {"rows": F.count(F.lit(1)).over(frame)}
    for i in (1, 2, 3):
        units = F.round(F.col(f"mape{i}") * ERROR_UNITS).try_cast(WHOLE)
        out[f"n{i}"] = F.count(units).over(frame)
        out[f"s{i}"] = F.try_sum(units).over(frame)
        out[f"q{i}"] = F.try_sum(F.try_multiply(units, units)).over(frame)
    return out


def _window_sum(name: str, n: int) -> Column:
    """What the ``n`` periods before a row add to a running sum."""
    upto, before = F.col(f"_{name}_1"), F.col(f"_{name}_{n + 1}")
    return upto - F.coalesce(before, F.lit(0).cast("long" if name[0] in "rn" else WHOLE))


def rolling_error_stats(
    selection: DataFrame, spec: SeriesSpec, period_end: dt.date | None = None,
    windows: tuple[int, int, int] = ERROR_WINDOWS,
) -> DataFrame:
    """Mean and deviation of past errors and each forecast's gap to the best.

    Windows count calendar periods, so periods a key skipped still age.  A row
    needs an earlier row within the short window; the overall first period is
    kept with unknown errors.  All windows share one partitioning by key, in
    which a key has one row per period.

    Sums run once through each key's periods and are exact; a window is the
    difference of two of them, however long it is.  Errors count to 9 decimals;
    a deviation whose sums exceed 38 digits is unknown.
    """
    medium, short, long = windows
    by_key = Window.partitionBy("agg_level").orderBy("_period")
    periods = date_array(selection, "fcst")
    stats = selection.withColumns(
        {
            "_period": period_index("fcst", spec.freq),
            "time_rank": F.array_position(periods, F.col("fcst")).cast("int"),
        }
    )
    if period_end is not None:
        stats = stats.withColumn("_late", F.col("fcst") > F.lit(period_end))
    # Everything up to one period ago, and up to where each window begins.
    starts = {1, min(windows) + 1, *(n + 1 for n in windows)}
    stats = stats.withColumns({
        f"_{name}_{k}": total
        for k in sorted(starts)
        for name, total in _running_sums(by_key.rangeBetween(Window.unboundedPreceding, -k)).items()
    })
    added = {"_seen": _window_sum("rows", min(windows))}
    for i in (1, 2, 3):
        for suffix, n in (("", medium), ("_short", short), ("_long", long)):
            count, total = _window_sum(f"n{i}", n), _window_sum(f"s{i}", n)
            added[f"_avg{i}{suffix}"] = F.try_divide(total.cast("double"), count) / ERROR_UNITS
            if suffix != "_short":
                squares = F.try_multiply(count.cast(WHOLE), _window_sum(f"q{i}", n))
                spread = F.try_subtract(squares, F.try_multiply(total, total)).cast("double")
                added[f"_sd{i}{suffix}"] = F.sqrt(F.try_divide(spread, count * (count - 1))) / ERROR_UNITS
    stats = stats.withColumns(added).filter((F.col("_seen") > 0) | (F.col("time_rank") == 1))
    if period_end is not None:
        stats = stats.filter(~F.col("_late") | (F.col("time_rank") == 1))
    m1, m2, m3 = F.col("mape1"), F.col("mape2"), F.col("mape3")
    best = (
        F.when((m1 > m2) & (m3 > m2), "forecast2")
        .when((m2 > m3) & (m1 > m3), "forecast3")
        .when((m2 > m1) & (m3 > m1), "forecast1")
        .otherwise("Default - FORECAST2")
    )
    stats = stats.withColumn("best_forecast", best)
    gap_one = F.col("time_rank") - F.lag("time_rank").over(by_key) == 1
    columns = [
        F.when(gap_one, F.lag("best_forecast").over(by_key)).alias("prev_best_forecast"),
        *[F.col(c) for c in selection.columns],
        F.col("best_forecast"),
        F.col("time_rank"),
    ]
    for kind, suffix, default in (
        ("avg", "", 1.0), ("avg", "_short", 1.0), ("avg", "_long", 1.0),
        ("sd", "", 0.0), ("sd", "_long", 0.0),
    ):
        raw = [F.col(f"_{kind}{i}{suffix}") for i in (1, 2, 3)]
        low = strict_least(*raw)
        columns.append(low.alias(f"least_{kind}{suffix}"))
        for i, value in zip((1, 2, 3), raw, strict=True):
            known = F.coalesce(value, F.lit(default))
            columns.append(known.alias(f"{kind}{i}{suffix}"))
            columns.append((known - low).alias(f"least_{kind}{i}{suffix}"))
    return stats.select(*columns)


def _gaps() -> list[Column]:
    return [F.col(f"least_avg{i}") for i in (1, 2, 3)]


def _choice_name() -> Column:
    """Label of the chosen forecast; ties are marked as defaults."""
    g1, g2, g3 = _gaps()
    low = strict_least(g1, g2, g3)
    return (
        F.when((low == g2) & ((g1 == g2) | (g2 == g3)), "Default - Forecast2")
        .when((low == g3) & (g1 == g3), "Default - Forecast1")
        .when(low == g2, "Forecast2")
        .when(low == g3, "Forecast3")
        .when(low == g1, "Forecast1")
    )


def past_decisions(stats: DataFrame, as_of: dt.date) -> DataFrame:
    """Rule-based choice for every scored period up to a date.

    ``best_value`` is the choice hindsight would have made.
    """
    zero = F.lit(0.0)
    f1, f2, f3 = (F.col(f"forecast{i}") for i in (1, 2, 3))
    chosen = select_by_least(
        _gaps(), [F.coalesce(f1, zero), f2, F.coalesce(f3, zero)], F.coalesce(f1, zero)
    )
    miss = [F.abs(f - F.coalesce("actual", zero)) for f in (f1, f2, f3)]
    least = strict_least(*miss)
    hindsight = F.when(least == miss[1], f2).when(least == miss[0], f1).when(least == miss[2], f3)
    return stats.filter(F.col("fcst") <= F.lit(as_of)).select(
        F.coalesce(chosen, zero).alias("one_value"),
        _choice_name().alias("one_selection"),
        "actual", "forecast1", "forecast2", "forecast3", "fcst", "agg_level",
        *_gaps(),
        hindsight.alias("best_value"),
    )


def current_period_date(calendar: DataFrame, spec: SeriesSpec, as_of: dt.date) -> Column:
    """Last period date of the fiscal week that contains a date."""
    day = F.lit(as_of)
    week = calendar.filter((F.col("fscl_wk_bgn_dt") <= day) & (F.col("fscl_wk_end_dt") >= day))
    return period_dates(week, spec).agg(F.max("dt")).scalar()


def rules_selection(
    stats: DataFrame, fact: DataFrame, calendar: DataFrame, spec: SeriesSpec, as_of: dt.date
) -> DataFrame:
    """Decisions for past periods and the outlook of the current snapshot.

    Future periods reuse the current period's decision.  Their third forecast
    is the one of the snapshot at the target itself, and a tie of first and
    third takes the third there (for past periods it takes the first).
    """
    past = past_decisions(stats, as_of)
    now = current_period_date(calendar, spec, as_of)
    decision = past.filter(F.col("fcst") == now).select("agg_level", "one_selection", *_gaps())
    outlook = fact.filter((F.col("snpsht") == now) & (F.col("fcst") >= now))
    at_target = fact.filter((F.col("snpsht") == F.col("fcst")) & (F.col("fcst") >= now)).select(
        "fcst", "agg_level", F.col("forecast3").alias("_third")
    )
    zero = F.lit(0.0)
    f1, f2, third = F.col("forecast1"), F.col("forecast2"), F.coalesce("_third", zero)
    chosen = select_by_least(_gaps(), [F.coalesce(f1, zero), f2, third], third)
    unknown = F.lit(None).cast("double")
    future = (
        outlook.drop("forecast3")
        .join(at_target, ["fcst", "agg_level"])
        .join(decision, "agg_level")
        .select(
            F.coalesce(chosen, zero).alias("one_value"),
            "one_selection",
            "actual",
            F.coalesce(f1, zero).alias("forecast1"),
            F.coalesce(f2, zero).alias("forecast2"),
            third.alias("forecast3"),
            "fcst",
            "agg_level",
            *[unknown.alias(f"least_avg{i}") for i in (1, 2, 3)],
            unknown.alias("best_value"),
        )
    )
    return past.unionByName(future)


def apply_rules(
    fact: DataFrame, decisions: DataFrame, use_forecast4: bool = False
) -> DataFrame:
    """one_forecast of every target of a snapshot, by that period's decision."""
    third = F.col("forecast4") if use_forecast4 else F.col("forecast3")
    source = decisions.filter(F.col("least_avg1").isNotNull() | F.col("best_value").isNotNull())
    source = source.select(F.col("fcst").alias("snpsht"), "agg_level", *_gaps())
    gaps = [F.col(f"s_least_avg{i}") for i in (1, 2, 3)]
    chosen = select_by_least(
        gaps, [F.col("forecast1"), F.col("forecast2"), third], F.col("forecast1")
    )
    return update_from(fact, source, ["snpsht", "agg_level"], {"one_forecast": chosen})

"""Forecast 1: earlier years weighted by their likeness to the recent quarter.

For a snapshot the quarter before it is compared with the same quarter of
earlier years.  None of that depends on the target period, so everything up to
the weights is kept at (snapshot, key) grain and targets are added last
(:func:`with_targets`); a horizon of H periods costs no H-fold work.

After the history is partitioned by key, the only further shuffle is the
lookup of the earlier years' values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.calendar import period_dates
from stockloom.functions import (
    output_transform,
    period_index,
    safe_divide,
    split_key,
    trunc_period,
    year_boundary_diff,
)
from stockloom.operators.joins import date_array
from stockloom.plans.forecast.history import densify_history
from stockloom.plans.forecast.sliding import MONTH, YEAR, percentile_batches
from stockloom.session import materialise
from stockloom.spec import SeriesSpec

# Years of history compared, and the modulus applied to the
# period offset for every frequency.
MAX_YEARS = 6
OFFSET_MODULUS = 52


def _diff(a: Column, b: Column, freq: str) -> Column:
    return period_index(a, freq) - period_index(b, freq)


def snapshot_periods(
    calendar: DataFrame, hist: DataFrame, spec: SeriesSpec, start: dt.date, end: dt.date,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Evaluation periods per snapshot: snpsht, eval_dt, yr, offset, first_eval.

    Only (snapshot, yr) groups that cover a whole quarter remain;
    ``first_eval`` is the first of a group's dates that has a counterpart in
    the recent quarter.  Snapshot and evaluation dates meet on the calendar
    year, an equi-join of two calendars whose size does not depend on the data.
    """
    bounds = hist.agg(F.struct(F.min("dt").alias("lo"), F.max("dt").alias("hi"))).scalar()
    lo, hi = bounds["lo"], bounds["hi"]
    periods = period_dates(calendar, spec)
    last = min(end, as_of) if as_of else end
    snapshots = (
        periods.filter(F.col("dt").between(F.lit(start), F.lit(last)) & (F.col("dt") >= lo))
        .select(
            F.col("dt").alias("snpsht"),
            F.explode(F.sequence(F.lit(0), F.lit(MAX_YEARS))).alias("_back"),
        )
        .withColumn("_year", F.year("snpsht") - F.col("_back"))
    )
    evals = periods.filter((F.col("dt") >= lo) & (F.col("dt") <= hi)).select(
        F.col("dt").alias("eval_dt"), F.year("dt").alias("_year")
    )
    pairs = snapshots.join(evals, "_year").filter(F.col("snpsht") > F.col("eval_dt"))
    months = F.col("_back") * 12
    same = _diff(F.add_months("snpsht", -months), F.col("eval_dt"), spec.freq)
    later = _diff(F.add_months("snpsht", -(months - 12)), F.col("eval_dt"), spec.freq)
    near = pairs.filter(same.between(1, spec.window) | later.between(1, spec.window))
    offset = F.greatest(same, later) % OFFSET_MODULUS
    shifted = F.date_add("eval_dt", (F.col("offset") * spec.days_per_period).cast("int"))
    dated = near.withColumn("offset", offset).withColumn(
        "yr", year_boundary_diff("snpsht", shifted)
    )
    whole = Window.partitionBy("snpsht", "yr")
    recent = F.collect_set(F.when(F.col("yr") == 0, F.col("offset")))
    met = F.when(F.array_contains("_recent", F.col("offset")), F.col("eval_dt"))
    return (
        dated.withColumn("_n", F.count(F.lit(1)).over(whole))
        .filter(F.col("_n") == spec.window)
        .withColumn("_recent", recent.over(Window.partitionBy("snpsht")))
        .withColumn("first_eval", F.min(met).over(whole))
        .select("snpsht", "eval_dt", "yr", "offset", "first_eval")
    )


def with_targets(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per target period of the snapshot, the snapshot's own first."""
    step = F.explode(F.sequence(F.lit(0), F.lit(spec.horizon - 1)))
    return df.withColumn("_step", step).select(
        "*", F.date_add("snpsht", F.col("_step") * spec.days_per_period).alias("fcst")
    ).drop("_step")


def forecast_periods(
    calendar: DataFrame, hist: DataFrame, spec: SeriesSpec, start: dt.date, end: dt.date,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Evaluation periods per snapshot and target."""
    return with_targets(snapshot_periods(calendar, hist, spec, start, end, as_of), spec)


def snapshot_samples(
    hist: DataFrame, periods: DataFrame, spec: SeriesSpec,
    span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """History at the evaluation periods with its share of the quarter.

    Columns: agg_level, start_dt, snpsht, yr, offset, first_eval, value, share
    and eval_dt.
    """
    taken = hist.select("agg_level", "start_dt", "dt", "value").join(
        periods, F.col("dt") == F.col("eval_dt")
    )
    quarter = Window.partitionBy("agg_level", "snpsht", "yr")
    share = safe_divide(F.col("value"), F.sum("value").over(quarter))
    return taken.withColumn("share", share).drop("dt")


def forecast_samples(hist: DataFrame, periods: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Samples per snapshot and target, for a target-level ``periods`` table."""
    per_snapshot = periods.drop("fcst").distinct()
    samples = snapshot_samples(hist, per_snapshot, spec)
    return with_targets(samples, spec).select(
        "snpsht", "fcst", F.col("eval_dt").alias("dt"), "agg_level", "value", "share"
    )


def _with_calendar_gaps(hist: DataFrame, calendar: DataFrame, spec: SeriesSpec) -> DataFrame:
    """History plus NULL rows for calendar periods no key has any data for.

    Such a period still takes part in the comparison, with a share of zero.
    """
    known = date_array(hist, "dt")
    periods = date_array(period_dates(calendar, spec), "dt")
    missing = F.filter(
        "_absent", lambda d: (d > F.col("start_dt")) & (d <= F.col("_last"))
    )
    gaps = (
        hist.filter(F.col("dt") == F.col("start_dt"))
        .groupBy("agg_level")
        .agg(F.min("start_dt").alias("start_dt"))
        .withColumns({"_absent": F.array_except(periods, known), "_last": F.array_max(known)})
        .select("agg_level", "start_dt", F.explode(missing).alias("dt"))
        .withColumn("value", F.lit(None).cast("double"))
        .withColumn("dayofweek", F.dayofweek("dt"))
    )
    return hist.unionByName(gaps)


def _faced(items: Column, at: Column) -> Column:
    """Sums over the pairs of an earlier entry and each recent one of its offset.

    ``at`` lists the recent entries by offset.  Values that are NULL count as
    pairs but enter neither sums nor counts of their side.
    """
    nothing, none = F.lit(0.0), F.lit(0).cast("long")
    zero = F.struct(*[(none if n.endswith("_n") or n == "pairs" else nothing).alias(n)
                      for n in ("cur", "cur_n", "prev", "prev_n", "floor", "gap", "pairs")])

    def add(sums: Column, p: Column, c: Column) -> Column:
        def known(v: Column) -> Column:
            return F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")

        gap = F.coalesce(c["share"], nothing) - F.coalesce(p["share"], nothing)
        floored = F.when(p["value"].isNotNull(), F.greatest(p["value"], F.lit(1.0)))
        steps = {
            "cur": F.coalesce(c["value"], nothing), "cur_n": known(c["value"]),
            "prev": F.coalesce(p["value"], nothing), "prev_n": known(p["value"]),
            "floor": F.coalesce(floored, nothing), "gap": gap * gap, "pairs": F.lit(1).cast("long"),
        }
        return F.struct(*[(sums[n] + step).alias(n) for n, step in steps.items()])

    return F.aggregate(items, zero, lambda sums, p: F.aggregate(
        F.get(at, p["offset"].cast("int")), sums, lambda inner, c: add(inner, p, c)))


def year_comparison(
    periods: DataFrame, hist: DataFrame, calendar: DataFrame, spec: SeriesSpec,
    span: tuple[dt.date, dt.date] | None = None,
) -> DataFrame:
    """Growth factor and likeness of each earlier year, per snapshot and key.

    Columns: agg_level, snpsht, yr, cur_value, prev_value, comp_fctr,
    similarity.  Years that start before the key's history are left out.

    Quarters (13 or 91 entries) are nested per (key, snapshot).  The recent one is
    laid out by offset, so the entries that face an earlier one are found by
    place; each year is summed in one pass inside the row, and only its sums
    leave it.
    """
    full = _with_calendar_gaps(hist, calendar, spec).repartition("agg_level")
    samples = snapshot_samples(full, periods, spec, span).filter(
        (F.col("yr") == 0) | (F.col("first_eval") >= F.col("start_dt"))
    )
    entry = F.struct("offset", "value", "share")
    quarters = samples.groupBy("agg_level", "snpsht", "yr").agg(
        F.array_sort(F.collect_list(entry)).alias("items")
    )
    recent = F.when(F.col("yr") == 0, F.col("items"))
    earlier = F.when(F.col("yr") != 0, F.struct("yr", "items"))
    nested = quarters.groupBy("agg_level", "snpsht").agg(
        F.flatten(F.collect_list(recent)).alias("recent"),
        F.collect_list(earlier).alias("earlier"),
    )
    offsets = F.sequence(F.lit(0), F.lit(OFFSET_MODULUS - 1))
    places = F.transform(offsets, lambda o: F.filter("recent", lambda c: c["offset"] == o))
    # The lambda's variable holds the places, so they are laid out once per row.
    years = F.flatten(F.transform(F.array(places), lambda at: F.transform(
        "earlier", lambda e: F.struct(e["yr"].alias("yr"), _faced(e["items"], at).alias("f")))))
    paired = nested.select("agg_level", "snpsht", F.explode(years).alias("y")).filter("y.f.pairs > 0")
    f = F.col("y.f")
    sums = paired.select(
        "agg_level", "snpsht", "y.yr",
        F.when(f["cur_n"] > 0, f["cur"]).alias("cur_value"),
        F.when(f["prev_n"] > 0, f["prev"]).alias("prev_value"),
        F.try_divide(f["cur"], f["cur_n"]).alias("_cur_avg"),
        F.try_divide(f["prev"], f["prev_n"]).alias("_prev_avg"),
        F.try_divide(f["floor"], f["prev_n"]).alias("_floor_avg"),
        f["gap"].alias("_gap"),
    )
    low_volume = (F.col("cur_value") <= spec.window) & (F.col("prev_value") <= spec.window)
    falling = F.col("cur_value") < F.col("prev_value")
    growth = F.when(
        low_volume | falling, safe_divide("_cur_avg", "_prev_avg")
    ).otherwise(safe_divide("_cur_avg", "_floor_avg"))
    return sums.select(
        "agg_level",
        "snpsht",
        "yr",
        "cur_value",
        "prev_value",
        F.coalesce(growth, F.lit(1.0)).alias("comp_fctr"),
        safe_divide(F.lit(1.0), "_gap").alias("similarity"),
    )


def cap_growth(comparison: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Growth factors above the 90th percentile replaced by the median.

    The reference values are the key's factors at snapshots of the year before.
    They are the same for all years of a snapshot, so one run per key slides
    over its snapshots: a factor enters a sorted list once and leaves it once,
    and a key takes memory for its own snapshots only.  Percentiles
    are taken over (row, reference) pairs: each value occurs once per yr row
    and target, which matters for interpolation and enters as a repetition
    count.
    """
    shares = {"p10": 0.1, "p50": 0.5, "p90": 0.9}
    day = F.year("snpsht") * YEAR + F.month("snpsht") * MONTH + F.dayofmonth("snpsht")
    snapshots = comparison.groupBy("agg_level", "snpsht").agg(
        F.collect_list("comp_fctr").alias("own"), F.count(F.lit(1)).alias("rows"))
    entry = F.struct(day.alias("day"), "snpsht", "own", (F.col("rows") * spec.horizon).alias("copies"))
    keys = snapshots.groupBy("agg_level").agg(F.array_sort(F.collect_list(entry)).alias("s")).select(
        "agg_level", F.col("s.snpsht").alias("dts"), F.col("s.day").alias("days"),
        F.transform("s", lambda e: F.size(e["own"])).alias("sizes"), F.col("s.copies").alias("copies"),
        F.flatten("s.own").alias("vals"))
    listed = ", ".join(f"p{i} array<double>" for i in range(len(shares)))
    found = keys.mapInArrow(percentile_batches(tuple(shares.values())), f"agg_level string, dts array<date>, {listed}")
    zipped = F.arrays_zip("dts", *[f"p{i}" for i in range(len(shares))])
    limits = found.select("agg_level", F.explode(zipped).alias("r")).select(
        "agg_level", F.col("r.dts").alias("snpsht"), *[F.col(f"r.p{i}").alias(name) for i, name in enumerate(shares)])
    capped = F.when(F.col("comp_fctr") > F.col("p90"), F.col("p50")).otherwise(F.col("comp_fctr"))
    return comparison.join(limits, ["agg_level", "snpsht"]).withColumn("comp_fctr", capped)


def similarity_weights(comparison: DataFrame) -> DataFrame:
    """Likeness of each year over the total of the (snapshot, key)."""
    group = Window.partitionBy("agg_level", "snpsht")
    total = F.sum("similarity").over(group)
    return comparison.withColumns(
        {
            "weight": safe_divide(F.col("similarity"), total),
            "years": F.count(F.lit(1)).over(group),
        }
    )


def _same_weekday(target: Column, yr: Column) -> Column:
    """Date ``yr`` years earlier in the same Sunday week on the same weekday.

    NULL if that date is not in the calendar year ``yr`` back.
    """
    back = F.add_months(target, -12 * yr)
    day = F.date_add(trunc_period(back, "week"), F.dayofweek(target) - 1)
    return F.when(year_boundary_diff(target, day) == yr, day)


def forecast1(
    hist: DataFrame, weights: DataFrame, periods: DataFrame, spec: SeriesSpec,
    span: tuple[dt.date, dt.date] | None = None, fill: float | None = 0.0,
) -> DataFrame:
    """The forecast fact with forecast 1 set.

    With more than one earlier year: weighted, growth-adjusted values of those
    years.  With one: mean of the recent quarter.  With none: mean of all
    samples.  Forecasts 2 and 3 start as ``fill``.
    """
    def transform(x):
        return output_transform(x, spec.round_output, spec.nonneg_output)

    values = hist.select("agg_level", "dt", "value")
    earlier = with_targets(weights.filter(F.col("years") > 1), spec).withColumn(
        "dt", _same_weekday(F.col("fcst"), F.col("yr"))
    )
    multi = (
        earlier.join(values, ["agg_level", "dt"])
        .groupBy("snpsht", "fcst", "agg_level")
        .agg(F.sum(F.col("value") * F.col("weight") * F.col("comp_fctr")).alias("_f1"))
    )
    means = (
        snapshot_samples(hist, periods, spec, span)
        .groupBy("agg_level", "snpsht")
        .agg(
            F.avg(F.when(F.col("yr") == 0, F.col("value"))).alias("_recent"),
            F.count(F.when(F.col("yr") == 0, 1)).alias("_recent_n"),
            F.avg("value").alias("_all"),
        )
    )
    years = weights.groupBy("agg_level", "snpsht").agg(F.max("years").alias("_years"))
    few = (
        means.join(years, ["agg_level", "snpsht"], "left")
        .filter(
            F.col("_years").isNull() | ((F.col("_years") <= 1) & (F.col("_recent_n") > 0))
        )
        .withColumn(
            "_f1", F.when(F.col("_years").isNull(), F.col("_all")).otherwise(F.col("_recent"))
        )
    )
    few = with_targets(few.select("snpsht", "agg_level", "_f1"), spec)
    fact = multi.unionByName(few.select("snpsht", "fcst", "agg_level", "_f1"))
    actual = values.select("agg_level", F.col("dt").alias("fcst"), F.col("value").alias("actual"))
    unset = F.lit(None).cast("double")
    start = unset if fill is None else F.lit(fill)
    return fact.join(actual, ["agg_level", "fcst"], "left").select(
        "snpsht",
        "fcst",
        "agg_level",
        transform(F.col("_f1")).alias("forecast1"),
        start.alias("forecast2"),
        start.alias("forecast3"),
        unset.alias("forecast4"),
        unset.alias("one_forecast"),
        F.col("actual").cast("double").alias("actual"),
        *split_key("agg_level", spec.keys),
    )


def staged_forecast1(
    raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, start: dt.date, end: dt.date,
    as_of: dt.date, cap: bool = True, fill: float | None = 0.0,
) -> DataFrame:
    """Forecast 1 from raw history.

    The dense history and the evaluation periods are read by many later steps
    and are therefore written once as stages.
    """
    span = (start, end)
    hist = materialise(densify_history(raw, spec), "hist")
    periods = materialise(snapshot_periods(calendar, hist, spec, start, end, as_of), "periods")
    comparison = year_comparison(periods, hist, calendar, spec, span)
    if cap:
        comparison = cap_growth(comparison, spec)
    weights = materialise(similarity_weights(comparison), "weights")
    return forecast1(hist, weights, periods, spec, span, fill)


def fresh_snapshot(
    fact: DataFrame, raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, as_of: dt.date
) -> DataFrame:
    """The current period's rows that the fact does not have yet.

    Growth factors are used as computed and forecasts 2 and 3 start as NULL.
    Of the fact only the current snapshot is read, so the cost does not depend
    on its history, and a second run of a period adds nothing.
    """
    back = (as_of.weekday() + 1) % 7 if spec.freq == "week" else 0
    snapshot = as_of - dt.timedelta(days=back)
    fresh = staged_forecast1(raw, calendar, spec, snapshot, snapshot, as_of, cap=False, fill=None)
    key = ["snpsht", "fcst", "agg_level"]
    present = fact.filter(F.col("snpsht") == F.lit(snapshot)).select(*key)
    return fresh.join(present, key, "left_anti")


def forecast1_incremental(
    fact: DataFrame, raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, as_of: dt.date
) -> DataFrame:
    """The fact with the current period's snapshot appended; past rows as they are."""
    return fact.unionByName(fresh_snapshot(fact, raw, calendar, spec, as_of))

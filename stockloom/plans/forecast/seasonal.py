"""Seasonality of a series: calendar, clean series, seasonal means.

Everything after the first aggregation is a window or a grouping by key, so a
series is shuffled once.  Calendar frames are bounded by construction and are
the only ones whose windows have no partition key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockloom.calendar import in_calendar
from stockloom.functions import clip, safe_divide
from stockloom.plans.forecast.history import keyed
from stockloom.spec import SeriesSpec

# Holidays that get a season of their own, and the weight decay
# per step of distance when neighbouring seasons are averaged.
NEW_YEAR, THANKSGIVING, CHRISTMAS = "NEW YEARS", "THANKSGIVING", "CHRISTMAS"
LONG_DECAY, SHORT_DECAY = 0.5, 0.0
LOW_CLIP, HIGH_CLIP = 0.01, 0.99


def _observed(day: Column, month: int, dom: int) -> Column:
    """Whether a fixed-date holiday is observed on ``day``.

    A Sunday holiday is observed on Monday, a Saturday holiday on Friday.
    """
    def falls(d: Column) -> Column:
        return (F.month(d) == month) & (F.dayofmonth(d) == dom)

    weekday = F.dayofweek(day)
    return (
        (falls(day) & weekday.between(2, 6))
        | (falls(F.date_sub(day, 1)) & (weekday == 2))
        | (falls(F.date_add(day, 1)) & (weekday == 6))
    )


def _labelled(own: str, before: Column, after: Column, plain: Column) -> tuple[Column, Column]:
    """Season name and holiday flag from a holiday and its two neighbours."""
    special = F.coalesce(
        F.col(own), F.concat(F.lit("BEFORE "), before), F.concat(F.lit("AFTER "), after)
    )
    return F.coalesce(special, plain.cast("string")), special.isNotNull()


def seasonal_calendar(calendar: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Season of every period with its rank, successor and next dates.

    Columns: dt, seasonality (array of type, season, holiday_flg), holiday_flg,
    fcst_dts, dt_rnk, next_dt.
    """
    day = F.col("cal_dt")
    fourth_thursday = (
        (F.month(day) == 11) & F.dayofmonth(day).between(22, 28) & (F.dayofweek(day) == 5)
    )
    holiday = (
        F.when(_observed(day, 1, 1), NEW_YEAR)
        .when(fourth_thursday, THANKSGIVING)
        .when(_observed(day, 12, 25), CHRISTMAS)
    )
    days = calendar.withColumn("day_holiday", holiday)
    in_days = Window.orderBy("cal_dt")
    day_season, day_flag = _labelled(
        "day_holiday", F.lead("day_holiday").over(in_days), F.lag("day_holiday").over(in_days),
        F.dayofweek(day),
    )
    days = days.withColumns({"day_season": day_season, "day_flag": day_flag})
    in_weeks = Window.orderBy("fscl_wk_end_dt")
    weeks = days.groupBy("fscl_wk_end_dt").agg(
        F.max("day_holiday").alias("week_holiday"), F.max("fscl_wk_nbr").alias("week_nbr")
    )
    week_season, week_flag = _labelled(
        "week_holiday", F.lead("week_holiday").over(in_weeks), F.lag("week_holiday").over(in_weeks),
        F.least("week_nbr", F.lit(52)),
    )
    weeks = weeks.select(
        "fscl_wk_end_dt", week_season.alias("week_season"), week_flag.alias("week_flag")
    )
    dated = days.filter(F.col("cal_dt") == F.col(spec.calendar_col)).join(
        F.broadcast(weeks), "fscl_wk_end_dt"
    )

    def season(kind: str, name: str, flag: str) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), F.col(name).alias("season"), F.col(flag).alias("holiday_flg")
        )

    parts = {
        "DAILY": season("DAILY", "day_season", "day_flag"),
        "WEEKLY": season("WEEKLY", "week_season", "week_flag"),
    }
    in_order = Window.orderBy("dt")
    ahead = in_order.rowsBetween(1, spec.horizon)
    return (
        dated.select(
            F.col("cal_dt").alias("dt"),
            F.array(*[parts[kind] for kind, _ in spec.season_lags]).alias("seasonality"),
        )
        .withColumn("holiday_flg", F.col("seasonality")[0]["holiday_flg"])
        .withColumns(
            {
                "fcst_dts": F.collect_list("dt").over(ahead),
                "dt_rnk": F.row_number().over(in_order),
                "next_dt": F.lead("dt").over(in_order),
            }
        )
    )


def _neighbourhoods(season_cal: DataFrame, spec: SeriesSpec) -> DataFrame:
    """type, dt and the ordered dates whose seasons are averaged for it.

    Ordinary dates take the nearest ordinary dates; holidays stand alone.
    """
    ordinary = season_cal.filter(~F.col("holiday_flg")).select("dt")
    holidays = season_cal.filter("holiday_flg").select("dt", F.array("dt").alias("dts"))
    in_order = Window.orderBy("dt")
    out = None
    for kind, lags in spec.season_lags:
        reach = (lags - 1) // 2
        around = F.collect_list("dt").over(in_order.rowsBetween(-reach, reach))
        both = ordinary.withColumn("dts", around).unionByName(holidays)
        typed = both.select(F.lit(kind).alias("type"), "dt", "dts")
        out = typed if out is None else out.unionByName(typed)
    return out


def smoothing_calendar(season_cal: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Pairs of a date and a date its season is smoothed with, per type."""
    return _neighbourhoods(season_cal, spec).select(
        "type", "dt", F.explode("dts").alias("smooth_dt")
    )


def _decay_weight(decay: float) -> Column:
    """Weight by distance from the middle of the list, normalised to one."""
    middle = (F.size("dts") - 1) / 2

    def raw(i: Column) -> Column:
        return F.pow(F.lit(decay), F.abs(middle - i))

    places = F.sequence(F.lit(0), F.size("dts") - 1)
    total = F.aggregate(places, F.lit(0.0), lambda acc, i: acc + raw(i))
    return safe_divide(raw(F.col("pos")), total)


def smoothing_weights(season_cal: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The smoothing pairs with their long- and short-term weights."""
    listed = _neighbourhoods(season_cal, spec).select(
        "type", "dt", "dts", F.posexplode("dts").alias("pos", "smooth_dt")
    )
    return listed.select(
        "type",
        "dt",
        "smooth_dt",
        _decay_weight(LONG_DECAY).alias("w_long"),
        _decay_weight(SHORT_DECAY).alias("w_short"),
    )


def prepare_series(raw: DataFrame, season_cal: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Summed, gap-free, padded and winsorised series per key.

    A key runs from its first positive value to the common last date, padded
    with NULL on both sides so that seasons exist wherever one is needed.
    Adds the mean and count of the preceding year.

    Duplicates are summed first (spread over key and date), so a key has one
    row per period afterwards and its window is bounded by the calendar.
    """
    summed = (
        keyed(raw, spec).groupBy("agg_level", "dt").agg(F.sum("value").alias("sum_qty"))
    )
    ranks = season_cal.select(F.col("dt").alias("cal_dt"), "dt_rnk")
    dated_sums = summed.filter(F.col("dt").isNotNull())
    ranked = in_calendar(dated_sums, "dt", ranks).drop("dt")
    last = ranked.agg(F.max("dt_rnk")).scalar()
    by_key = Window.partitionBy("agg_level")
    in_order = by_key.orderBy("dt_rnk")
    known = ranked.withColumns(
        {
            "_first": F.min(F.when(F.col("sum_qty") > 0, F.col("dt_rnk"))).over(by_key),
            "_next": F.lead("dt_rnk").over(in_order),
            "_last": last,
        }
    ).filter(F.col("dt_rnk") >= F.col("_first"))
    pad = (spec.max_lags - 1) // 2
    begin = F.when(F.col("dt_rnk") == F.col("_first"), F.col("_first") - pad).otherwise(
        F.col("dt_rnk")
    )
    end = F.coalesce(F.col("_next") - 1, F.col("_last") + pad + spec.horizon)
    spread = known.withColumn("_at", F.explode(F.sequence(begin, end)))
    inside = F.col("_at").between(F.col("_first"), F.col("_last"))
    own = F.col("_at") == F.col("dt_rnk")
    qty = F.when(own, F.coalesce("sum_qty", F.lit(0.0))).when(inside, 0.0)
    series = spread.select(
        "agg_level", F.col("_at").alias("dt_rnk"), inside.alias("fcst_crt_dt_flg"), qty.alias("qty")
    )
    limits = series.withColumns(
        {
            "_p_lo": F.percentile("qty", F.lit(LOW_CLIP)).over(by_key),
            "_p_hi": F.percentile("qty", F.lit(HIGH_CLIP)).over(by_key),
        }
    )
    clean = limits.withColumn("adj_qty", clip("qty", F.col("_p_lo"), F.col("_p_hi")))
    year_before = by_key.orderBy("dt_rnk").rowsBetween(-spec.num_periods, -1)
    trailed = clean.select(
        "*",
        F.avg("adj_qty").over(year_before).alias("period_avg_qty"),
        F.count("adj_qty").over(year_before).alias("period_count_qty"),
    )
    # Calendar columns are attached last, so no window carries them.
    attributes = season_cal.select("dt_rnk", "dt", "seasonality", "fcst_dts", "next_dt")
    return trailed.join(attributes, "dt_rnk").select(
        "agg_level",
        "dt",
        "seasonality",
        "fcst_dts",
        "next_dt",
        "fcst_crt_dt_flg",
        "qty",
        "adj_qty",
        "period_avg_qty",
        "period_count_qty",
    )


def seasonality(series: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Mean deviation from the preceding year per season, own date left out.

    Columns: agg_level, dt, type, season, seasonal_qty.  Only dates with a
    full year before them contribute.
    """
    deviation = F.when(
        F.col("period_count_qty") == spec.num_periods, F.col("adj_qty") - F.col("period_avg_qty")
    )
    typed = series.select(
        "agg_level", "dt", F.explode("seasonality").alias("s"), deviation.alias("_dev")
    ).select("agg_level", "dt", "s.type", "s.season", "_dev")
    same = Window.partitionBy("agg_level", "type", "season")
    others = F.count("_dev").over(same) - F.when(F.col("_dev").isNotNull(), 1).otherwise(0)
    rest = F.sum("_dev").over(same) - F.coalesce("_dev", F.lit(0.0))
    return typed.withColumn("seasonal_qty", safe_divide(rest, others)).drop("_dev")


def smooth_seasonality(seasons: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted neighbouring seasons, summed over types.

    Columns: agg_level, dt, smoothed_seasonal_qty, seasonal_qty.  A missing
    season drops out of the sum without renormalising the rest.

    Each season is sent to the few dates it serves, through the broadcast
    calendar pairs, and summed there; dates outside the key's series are those
    that do not receive their own season.
    """
    served = seasons.withColumnRenamed("dt", "smooth_dt").join(
        F.broadcast(weights), ["type", "smooth_dt"]
    )
    value = F.col("seasonal_qty")
    sums = served.groupBy("agg_level", "dt").agg(
        F.sum(value * F.col("w_long")).alias("smoothed_seasonal_qty"),
        F.sum(value * F.col("w_short")).alias("seasonal_qty"),
        F.max(F.col("dt") == F.col("smooth_dt")).alias("_own"),
    )
    return sums.filter("_own").drop("_own")


def deseasonalise(series: DataFrame, smoothed: DataFrame) -> DataFrame:
    """Series without its long-term and without its raw seasonality."""
    raw = F.coalesce("seasonal_qty", F.lit(0.0))
    long_term = F.coalesce("smoothed_seasonal_qty", "seasonal_qty", F.lit(0.0))
    return series.join(smoothed, ["agg_level", "dt"]).select(
        "agg_level",
        "dt",
        "next_dt",
        "fcst_dts",
        "fcst_crt_dt_flg",
        "qty",
        "adj_qty",
        long_term.alias("smoothed_seasonal_qty"),
        (F.col("adj_qty") - long_term).alias("deseasonalized_adj_qty"),
        raw.alias("seasonal_qty"),
        (F.col("adj_qty") - raw).alias("st_deseasonalized_adj_qty"),
    )

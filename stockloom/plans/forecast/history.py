"""Dense history per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from stockloom.functions import build_key
from stockloom.operators.joins import date_array
from stockloom.spec import SeriesSpec


def keyed(raw: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Raw history as agg_level, dt, value; rows with a NULL key part drop out."""
    return raw.select(
        build_key(spec.keys).alias("agg_level"),
        F.col(spec.time_col).cast("date").alias("dt"),
        F.col(spec.value_col).cast("double").alias("value"),
    ).filter(F.col("agg_level").isNotNull())


def densify_history(raw: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Every key on every date of the data, from its first positive value on.

    Missing values become zero.  Columns: agg_level, dt, value, dayofweek,
    start_dt.  Several rows of one key and date stay several rows.

    The dates are numbered once.  Gaps are found from the distinct (key, date)
    pairs, at most one per period of a key, by the number of the key's next
    date, and are cut out of the date array after the window; what is shuffled
    is key, date and value.
    """
    rows = keyed(raw, spec)
    numbered = rows.select("dt").distinct().withColumn(
        "_pos", F.row_number().over(Window.orderBy("dt"))  # distinct dates only
    )
    present = rows.groupBy("agg_level", "dt").agg(F.max("value").alias("_top"))
    by_key = Window.partitionBy("agg_level")
    spans = (
        present.join(numbered, "dt")
        .withColumns(
            {
                "start_dt": F.min(F.when(F.col("_top") > 0, F.col("dt"))).over(by_key),
                "_next": F.lead("_pos").over(by_key.orderBy("dt")),
            }
        )
        .filter(F.col("dt") >= F.col("start_dt"))
    )
    dates = F.col("_dates")
    length = F.coalesce(F.col("_next"), F.size(dates) + 1) - F.col("_pos") - 1
    gaps = (
        spans.withColumn("_dates", date_array(rows, "dt"))
        .withColumn("_at", F.explode(F.slice(dates, F.col("_pos") + 1, length)))
        .select("agg_level", F.col("_at").alias("dt"), F.lit(0.0).alias("value"), "start_dt")
    )
    starts = rows.filter(F.col("value") > 0).groupBy("agg_level").agg(F.min("dt").alias("start_dt"))
    own = (
        rows.join(starts, "agg_level")
        .filter(F.col("dt") >= F.col("start_dt"))
        .select("agg_level", "dt", F.coalesce("value", F.lit(0.0)).alias("value"), "start_dt")
    )
    return own.unionByName(gaps).select(
        "agg_level", "dt", "value", F.dayofweek("dt").alias("dayofweek"), "start_dt"
    )

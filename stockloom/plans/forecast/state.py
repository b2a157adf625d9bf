"""State that one period's run hands to the next: every key's series so far.

A run of one period needs the series of its keys, not the sales they came
from.  The state holds a key's sums per date, from its first positive one, in one
row, and the dates that occurred at all.  A new period is merged into it with one
join, so a run reads the period's rows and the state; the sales history stays
where it is.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockloom.functions import split_key
from stockloom.functions.scalar import KEY_SEPARATOR
from stockloom.plans.forecast.history import keyed
from stockloom.plans.forecast.run import run_incremental
from stockloom.session import stage_path
from stockloom.spec import SeriesSpec

ENTRIES = "array<struct<dt: date, value: double>>"


@dataclass(frozen=True)
class SeriesState:
    """``series``: agg_level, entries (date and sum, by date).  ``dates``: every
    date of the data, one row per period."""

    series: DataFrame
    dates: DataFrame

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> SeriesState:
        return cls(spark.read.parquet(f"{path}/series"), spark.read.parquet(f"{path}/dates"))

    def write(self, path: str) -> SeriesState:
        self.series.write.mode("overwrite").parquet(f"{path}/series")
        self.dates.write.mode("overwrite").parquet(f"{path}/dates")
        return SeriesState.read(self.series.sparkSession, path)

    def history(self, spec: SeriesSpec) -> DataFrame:
        """The series as raw history.  Dates on which no key has begun yet are
        rows of a key without sales, which begins no series."""
        known = self.series.select("agg_level", F.explode("entries").alias("e")).select("agg_level", "e.dt", "e.value")
        bare = self.dates.select(F.lit(KEY_SEPARATOR * (len(spec.keys) - 1)).alias("agg_level"), "dt", F.lit(0.0).alias("value"))
        return known.unionByName(bare).select(
            *split_key("agg_level", spec.keys),
            F.col("dt").alias(spec.time_col), F.col("value").alias(spec.value_col))


def _entries(rows: DataFrame) -> DataFrame:
    sums = rows.groupBy("agg_level", "dt").agg(F.sum("value").alias("value"))
    return sums.groupBy("agg_level").agg(F.array_sort(F.collect_list(F.struct("dt", "value"))).alias("fresh"))


def _begun(entries: str):
    """Entries from the first positive one on; NULL before there is one."""
    first = F.array_min(F.transform(F.filter(entries, lambda e: e["value"] > 0), lambda e: e["dt"]))
    return F.when(first.isNotNull(), F.filter(entries, lambda e: e["dt"] >= first))


def series_state(raw: DataFrame, spec: SeriesSpec) -> SeriesState:
    """The state after a whole history.  Rows without a date count for nothing."""
    rows = keyed(raw, spec).filter(F.col("dt").isNotNull())
    begun = _entries(rows).select("agg_level", _begun("fresh").alias("entries")).filter("entries is not null")
    return SeriesState(begun, rows.select("dt").distinct())


def advance(state: SeriesState, period: DataFrame, spec: SeriesSpec) -> SeriesState:
    """The state with the rows of a new period.

    A date that the state has already is replaced, so a period that is run again
    changes nothing; a key it knows is joined once, and a key without new rows
    keeps its row.
    """
    rows = keyed(period, spec).filter(F.col("dt").isNotNull())
    joined = state.series.join(_entries(rows), "agg_level", "full")
    fresh, old = F.coalesce("fresh", F.lit(None).cast(ENTRIES), F.array().cast(ENTRIES)), F.coalesce("entries", F.array().cast(ENTRIES))
    renewed = F.transform(fresh, lambda e: e["dt"])
    kept = F.filter(old, lambda e: ~F.array_contains(renewed, e["dt"]))
    merged = joined.withColumn("all", F.array_sort(F.concat(kept, fresh)))
    return SeriesState(
        merged.select("agg_level", _begun("all").alias("entries")).filter("entries is not null"),
        state.dates.unionByName(rows.select("dt")).distinct())


def run_period(
    fact: DataFrame, state: SeriesState, period: DataFrame, calendar: DataFrame, spec: SeriesSpec,
    as_of: dt.date, method: str = "rules", seed: int = 0,
) -> tuple[DataFrame, SeriesState]:
    """The fact with the current period, and the state to run the next one with.

    As :func:`run_incremental`, which it equals where a key has one row per date,
    but reading the period's rows and the written state only.
    """
    after = advance(state, period, spec).write(stage_path(fact.sparkSession, "series-state"))
    return run_incremental(fact, after.history(spec), calendar, spec, as_of, method, seed), after

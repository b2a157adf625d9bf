"""The whole forecast run, from raw history to the selected forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stockloom.plans.forecast.bandit import apply_selection, bandit_selection
from stockloom.plans.forecast.seasonal import (
    deseasonalise,
    prepare_series,
    seasonal_calendar,
    seasonality,
    smooth_seasonality,
    smoothing_weights,
)
from stockloom.plans.forecast.selection import (
    apply_rules,
    past_decisions,
    rolling_error_stats,
    selection_base,
)
from stockloom.plans.forecast.smoothing import apply_forecast23, exp_smooth_fit, forecast23
from stockloom.plans.forecast.year_match import fresh_snapshot, staged_forecast1
from stockloom.session import materialise
from stockloom.spec import SeriesSpec


def deseasonalised(raw: DataFrame, calendar: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Raw history to the deseasonalised series.

    The prepared series is read twice and therefore written as a stage.
    """
    season_cal = seasonal_calendar(calendar, spec)
    series = materialise(prepare_series(raw, season_cal, spec), "series")
    seasons = seasonality(series, spec)
    return deseasonalise(series, smooth_seasonality(seasons, smoothing_weights(season_cal, spec)))


def with_forecast23(
    fact: DataFrame, raw: DataFrame, calendar: DataFrame, spec: SeriesSpec
) -> DataFrame:
    """Forecasts 2 and 3 computed and written into the fact."""
    series = materialise(deseasonalised(raw, calendar, spec), "deseasonalised")
    return apply_forecast23(fact, forecast23(series, exp_smooth_fit(series), spec), spec)


def create_fact(
    raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, start: dt.date, end: dt.date,
    as_of: dt.date,
) -> DataFrame:
    """Forecasts 1 to 3 for all snapshots between two dates."""
    fact = staged_forecast1(raw, calendar, spec, start, end, as_of)
    return with_forecast23(fact, raw, calendar, spec)


def select_forecast(
    fact: DataFrame, spec: SeriesSpec, end: dt.date, as_of: dt.date,
    method: str = "rules", use_forecast4: bool = False, seed: int = 0,
) -> DataFrame:
    """The fact with one_forecast set by rules or by the learner.

    ``fact`` is read several times here, so pass a written table.
    """
    stats = rolling_error_stats(selection_base(fact, as_of, spec, use_forecast4), spec, end)
    return _selected(fact, stats, as_of, method, use_forecast4, seed)


def _selected(
    fact: DataFrame, stats: DataFrame, as_of: dt.date, method: str,
    use_forecast4: bool = False, seed: int = 0,
) -> DataFrame:
    if method == "rules":
        return apply_rules(fact, past_decisions(stats, as_of), use_forecast4)
    if method == "bandit":
        return apply_selection(fact, bandit_selection(stats, as_of, seed), use_forecast4)
    raise ValueError(f"unknown selection method {method!r}")


def run_forecast(
    raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, start: dt.date, end: dt.date,
    as_of: dt.date, method: str = "rules", seed: int = 0,
) -> DataFrame:
    """Full run.  The raw history and the fact are written once as stages,
    because both are read by several later steps."""
    raw = materialise(raw.select(*spec.keys, spec.time_col, spec.value_col), "history")
    fact = materialise(create_fact(raw, calendar, spec, start, end, as_of), "fact")
    return select_forecast(fact, spec, end, as_of, method, seed=seed)


def run_incremental(
    fact: DataFrame, raw: DataFrame, calendar: DataFrame, spec: SeriesSpec, as_of: dt.date,
    method: str = "rules", seed: int = 0,
) -> DataFrame:
    """Append the current period, with its forecasts and selection, to a fact.

    Rows of earlier snapshots are returned as they came: what was forecast and
    chosen then must not learn from later data.  A second run of a period
    changes nothing.
    """
    raw = materialise(raw.select(*spec.keys, spec.time_col, spec.value_col), "history")
    fresh = fresh_snapshot(fact, raw, calendar, spec, as_of)
    fresh = materialise(with_forecast23(fresh, raw, calendar, spec), "fresh")
    stats = rolling_error_stats(selection_base(fact.unionByName(fresh), as_of, spec), spec, as_of)
    return fact.unionByName(_selected(fresh, stats, as_of, method, seed=seed))

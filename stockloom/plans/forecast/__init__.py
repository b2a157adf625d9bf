"""Forecast pipeline: history, three forecasts, selection, adjustment."""

from stockloom.plans.forecast.adjust import (
    error_report,
    percent_adjust,
    reactive_adjust,
    value_report,
)
from stockloom.plans.forecast.bandit import apply_selection, bandit_selection, choice_outcomes
from stockloom.plans.forecast.history import densify_history
from stockloom.plans.forecast.run import run_forecast, run_incremental
from stockloom.plans.forecast.seasonal import (
    deseasonalise,
    prepare_series,
    seasonal_calendar,
    seasonality,
    smooth_seasonality,
    smoothing_calendar,
)
from stockloom.plans.forecast.selection import (
    apply_rules,
    external_forecast,
    rolling_error_stats,
    rules_selection,
    selection_base,
)
from stockloom.plans.forecast.smoothing import (
    apply_forecast23,
    exp_smooth_fit,
    forecast23,
)
from stockloom.plans.forecast.state import SeriesState, advance, run_period, series_state
from stockloom.plans.forecast.year_match import (
    cap_growth,
    forecast1,
    forecast1_incremental,
    forecast_periods,
    forecast_samples,
    similarity_weights,
    snapshot_periods,
    snapshot_samples,
    staged_forecast1,
    with_targets,
    year_comparison,
)

__all__ = [
    "SeriesState", "advance", "apply_forecast23", "apply_rules", "apply_selection", "bandit_selection",
    "cap_growth", "choice_outcomes", "densify_history", "deseasonalise", "error_report",
    "exp_smooth_fit", "external_forecast", "forecast1",
    "forecast1_incremental", "forecast23", "forecast_periods",
    "forecast_samples", "percent_adjust", "prepare_series", "reactive_adjust",
    "rolling_error_stats", "rules_selection", "run_forecast",
    "run_incremental", "run_period", "seasonal_calendar", "seasonality",
    "selection_base", "series_state", "similarity_weights", "smooth_seasonality",
    "smoothing_calendar", "snapshot_periods", "snapshot_samples",
    "staged_forecast1",
    "value_report", "with_targets", "year_comparison",
]

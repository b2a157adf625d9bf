"""Names and settings of a forecast series."""

from __future__ import annotations

from dataclasses import dataclass, field

# Periods per year, calendar column and the smoothing lags of
# each seasonality type, by series frequency.
PERIODS_PER_YEAR = {"week": 52, "day": 364}
CALENDAR_COLUMN = {"week": "fscl_wk_end_dt", "day": "cal_dt"}
SEASON_LAGS = {
    "week": (("WEEKLY", 5),),
    "day": (("DAILY", 1), ("WEEKLY", 5)),
}


@dataclass(frozen=True)
class SeriesSpec:
    """Columns of a raw history table and how it is to be forecast.

    ``keys`` are the hierarchy columns; they become one ``agg_level`` string
    in the forecast fact and are split back at the end.  ``horizon`` is the
    number of target periods per snapshot, the snapshot period included.
    """

    time_col: str
    keys: tuple[str, ...]
    value_col: str
    freq: str = "week"
    horizon: int = 3
    round_output: bool = False
    nonneg_output: bool = False
    season_lags: tuple[tuple[str, int], ...] = field(default=())

    def __post_init__(self):
        if self.freq not in PERIODS_PER_YEAR:
            raise ValueError(f"freq must be one of {sorted(PERIODS_PER_YEAR)}")
        if not self.keys:
            raise ValueError("at least one key column is needed")
        if self.horizon < 1:
            raise ValueError("horizon must be at least 1")
        if not self.season_lags:
            object.__setattr__(self, "season_lags", SEASON_LAGS[self.freq])

    @property
    def num_periods(self) -> int:
        return PERIODS_PER_YEAR[self.freq]

    @property
    def window(self) -> int:
        """Periods compared per year: a quarter."""
        return self.num_periods // 4

    @property
    def calendar_col(self) -> str:
        return CALENDAR_COLUMN[self.freq]

    @property
    def days_per_period(self) -> int:
        return 7 if self.freq == "week" else 1

    @property
    def max_lags(self) -> int:
        return max(lags for _, lags in self.season_lags)

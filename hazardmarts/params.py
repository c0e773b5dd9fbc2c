"""All tunable values, in one immutable object that is passed to the plans."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Hourly rain warning thresholds in mm per hour, strictest first.
WARNING_BANDS = ((30.0, "red"), (15.0, "orange"), (7.5, "yellow"))
NO_WARNING = "none"


@dataclass(frozen=True)
class Lattice:
    """A regular lat/lon grid. Its size follows from the box and the step, not from data."""

    lat_min: float = 14.35
    lat_max: float = 14.80
    lon_min: float = 120.90
    lon_max: float = 121.15
    step: float = 0.05

    def __post_init__(self) -> None:
        if not (self.lat_min < self.lat_max and self.lon_min < self.lon_max and self.step > 0):
            raise ValueError("lattice box must be ordered and the step positive")

    @property
    def n_rows(self) -> int:
        return int(round((self.lat_max - self.lat_min) / self.step)) + 1

    @property
    def n_cols(self) -> int:
        return int(round((self.lon_max - self.lon_min) / self.step)) + 1

    @property
    def size(self) -> int:
        return self.n_rows * self.n_cols


@dataclass(frozen=True)
class Params:
    # Marts.
    bands: tuple[tuple[float, str], ...] = WARNING_BANDS
    calm: str = NO_WARNING
    lookback_days: int = 30
    normal_years: tuple[int, int] = (2020, 2025)
    # How many runs "the newest runs" are, where that is the question. Landing keeps all.
    newest_runs: int = 14
    # Run dates are local days; fetch times are UTC. Archive rows fetched after a given run's day are not its own.
    run_utc_offset_hours: int = 8
    # Gates and table tests.
    max_daily_mm: float = 500.0
    max_hourly_mm: float = 200.0
    max_null_share: float = 0.05
    min_horizon_days: int = 6
    full_coverage_days: int = 5
    # Backfill.
    archive_start: dt.date = dt.date(2020, 1, 1)
    archive_lag_days: int = 5
    archive_refetch_days: int = 14
    past_days: int = 7
    # Space.
    lattice: Lattice = field(default_factory=Lattice)

    def __post_init__(self) -> None:
        limits = [limit for limit, _ in self.bands]
        if not limits or any(a <= b for a, b in zip(limits, limits[1:])):
            raise ValueError("bands must be given strictest first")
        if self.normal_years[0] > self.normal_years[1]:
            raise ValueError("normal_years must be ordered")
        if self.past_days <= self.archive_lag_days:
            raise ValueError("past_days must bridge archive_lag_days")
        if self.archive_refetch_days < self.archive_lag_days:
            raise ValueError("archive_refetch_days must cover archive_lag_days")

    @property
    def levels(self) -> tuple[str, ...]:
        """Warning labels from calm to the most severe; the position is the severity."""
        return (self.calm, *(label for _, label in reversed(self.bands)))

"""Small snapshot trees in the landed layout, built from plain Python values."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

RUN = dt.date(2031, 3, 14)
# Two points with weather and one without.
A, B, IDLE = "g0203", "g0704", "g0901"
POINTS = {A: (14.45, 121.05), B: (14.7, 121.1)}
ARCHIVE_DAYS = [f"2031-03-0{d}" for d in range(2, 8)]
# Observed rain per point; the second one misses its last day.
OBSERVED = {A: [4.5, 20.25, 33.0, 6.75, 0.5, 2.0], B: [1.5, 8.0, 12.25, 3.0, 0.75, None]}
DAYS = ["2031-03-13", "2031-03-14"]
EXPECTED_RAIN = {A: [9.25, 1.5], B: [None, 2.75]}
HOURS = [f"2031-03-13T0{h}:00" for h in range(5, 9)]
HOURLY = {A: [2.0, 9.5, 21.0, 44.0], B: [0.0, 0.5, 0.0, 0.0]}
FETCHED = "2031-03-13T20:30:00+00:00"


def document(kind: str, run_date: str, fetched_at: str, responses: dict[str, dict]) -> dict:
    points = [
        {"grid_id": g, "lat": POINTS[g][0], "lon": POINTS[g][1], "response": r} for g, r in responses.items()
    ]
    return {"kind": kind, "run_date": run_date, "fetched_at": fetched_at, "points": points}


def forecast(run: dt.date = RUN, days: list[str] = DAYS, rain: dict = EXPECTED_RAIN) -> dict:
    return document("forecast", run.isoformat(), FETCHED, {
        g: {
            "elevation": 12.0,
            "daily": {
                "time": days, "precipitation_sum": rain[g],
                "precipitation_probability_max": [80 - 5 * i for i in range(len(days))],
                "precipitation_hours": [6] * len(days),
            },
            "hourly": {"time": HOURS, "precipitation": HOURLY[g]},
        }
        for g in POINTS
    })


def flood(run: dt.date = RUN, days: list[str] = DAYS) -> dict:
    base = {A: 7.25, B: 3.5}
    return document("flood", run.isoformat(), FETCHED, {
        g: {"daily": {
            "time": days, "river_discharge": [base[g]] * len(days), "river_discharge_max": [base[g] + 2.0] * len(days),
        }}
        for g in POINTS
    })


def archive(fetched_at: str = FETCHED, days: list[str] = ARCHIVE_DAYS, rain: dict = OBSERVED) -> dict:
    return document("archive", RUN.isoformat(), fetched_at, {
        g: {"daily": {"time": days, "precipitation_sum": rain[g], "precipitation_hours": [4] * len(days)}}
        for g in rain
    })


def write(path: Path, content: dict, indent: int | None = 1) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(content, indent=indent), encoding="utf-8")


def write_run(raw: Path, run: dt.date = RUN, **changes) -> None:
    write(raw / run.isoformat() / "forecast.json", forecast(run, **changes))
    write(raw / run.isoformat() / "flood.json", flood(run, **({"days": changes["days"]} if "days" in changes else {})))


def write_all(raw: Path) -> Path:
    write_run(raw)
    write(raw / "archive" / f"{ARCHIVE_DAYS[0]}_{ARCHIVE_DAYS[-1]}.json", archive())
    return raw


def dimension(spark):
    """Four areas: two cities on the first point, one on the second, and one on a point without weather."""
    from hazardmarts import schemas

    rows = [
        ("T3", "Third", "Eastside", 310, 12.5, 3, 0.6, 186, 14.71, 121.09, B),
        ("T1", "First", "Northgate", 120, 40.0, 1, 0.25, 30, 14.46, 121.04, A),
        ("T2", "Second", "Millbrook", 240, 62.5, 2, 0.5, 120, 14.44, 121.06, A),
        ("T4", "Fourth", "Farview", 90, None, 4, 0.1, 9, 14.8, 120.95, IDLE),
    ]
    return spark.createDataFrame(rows, schemas.DIMENSION)


def good_run(raw: Path, run: dt.date = RUN) -> None:
    """A run without nulls that covers a week back and a week ahead, as the gates ask."""
    days = [(run + dt.timedelta(days=i)).isoformat() for i in range(-7, 7)]
    rain = {g: [float(i % 5) for i in range(len(days))] for g in POINTS}
    write_run(raw, run, days=days, rain=rain)

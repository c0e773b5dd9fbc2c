"""All models over the raw tables and the dimension."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame

from hazardmarts.operators.versions import fetched_by, given_run, until_run
from hazardmarts.params import Params
from hazardmarts.plans import marts, staging

RUN_TABLES = ("forecast_daily", "forecast_hourly", "flood_daily")

# Each model's function and the tables it takes, in its order of arguments; the flag says
# whether it also takes the parameters.
MODELS = {
    "stg_forecast_daily": (staging.stg_forecast_daily, ("forecast_daily",), False),
    "stg_forecast_hourly": (staging.stg_forecast_hourly, ("forecast_hourly",), False),
    "stg_flood_daily": (staging.stg_flood_daily, ("flood_daily",), False),
    "stg_archive_daily": (staging.stg_archive_daily, ("archive_daily",), False),
    "int_latest_run": (marts.int_latest_run, ("stg_forecast_daily",), False),
    "int_rain_daily_unioned": (
        marts.int_rain_daily_unioned, ("stg_archive_daily", "stg_forecast_daily"), False,
    ),
    "int_rain_rolling": (marts.int_rain_rolling, ("int_rain_daily_unioned",), False),
    "fct_warnings_hourly": (marts.fct_warnings_hourly, ("stg_forecast_hourly", "int_latest_run"), True),
    "int_warnings_daily": (marts.int_warnings_daily, ("fct_warnings_hourly",), True),
    "fct_rain_barangay_daily": (
        marts.fct_rain_barangay_daily, ("int_rain_rolling", "dim_barangay", "int_warnings_daily"), True,
    ),
    "mart_dashboard": (
        marts.mart_dashboard,
        ("stg_archive_daily", "stg_forecast_daily", "dim_barangay", "int_warnings_daily", "int_latest_run"),
        True,
    ),
    "fct_river_grid_daily": (
        marts.fct_river_grid_daily, ("stg_flood_daily", "int_latest_run", "dim_barangay"), False,
    ),
    "mart_monthly_normal": (marts.mart_monthly_normal, ("stg_archive_daily",), True),
}


def build_models(
    sources: Mapping[str, DataFrame],
    params: Params = Params(),
    run_date: dt.date | None = None,
    names: Collection[str] | None = None,
    written: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The named models (all by default) and whatever they rest on, as lazy DataFrames.

    ``sources`` holds the four raw tables and ``dim_barangay``; ``written`` the models that are
    tables already and are read instead of computed.

    With ``run_date`` that run counts; later ones, and archive rows fetched after its day, are ignored
    throughout, so replaying an old date gives what that day's run gave. By default the newest run counts.
    """
    built: dict[str, DataFrame] = dict(written or {})

    def get(name: str) -> DataFrame:
        if name not in built:
            if name == "int_latest_run" and run_date is not None:
                built[name] = given_run(get("forecast_daily").sparkSession, run_date)
            elif name in MODELS:
                function, inputs, takes_params = MODELS[name]
                built[name] = function(*map(get, inputs), *([params] if takes_params else []))
            else:
                source = sources[name]
                if name in RUN_TABLES:
                    source = until_run(source, as_of=run_date)
                elif name == "archive_daily" and run_date is not None:
                    source = fetched_by(source, run_date, params.run_utc_offset_hours)
                built[name] = source
        return built[name]

    for name in names if names is not None else ("dim_barangay", *MODELS):
        get(name)
    return built

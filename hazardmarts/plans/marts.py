"""Intermediate and mart models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.functions import band, past_or_forecast, round_half_away, row_key
from hazardmarts.operators.groups import (
    daily_peak, distinct_text, monthly_totals, spatial_mean, with_climatology,
)
from hazardmarts.operators.joins import fan_out
from hazardmarts.operators.series import look_back, prefer, rolling_sums
from hazardmarts.operators.versions import in_run, latest_run
from hazardmarts.params import Params

ROLLING_DAYS = {"rain_3d_mm": 3, "rain_7d_mm": 7}


def int_latest_run(stg_forecast_daily: DataFrame) -> DataFrame:
    """The newest run over all forecast rows, also those without a rain value."""
    return latest_run(stg_forecast_daily)


def int_rain_daily_unioned(stg_archive_daily: DataFrame, stg_forecast_daily: DataFrame) -> DataFrame:
    """Observed rain, and forecast rain only for the point-days without an observation.

    Both are the newest non-null version; a day beyond the newest run's reach keeps the value of an
    older run. The staged archive has one row per point and day already; the daily job writes it once.
    """

    def rain(df: DataFrame, probability: Column, source: str, *order: str) -> DataFrame:
        return df.filter("precipitation_sum is not null").select(
            "grid_id", "date",
            F.col("precipitation_sum").alias("rain_mm"),
            F.col("precipitation_hours").alias("rain_hours"),
            probability.alias("rain_prob_max"),
            F.lit(source).alias("source"),
            *order,
        )

    observed = rain(stg_archive_daily, F.lit(None).cast("double"), "observed")
    forecast = rain(
        stg_forecast_daily, F.col("precipitation_probability_max"), "forecast", "run_date", "fetched_at"
    )
    return prefer(
        [(observed, []), (forecast, ["run_date", "fetched_at"])],
        ["grid_id", "date"],
        tie_break=["rain_mm", "rain_hours", "rain_prob_max"],
    )


def int_rain_rolling(int_rain_daily_unioned: DataFrame) -> DataFrame:
    rolled = rolling_sums(int_rain_daily_unioned, ["grid_id"], "date", "rain_mm", ROLLING_DAYS)
    return rolled.select(
        "grid_id", "date", "source", "rain_mm", "rain_hours", "rain_prob_max", *ROLLING_DAYS
    )


def fct_warnings_hourly(
    stg_forecast_hourly: DataFrame, int_latest_run: DataFrame, params: Params = Params()
) -> DataFrame:
    """Banded hours of the newest run; hours without a value are left out, not counted as dry."""
    hours = in_run(stg_forecast_hourly, int_latest_run.scalar()).filter("precipitation is not null")
    return hours.select(
        "run_date", "grid_id", "ts",
        F.to_date("ts").alias("date"),
        F.col("precipitation").alias("mm_per_hour"),
        band(F.col("precipitation"), params.bands, params.calm).alias("warning_level"),
    )


def int_warnings_daily(fct_warnings_hourly: DataFrame, params: Params = Params()) -> DataFrame:
    return daily_peak(
        fct_warnings_hourly, ["grid_id", "date"], "mm_per_hour", "warning_level", params.levels,
        peak="max_hourly_mm",
    )


def fct_rain_barangay_daily(
    int_rain_rolling: DataFrame,
    dim_barangay: DataFrame,
    int_warnings_daily: DataFrame,
    params: Params = Params(),
    within: Sequence[str] = (),
) -> DataFrame:
    """Area-days: the enriched point-days fanned out to the areas of each point.

    Warnings, and the text of the day that keys are made of, are attached at point grain, before the fan-out multiplies the
    rows. One point may serve a large share of all areas. ``within`` names further columns of the sums, in whose order the facts
    leave each task, and which they have too; those that the areas have as well also have to agree.
    """
    points = int_rain_rolling.join(int_warnings_daily, ["grid_id", "date"], "left").withColumns({
        "day_text": F.col("date").cast("string"),
        "warning_level": F.coalesce(F.col("warning_level"), F.lit(params.calm)),
    })
    agreed = [c for c in within if c in dim_barangay.columns]
    areas = dim_barangay.select(
        *agreed, "grid_id", "pcode", "name", "city", "population", "score", "pct_area_mh_25",
        "est_pop_exposed_25", "lat", "lon",
    )
    return fan_out(points, areas, [*agreed, "grid_id"], member="pcode", in_order=within).select(
        *within, "date", "source", "pcode", "name", "city", "population", "score", "pct_area_mh_25",
        "est_pop_exposed_25", "grid_id", "rain_mm", "rain_prob_max", "rain_hours", *ROLLING_DAYS,
        wet_exposure(F.col("rain_3d_mm"), F.col("score")).alias("wet_exposure"),
        "max_hourly_mm", "warning_level", "lat", "lon",
        row_key("pcode", "day_text").alias("row_key"),
    )


def wet_exposure(rain_3d: Column, score: Column) -> Column:
    return round_half_away(rain_3d * score / F.lit(100.0), 3)


def mart_dashboard(
    stg_archive_daily: DataFrame,
    stg_forecast_daily: DataFrame,
    dim_barangay: DataFrame,
    int_warnings_daily: DataFrame,
    int_latest_run: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """Area-days from the look-back date on, with the run date attached.

    Only the days that can matter enter the plan: the look-back plus the days the longest rolling
    sum reaches further back. A filter on the finished fact could not be pushed through the rolling
    window, so the whole history would be summed and fanned out first.
    """
    reach = params.lookback_days + max(ROLLING_DAYS.values()) - 1
    rolled = int_rain_rolling(
        int_rain_daily_unioned(
            look_back(stg_archive_daily, "date", int_latest_run, reach),
            look_back(stg_forecast_daily, "date", int_latest_run, reach),
        )
    )
    shown = look_back(rolled, "date", int_latest_run, params.lookback_days)
    return shown_facts(fct_rain_barangay_daily(shown, dim_barangay, int_warnings_daily, params), int_latest_run)


def shown_facts(facts: DataFrame, int_latest_run: DataFrame) -> DataFrame:
    """The dashboard's columns of the facts it shows."""
    return facts.withColumn("run_date", int_latest_run.scalar()).select(*schemas.DASHBOARD_COLUMNS)


def fct_river_grid_daily(
    stg_flood_daily: DataFrame, int_latest_run: DataFrame, dim_barangay: DataFrame
) -> DataFrame:
    """Discharge of the newest run at points that serve an area, with the cities they serve."""
    served = distinct_text(dim_barangay, ["grid_id"], "city", "cities_served")
    days = in_run(stg_flood_daily, int_latest_run.scalar()).withColumn(
        "source", past_or_forecast(F.col("date"), F.col("run_date"))
    )
    return days.join(served, "grid_id").select(*schemas.RIVER_COLUMNS)


def month_totals(stg_archive_daily: DataFrame) -> DataFrame:
    """Per calendar month the total of the spatial mean and the days it covers."""
    daily = spatial_mean(stg_archive_daily, "date", "precipitation_sum", "rain_mm")
    return monthly_totals(daily, "date", "rain_mm", "total_mm")


def month_start() -> Column:
    return F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))


def mart_monthly_normal(stg_archive_daily: DataFrame, params: Params = Params()) -> DataFrame:
    """Monthly totals of the spatial mean beside the base years' normal of the calendar month."""
    return monthly_normals(month_totals(stg_archive_daily), params)


def monthly_normals(totals: DataFrame, params: Params = Params()) -> DataFrame:
    compared = with_climatology(
        totals, "total_mm", params.normal_years, {"p10_mm": 0.1, "p90_mm": 0.9}, mean="normal_mm"
    )
    last_year = totals.agg(F.max("year")).scalar()
    return compared.select(
        "year", "month",
        month_start().alias("month_start"),
        *[round_half_away(F.col(c), 2).alias(c) for c in ("total_mm", "normal_mm", "p10_mm", "p90_mm")],
        (F.col("year") == last_year).alias("is_current_year"),
        "days_covered",
        (F.col("days_covered") == F.day(F.last_day(month_start()))).alias("is_complete"),
    )

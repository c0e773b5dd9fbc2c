"""The five views of the dashboard guide."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmarts.functions import level_of, severity_of
from hazardmarts.params import Params


def exposure_map(mart_dashboard: DataFrame, levels: Sequence[str] = Params().levels, days: int = 3) -> DataFrame:
    """Per area: mean population, wet exposure and three-day rain over the first forecast days, and the most
    severe warning, with the area's names and exposed people for the tooltip.

    The days are counted from the run date in the data, not from the reader's clock.
    """
    window = F.col("date").between(F.col("run_date"), F.date_add("run_date", days - 1))
    return (
        mart_dashboard.filter(F.col("source") == "forecast")
        .filter(window)
        .groupBy("pcode", "name", "city", "lat", "lon", "est_pop_exposed_25")
        .agg(
            F.avg("population").alias("population"), F.avg("wet_exposure").alias("wet_exposure"),
            F.avg("rain_3d_mm").alias("rain_3d_mm"),
            level_of(F.max(severity_of(F.col("warning_level"), levels)), levels).alias("warning_level"),
        )
    )


def city_forecast(mart_dashboard: DataFrame, cities: Sequence[str] | None = None) -> DataFrame:
    """Forecast days by warning level: mean daily rain and the hardest hour."""
    ahead = mart_dashboard.filter(F.col("source") == "forecast")
    if cities is not None:
        ahead = ahead.filter(F.col("city").isin(*cities))
    return ahead.groupBy("date", "warning_level").agg(
        F.avg("rain_mm").alias("rain_mm"), F.max("max_hourly_mm").alias("max_hourly_mm")
    )


def observed_vs_normal(mart_monthly_normal: DataFrame, years: int = 2) -> DataFrame:
    """Complete months of the last years beside their normals."""
    return mart_monthly_normal.filter(
        F.col("year") > mart_monthly_normal.agg(F.max("year")).scalar() - years
    ).filter("is_complete").select("month_start", "total_mm", "normal_mm", "p10_mm", "p90_mm")


def river_lines(fct_river_grid_daily: DataFrame, grid_ids: Sequence[str] | None = None) -> DataFrame:
    """Mean discharge per day and point, optionally of chosen points."""
    rows = fct_river_grid_daily
    if grid_ids is not None:
        rows = rows.filter(F.col("grid_id").isin(*grid_ids))
    return rows.groupBy("date", "grid_id", "cities_served").agg(
        F.avg("river_discharge").alias("river_discharge")
    )


def freshness(mart_dashboard: DataFrame) -> DataFrame:
    """One row: newest observed date, horizon, points in use and rows, in a single pass."""
    observed_date = F.when(F.col("source") == "observed", F.col("date"))
    return mart_dashboard.agg(
        F.max("run_date").alias("run_date"),
        F.max(observed_date).alias("latest_observed_date"),
        F.max("date").alias("forecast_through"),
        F.count_distinct("grid_id").alias("active_grid_points"),
        F.count(F.lit(1)).alias("dashboard_rows"),
    )

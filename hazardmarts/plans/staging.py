"""Raw tables with a text key; the archive keeps the latest valid value per point and day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hazardmarts.functions import row_key
from hazardmarts.operators.versions import latest_wins


def stg_forecast_daily(raw: DataFrame) -> DataFrame:
    return raw.withColumn("row_key", row_key("run_date", "grid_id", "date"))


def stg_forecast_hourly(raw: DataFrame) -> DataFrame:
    return raw.withColumn("row_key", row_key("run_date", "grid_id", "ts"))


def stg_flood_daily(raw: DataFrame) -> DataFrame:
    return raw.withColumn("row_key", row_key("run_date", "grid_id", "date"))


def stg_archive_daily(raw: DataFrame) -> DataFrame:
    """The latest valid value. Nulls go before ranking, so a later null never hides a value."""
    valid = raw.filter("precipitation_sum is not null")
    latest = latest_wins(
        valid, ["grid_id", "date"], "fetched_at", tie_break=["precipitation_sum", "precipitation_hours"]
    )
    return latest.select(
        "grid_id", "date", "precipitation_sum", "precipitation_hours", row_key("grid_id", "date").alias("row_key")
    )

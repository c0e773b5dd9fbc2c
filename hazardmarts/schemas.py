"""Explicit schemas of snapshots, raw tables, the dimension and the extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _table(columns: str) -> T.StructType:
    """``name type, ...``; Spark's own DDL parser would need a running session at import."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Raw tables: measures are doubles, clock columns carry no zone (see README, "Clocks").
RAW = {
    "forecast_daily": _table(
        "run_date date, grid_id string, date date, precipitation_sum double, "
        "precipitation_probability_max double, precipitation_hours double, fetched_at timestamp_ntz"
    ),
    "forecast_hourly": _table(
        "run_date date, grid_id string, ts timestamp_ntz, precipitation double, fetched_at timestamp_ntz"
    ),
    "flood_daily": _table(
        "run_date date, grid_id string, date date, river_discharge double, "
        "river_discharge_max double, fetched_at timestamp_ntz"
    ),
    "archive_daily": _table(
        "grid_id string, date date, precipitation_sum double, precipitation_hours double, "
        "fetched_at timestamp_ntz"
    ),
}

DIMENSION = _table(
    "pcode string, name string, city string, population bigint, score double, rank_ncr int, "
    "pct_area_mh_25 double, est_pop_exposed_25 bigint, lat double, lon double, grid_id string"
)

RUN_LOG = _table(
    "run_date string, started_at_utc string, duration_s string, status string, forecast_rows bigint, "
    "flood_rows bigint, archive_rows bigint, dashboard_rows bigint, gates string"
)

# Column contracts of the published tables, in output order.
DASHBOARD_COLUMNS = (
    "date", "source", "pcode", "name", "city", "population", "score", "pct_area_mh_25",
    "est_pop_exposed_25", "grid_id", "rain_mm", "rain_prob_max", "rain_hours", "rain_3d_mm",
    "rain_7d_mm", "wet_exposure", "max_hourly_mm", "warning_level", "run_date", "lat", "lon",
)
WARNINGS_COLUMNS = ("run_date", "grid_id", "ts", "date", "mm_per_hour", "warning_level")
RIVER_COLUMNS = (
    "run_date", "grid_id", "date", "source", "river_discharge", "river_discharge_max", "cities_served",
)
MONTHLY_COLUMNS = (
    "year", "month", "month_start", "total_mm", "normal_mm", "p10_mm", "p90_mm",
    "is_current_year", "days_covered", "is_complete",
)

# Snapshot documents. Measures are read as text so that one unparseable number becomes a null
# measure instead of losing the document; times are cast strictly after flattening.
_TEXTS = T.ArrayType(T.StringType())


def _section(*measures: str) -> T.StructType:
    return T.StructType([T.StructField(name, _TEXTS) for name in ("time", *measures)])


def _document(**sections: T.StructType) -> T.StructType:
    response = T.StructType([T.StructField(name, kind) for name, kind in sections.items()])
    point = T.StructType(
        [
            T.StructField("grid_id", T.StringType()),
            T.StructField("lat", T.DoubleType()),
            T.StructField("lon", T.DoubleType()),
            T.StructField("response", response),
        ]
    )
    return T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("run_date", T.StringType()),
            T.StructField("fetched_at", T.StringType()),
            T.StructField("points", T.ArrayType(point)),
        ]
    )


FORECAST_DAILY_MEASURES = ("precipitation_sum", "precipitation_probability_max", "precipitation_hours")
FORECAST_HOURLY_MEASURES = ("precipitation",)
FLOOD_MEASURES = ("river_discharge", "river_discharge_max")
ARCHIVE_MEASURES = ("precipitation_sum", "precipitation_hours")

SNAPSHOT = {
    "forecast": _document(
        daily=_section(*FORECAST_DAILY_MEASURES), hourly=_section(*FORECAST_HOURLY_MEASURES)
    ),
    "flood": _document(daily=_section(*FLOOD_MEASURES)),
    "archive": _document(daily=_section(*ARCHIVE_MEASURES)),
}


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table without rows, for sources that have nothing landed yet."""
    return spark.createDataFrame([], schema)

"""Nested JSON snapshots to flat typed rows.

Layout: ``<raw>/<run date>/forecast.json``, ``<raw>/<run date>/flood.json`` and
``<raw>/archive/<start>_<end>.json``, one document per file. A large run may be split over several
files (``forecast-0001.json`` ...), since one document is parsed by one task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.functions import measure, strict_cast, utc_wall_time
from hazardmarts.sources import files

ARCHIVE = "archive"


def run_dates(spark: SparkSession, raw_dir: str) -> list[dt.date]:
    """Dates of the run directories, oldest first; directories not named by a date are skipped."""
    return sorted(filter(None, (iso_date(n) for n in files.children(spark, raw_dir, directories=True))))


def latest_run_date(spark: SparkSession, raw_dir: str) -> dt.date | None:
    return max(run_dates(spark, raw_dir), default=None)


def archive_windows(spark: SparkSession, raw_dir: str) -> list[tuple[dt.date, dt.date]]:
    """First and last day of the archive files, by their names; other names are skipped."""
    names = files.children(spark, f"{raw_dir}/{ARCHIVE}", directories=False)
    stems = [n.removesuffix(".json").split("_") for n in names if n.endswith(".json") and "_" in n]
    ends = [(iso_date(parts[0]), iso_date(parts[1])) for parts in stems]
    return sorted((start, end) for start, end in ends if start is not None and end is not None)


def archive_last_date(spark: SparkSession, raw_dir: str) -> dt.date | None:
    """Latest window end among the archive files."""
    return max((end for _, end in archive_windows(spark, raw_dir)), default=None)


def iso_date(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


def read_documents(spark: SparkSession, kind: str, paths: Sequence[str]) -> DataFrame:
    """Documents of one kind. Broken JSON raises; no paths give a typed empty table."""
    schema = schemas.SNAPSHOT[kind]
    if not paths:
        return schemas.empty(spark, schema)
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
    return reader.json(list(paths))


def flatten(
    documents: DataFrame,
    section: str,
    measures: Sequence[str],
    clock: str,
    expected_points: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per point and time step of ``response.<section>``; ``keep`` names columns of the
    documents to carry along.

    The arrays of a section must be equally long. The guard is part of the expression that
    makes the rows, so it cannot be pruned away with an unused column.
    """
    kept = [name for name in keep if name != "run_date"]
    points = documents.select(
        "run_date", "fetched_at", *kept, F.explode(_complete(F.col("points"), expected_points)).alias("point")
    )
    steps = points.select(
        F.col("run_date"),
        F.col("point.grid_id").alias("grid_id"),
        F.col("fetched_at"),
        *kept,
        F.inline(_aligned(f"point.response.{section}", measures)),
    )
    kind = "date" if clock == "date" else "timestamp_ntz"
    return steps.select(
        strict_cast(F.col("run_date"), "date").alias("run_date"),
        "grid_id",
        strict_cast(F.col("time"), kind).alias(clock),
        *[measure(F.col(name)).alias(name) for name in measures],
        utc_wall_time(F.col("fetched_at")).alias("fetched_at"),
        *kept,
    )


def _complete(points: Column, expected: int | None) -> Column:
    """The points of a document, or an error when the document does not hold what was asked for."""
    problem = points.isNull()
    message = F.lit("snapshot has no points")
    if expected is not None:
        problem = F.coalesce(F.size(points) != F.lit(expected), F.lit(True))
        message = F.format_string(
            f"expected {expected} locations, got %d", F.coalesce(F.size(points), F.lit(0))
        )
    return F.when(problem, F.raise_error(message)).otherwise(points)


def _aligned(section: str, measures: Sequence[str]) -> Column:
    length = F.coalesce(F.size(f"{section}.time"), F.lit(-1))
    rows = F.arrays_zip(F.col(f"{section}.time"), *[F.col(f"{section}.{name}") for name in measures])
    guarded = F.when(length < 0, F.raise_error(_blame(section, "time", length, length)))
    for name in measures:
        size = F.coalesce(F.size(f"{section}.{name}"), F.lit(-1))
        guarded = guarded.when(size != length, F.raise_error(_blame(section, name, size, length)))
    return guarded.otherwise(rows)


def _blame(section: str, name: str, size: Column, length: Column) -> Column:
    label = f"{section.rsplit('.', 1)[-1]}.{name}"
    return F.format_string(
        f"grid_id=%s: {label} has length %d, expected %d (-1 means absent)",
        F.coalesce(F.col("point.grid_id"), F.lit("null")), size, length,
    )


def flatten_forecast_daily(
    documents: DataFrame, keep: Sequence[str] = (), expected_points: int | None = None
) -> DataFrame:
    return _table(documents, "forecast_daily", "daily", schemas.FORECAST_DAILY_MEASURES, "date", keep, expected_points)


def flatten_forecast_hourly(
    documents: DataFrame, keep: Sequence[str] = (), expected_points: int | None = None
) -> DataFrame:
    return _table(documents, "forecast_hourly", "hourly", schemas.FORECAST_HOURLY_MEASURES, "ts", keep, expected_points)


def flatten_flood(
    documents: DataFrame, keep: Sequence[str] = (), expected_points: int | None = None
) -> DataFrame:
    return _table(documents, "flood_daily", "daily", schemas.FLOOD_MEASURES, "date", keep, expected_points)


def flatten_archive(
    documents: DataFrame, keep: Sequence[str] = (), expected_points: int | None = None
) -> DataFrame:
    return _table(documents, "archive_daily", "daily", schemas.ARCHIVE_MEASURES, "date", keep, expected_points)


def _table(
    documents: DataFrame, table: str, section: str, measures: Sequence[str], clock: str, keep: Sequence[str],
    expected_points: int | None,
) -> DataFrame:
    columns = schemas.RAW[table].fieldNames()
    rows = flatten(documents, section, measures, clock, expected_points, keep)
    return rows.select(*columns, *[name for name in keep if name not in columns])


def read_raw(spark: SparkSession, raw_dir: str, expected_points: int | None = None) -> dict[str, DataFrame]:
    """The four raw tables over everything landed.

    Every file of every dated run is used, so any run can be replayed. With ``expected_points`` a
    run's document must hold that many points.
    """
    def landed(kind: str) -> list[str]:
        paths = files.matching(spark, f"{raw_dir}/*/{kind}*.json")
        return [path for path in paths if iso_date(path.split("/")[-2]) is not None]

    forecasts = read_documents(spark, "forecast", landed("forecast"))
    floods = read_documents(spark, "flood", landed("flood"))
    windows = read_documents(spark, ARCHIVE, files.matching(spark, f"{raw_dir}/{ARCHIVE}/*.json"))
    return {
        "forecast_daily": flatten_forecast_daily(forecasts, expected_points=expected_points),
        "forecast_hourly": flatten_forecast_hourly(forecasts, expected_points=expected_points),
        "flood_daily": flatten_flood(floods, expected_points=expected_points),
        "archive_daily": flatten_archive(windows),
    }

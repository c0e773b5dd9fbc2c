"""Which archive days the next fetch has to ask for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.operators.backfill import fetch_holes, refetch_windows, split_years
from hazardmarts.params import Params
from hazardmarts.sources.snapshots import archive_last_date, archive_windows


def archive_fetch_plan(
    spark: SparkSession, raw_dir: str, run_date: dt.date, params: Params = Params()
) -> DataFrame:
    """Inclusive windows (start, end) to fetch for a run, one per calendar year, from the names of
    the windows landed so far. The network client that fetches them is not part of this library."""
    landed = spark.createDataFrame([(archive_last_date(spark, raw_dir),)], "date date")
    windows = refetch_windows(
        landed, "date", F.lit(run_date), params.archive_start, params.archive_lag_days, params.archive_refetch_days
    )
    return split_years(windows)


def archive_hole_plan(
    spark: SparkSession, raw_dir: str, run_date: dt.date, params: Params = Params()
) -> DataFrame:
    """As :func:`archive_fetch_plan`, but with a window for every hole that earlier fetches left, not only after the last day."""
    landed = spark.createDataFrame(archive_windows(spark, raw_dir), "start date, end date")
    holes = fetch_holes(
        landed, F.lit(run_date), params.archive_start, params.archive_lag_days, params.archive_refetch_days
    )
    return split_years(holes)

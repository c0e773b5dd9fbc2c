"""Planning which days of a series to ask for again."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.operators.intervals import subtracted


def refetch_windows(
    landed: DataFrame,
    date: str,
    run_date: Column,
    first_day: dt.date,
    lag_days: int,
    refetch_days: int,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Inclusive window (start, end) to fetch, per key or overall.

    The end trails the run by the source's publication lag. The start follows the last landed
    day but always reaches ``refetch_days`` back, because late values replace earlier nulls;
    with nothing landed it is ``first_day``. Empty windows are left out.
    """
    last = landed.groupBy(*keys).agg(F.max(date).alias("_last"))
    end = F.date_sub(run_date, lag_days)
    start = F.when(F.col("_last").isNull(), F.lit(first_day)).otherwise(
        F.least(F.date_add("_last", 1), F.date_sub(end, refetch_days))
    )
    windows = last.select(*keys, start.alias("start"), end.alias("end"))
    return windows.filter(F.col("start") <= F.col("end"))


def fetch_holes(
    landed: DataFrame,
    run_date: Column,
    first_day: dt.date,
    lag_days: int,
    refetch_days: int,
    keys: Sequence[str] = (),
    expected: DataFrame | None = None,
) -> DataFrame:
    """Disjoint inclusive windows that fill every hole of the landed intervals (keys, start, end).

    Asked for are the days from ``first_day`` to the end that the source has published at the run date; held are the
    landed ones but for the last ``refetch_days``, whose values may still change. ``expected`` names keys that may have
    nothing landed at all.
    """
    known = landed.select(*keys).unionByName(expected.select(*keys)) if expected is not None else landed.select(*keys)
    last = F.date_sub(run_date, lag_days)
    spans = known.distinct() if keys else landed.sparkSession.range(1)
    wanted = spans.select(*keys, F.lit(first_day).alias("start"), last.alias("end"))
    settled = landed.select(*keys, "start", F.least(F.col("end"), F.date_sub(last, refetch_days + 1)).alias("end"))
    return subtracted(wanted, settled, keys)


def split_years(windows: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """Cut inclusive windows at 31 December; a window that is empty gives no rows."""
    first, last = F.col(start), F.col(end)
    pieces = windows.filter(first <= last).withColumn(
        "_year", F.explode(F.sequence(F.year(first), F.year(last)))
    )
    return pieces.withColumns(
        {
            start: F.greatest(first, F.make_date("_year", F.lit(1), F.lit(1))),
            end: F.least(last, F.make_date("_year", F.lit(12), F.lit(31))),
        }
    ).drop("_year")

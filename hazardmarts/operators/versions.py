"""Choosing among versions of a row, and among runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def latest_wins(
    df: DataFrame, keys: Sequence[str], order: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key: the one with the greatest ``order``, ties settled by ``tie_break``.

    Drop rows that must not win before calling. The rank-1 filter is planned as a group limit
    on both sides of the exchange, so every input partition sends at most one row per key and a
    key holding a large share of the rows does not travel as a whole.
    """
    newest = Window.partitionBy(*grouping(keys)).orderBy(
        *[F.col(c).desc_nulls_last() for c in (order, *tie_break)]
    )
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def grouping(keys: Sequence[str]) -> list[Column]:
    """Partitioning columns for ranking small groups: the keys, led by their hash.

    The hash follows from the keys, so the groups are the same, but sorting settles nearly every
    comparison on one long instead of on text and further columns.
    """
    return [F.xxhash64(*keys), *map(F.col, keys)]


def latest_run(df: DataFrame, run: str = "run_date", as_of: dt.date | None = None) -> DataFrame:
    """One row holding the newest run (not after ``as_of``); null where there is none."""
    return until_run(df, run, as_of).agg(F.max(run).alias(run))


def given_run(spark: SparkSession, run_date: dt.date, run: str = "run_date") -> DataFrame:
    """One row holding a run date known beforehand, in place of :func:`latest_run`.

    As a scalar subquery it folds to a literal, so date bounds worked out from it reach the scan
    as plain filters; several bounds from one searched run are merged into one subquery, whose
    parts the scan cannot use to skip row groups.
    """
    return spark.sql("SELECT :run_date AS run_date", args={"run_date": run_date}).toDF(run)


def until_run(df: DataFrame, run: str = "run_date", as_of: dt.date | None = None) -> DataFrame:
    """Rows of runs up to ``as_of``; all rows by default."""
    return df if as_of is None else df.filter(F.col(run) <= F.lit(as_of))


def fetched_by(df: DataFrame, run_date: dt.date, utc_offset_hours: int, fetched: str = "fetched_at") -> DataFrame:
    """Rows fetched up to the end of a local day; fetch times are naive UTC."""
    return df.filter(F.col(fetched) < fetch_limit(run_date, utc_offset_hours))


def fetch_limit(run_date: dt.date, utc_offset_hours: int) -> Column:
    """The end of a local day as a naive UTC time."""
    end = dt.datetime.combine(run_date + dt.timedelta(days=1), dt.time()) - dt.timedelta(hours=utc_offset_hours)
    return F.lit(end).cast("timestamp_ntz")


def in_run(df: DataFrame, run_date: Column, run: str = "run_date") -> DataFrame:
    """Rows of one run. With a scalar subquery on a partition column this prunes the scan."""
    return df.filter(F.col(run) == run_date)


def newest_runs(df: DataFrame, run: str, count: int) -> DataFrame:
    """Rows of the ``count`` newest distinct runs, as a lower bound the scan can use."""
    newest = df.select(run).distinct().orderBy(F.col(run).desc_nulls_last()).limit(count)
    return df.filter(F.col(run) >= newest.agg(F.min(run)).scalar())

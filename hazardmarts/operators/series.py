"""Operators on daily series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardmarts.operators.versions import grouping

# Days of one series handled by one window group; about a year keeps groups small and the
# overlap between neighbours below two percent for a weekly frame.
BLOCK_DAYS = 366


def prefer(
    sources: Sequence[tuple[DataFrame, Sequence[str]]], keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """One row per key, from the first source that has the key at all; its newest row there.

    ``sources`` come in order of preference, each with the (date or time) columns that order its
    versions, newest first. ``tie_break`` names columns of all sources; order columns are
    dropped. Ranking the union takes one scan of each source and one exchange, to which each
    input partition sends at most one row per key; removing the covered keys with an anti join
    would scan and rank the preferred source a second time.
    """
    width = max(len(order) for _, order in sources)
    versions = [f"_version_{i}" for i in range(width)]
    ranked = []
    for position, (df, order) in enumerate(sources):
        stamps = [F.col(c).cast("timestamp_ntz") for c in order]
        stamps += [F.lit(None).cast("timestamp_ntz")] * (width - len(order))
        columns = {"_preference": F.lit(position), **dict(zip(versions, stamps))}
        ranked.append(df.withColumns(columns).drop(*order))
    best = Window.partitionBy(*grouping(keys)).orderBy(
        F.col("_preference"), *[F.col(c).desc_nulls_last() for c in (*versions, *tie_break)]
    )
    union = reduce(DataFrame.unionByName, ranked)
    first = union.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1")
    return first.drop("_rank", "_preference", *versions)


def rolling_sums(
    df: DataFrame,
    keys: Sequence[str],
    date: str,
    value: str,
    days: Mapping[str, int],
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """Trailing calendar-day sums: ``days`` maps an output column to its number of days.

    Frames count calendar days, so a gap shortens the sum; null values are skipped. Sum up to one
    row per key and date first where there are many. Each series is cut into blocks of ``block_days``; the last days
    of a block are also handed to the next one as overlap and dropped after the window. So one
    long series is spread over tasks, and all frames share one exchange and one sort.
    """
    overlap = max(days.values()) - 1
    day = F.unix_date(F.col(date))
    first = F.floor(day / F.lit(block_days))
    last = F.floor((day + F.lit(overlap)) / F.lit(block_days))
    spread = (
        df.withColumn("_day", day)
        .withColumn("_home", first)
        .withColumn("_block", F.explode_outer(F.sequence(first, last)))
    )
    series = Window.partitionBy(*keys, "_block").orderBy("_day")
    sums = {
        name: F.sum(value).over(series.rangeBetween(-(span - 1), Window.currentRow))
        for name, span in days.items()
    }
    return spread.withColumns(sums).filter("_block <=> _home").drop("_day", "_home", "_block")


def look_back(df: DataFrame, date: str, run: DataFrame, days: int) -> DataFrame:
    """Rows from ``days`` before the run date on; later dates are unbounded.

    ``run`` is one row with the run date. The bound is worked out inside the scalar subquery, so
    the scan compares the date with a plain value and can skip files and row groups by it.
    """
    bound = run.select(F.date_sub(run.columns[0], days)).scalar()
    return df.filter(F.col(date) >= bound)


def date_bounds(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def date_gaps(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """Calendar days missing between the first and the last date (of each key).

    The calendar is joined on key and date, so a key with a long history is spread by date. Its
    bounds come from the distinct dates, whose exchange both sides of the join then share.
    """
    present = df.select(*keys, F.col(date).alias("date")).distinct()
    calendar = date_bounds(present, "date", keys).select(
        *keys, F.explode(F.expr("sequence(first_date, last_date, interval 1 day)")).alias("date")
    )
    return calendar.join(present, [*keys, "date"], "left_anti")

"""Grouped summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmarts.functions import level_of, severity_of


# Twelve digits behind the point: measures have at most a few, and means are rounded to two.
EXACT = "decimal(30,12)"


def daily_peak(
    df: DataFrame, keys: Sequence[str], value: str, label: str, levels: Sequence[str], peak: str
) -> DataFrame:
    """Greatest value and most severe label per key.

    Labels are compared as numbers, which keeps the aggregation buffer fixed-width and the plan
    a hash aggregation with map-side combine.
    """
    worst = F.max(severity_of(F.col(label), levels)).alias("_severity")
    peaks = df.groupBy(*keys).agg(F.max(value).alias(peak), worst)
    return peaks.select(*keys, peak, level_of(F.col("_severity"), levels).alias(label))


def distinct_text(df: DataFrame, keys: Sequence[str], text: str, name: str, separator: str = ", ") -> DataFrame:
    """Distinct non-null texts per key, sorted and joined. A key with none keeps a null row.

    Duplicates are removed before the exchange, so what reaches one task is the answer itself.
    """
    once = df.select(*keys, text).distinct()
    gathered = once.groupBy(*keys).agg(F.sort_array(F.collect_list(text)).alias("_all"))
    joined = F.when(F.size("_all") > 0, F.array_join("_all", separator))
    return gathered.select(*keys, joined.alias(name))


def spatial_mean(df: DataFrame, date: str, value: str, name: str) -> DataFrame:
    """Mean per date over whatever points have a value that day.

    Values are summed as decimals, so the result does not depend on the order of addition.
    """
    total = F.sum(F.col(value).cast(EXACT)).cast("double")
    return df.groupBy(date).agg((total / F.nullif(F.count(value), F.lit(0))).alias(name))


def monthly_totals(daily: DataFrame, date: str, value: str, total: str) -> DataFrame:
    """Sum, added up as decimals, and number of days per calendar month. Expects one row per date."""
    return daily.groupBy(
        F.year(date).cast("bigint").alias("year"), F.month(date).cast("bigint").alias("month")
    ).agg(F.sum(F.col(value).cast(EXACT)).cast("double").alias(total), F.count(date).alias("days_covered"))


def with_climatology(
    monthly: DataFrame, value: str, years: tuple[int, int], shares: dict[str, float], mean: str
) -> DataFrame:
    """Attach each calendar month's mean and interpolated quantiles over the base years.

    A window over (at most) one row per year of a calendar month replaces aggregating the base
    years apart and joining them back, which would scan and deduplicate the series twice.
    """
    calendar_month = Window.partitionBy("month")
    base = F.when(F.col("year").between(*years), F.col(value))
    columns: dict[str, Column] = {mean: F.avg(base).over(calendar_month)}
    for name, share in shares.items():
        columns[name] = F.percentile(base, F.lit(share)).over(calendar_month)
    return monthly.withColumns(columns)

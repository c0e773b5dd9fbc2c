"""Table tests as queries: each returns what fails, and nothing when the table is sound."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows; null keys are ignored."""
    complete = df.dropna(subset=list(keys))
    return complete.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def is_unexpected(column: str, values: Sequence[object]) -> Column:
    """True for a value outside the list; null is not judged."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def unexpected_values(df: DataFrame, column: str, values: Sequence[object]) -> DataFrame:
    return df.filter(is_unexpected(column, values))


def is_outside(column: str, low: float | None = None, high: float | None = None) -> Column:
    """True for a value below ``low`` or above ``high``; null passes. One bound is required."""
    if low is None and high is None:
        raise ValueError("accepted range needs a lower or an upper bound")
    value = F.col(column)
    tests = ([value < F.lit(low)] if low is not None else []) + ([value > F.lit(high)] if high is not None else [])
    outside = tests[0] if len(tests) == 1 else tests[0] | tests[1]
    return F.coalesce(outside, F.lit(False))


def out_of_range(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(is_outside(column, low, high))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys the parent lacks, with their number of rows; null keys are ignored.

    Counting before the join sends one row per key and input partition over the network, so a
    key that fills the child table costs no more than any other.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    known = parent.select(F.col(field).alias(column)).distinct()
    return used.join(known, column, "left_anti")


def missing_keys(expected: DataFrame, tables: Mapping[str, DataFrame], key: str) -> DataFrame:
    """(table_name, key) for every expected key a table does not have."""
    wanted = expected.select(key).filter(F.col(key).isNotNull()).distinct()
    found = [
        wanted.join(df.select(key).distinct(), key, "left_anti").select(
            F.lit(name).alias("table_name"), key
        )
        for name, df in tables.items()
    ]
    missing = found[0]
    for more in found[1:]:
        missing = missing.unionByName(more)
    return missing


def incomplete_dates(df: DataFrame, date: str, key: str, until: Column, expected: DataFrame) -> DataFrame:
    """Dates up to ``until`` that do not hold as many distinct keys as ``expected`` has rows."""
    wanted = expected.agg(F.count(F.lit(1))).scalar()
    per_date = df.filter(F.col(date) <= until).groupBy(date).agg(F.count_distinct(key).alias("n"))
    return per_date.filter(F.col("n") != wanted)


def null_share(column: str) -> Column:
    """Aggregate: share of null rows; an empty input counts as all null."""
    return F.coalesce(F.avg(F.when(F.col(column).isNull(), 1.0).otherwise(0.0)), F.lit(1.0))

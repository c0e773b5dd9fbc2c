"""Runs and holes of daily series as inclusive intervals of dates.

An interval is a row (keys, start, end) with start not after end. No function expands a calendar: a gap of ten
years is one row. Rows of one key come together once they are distinct, so a key has as many as the calendar has
days, however many rows it had before. Null dates are left out, and so are intervals that are empty or open at an end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """The runs of consecutive days that are present."""
    days = df.where(F.col(date).isNotNull()).select(*keys, F.col(date).alias("day")).distinct()
    # Along a run, the day and its number grow alike.
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("day"))
    runs = days.withColumn("_run", F.date_sub("day", number)).groupBy(*keys, "_run")
    return runs.agg(F.min("day").alias("start"), F.max("day").alias("end")).drop("_run")


def gaps(df: DataFrame, date: str, keys: Sequence[str] = ()) -> DataFrame:
    """The holes between the first and the last day present."""
    following = F.lead("start").over(Window.partitionBy(*keys).orderBy("start"))
    between = islands(df, date, keys).withColumn("_next", following).where("_next is not null")
    return between.select(*keys, F.date_add("end", 1).alias("start"), F.date_sub("_next", 1).alias("end"))


def _sound(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    return intervals.where("start <= end").select(*keys, "start", "end")


def merged(intervals: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Overlapping and adjoining intervals as one each."""
    # Of intervals with the same start the longest says it all.
    longest = _sound(intervals, keys).groupBy(*keys, "start").agg(F.max("end").alias("end"))
    series = Window.partitionBy(*keys).orderBy("start")
    reach = F.max("end").over(series.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.coalesce(F.col("start") > F.date_add(reach, 1), F.lit(True))
    marked = longest.withColumn("_begins", begins.cast("int"))
    grouped = marked.withColumn("_group", F.sum("_begins").over(series)).groupBy(*keys, "_group")
    return grouped.agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_group")


def subtracted(wanted: DataFrame, held: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The parts of ``wanted`` that no interval of ``held`` covers, as disjoint intervals.

    Both are merged and turned into their ends. Between two neighbouring ends nothing changes, so a stretch is kept if
    it is wanted and not held. Rows with null keys belong to each other, as in grouping.
    """

    def ends(intervals: DataFrame, wants: int, holds: int) -> DataFrame:
        one = merged(intervals, keys)
        begin = F.struct(F.col("start").alias("day"), F.lit(wants).alias("wants"), F.lit(holds).alias("holds"))
        after = F.struct(F.date_add("end", 1).alias("day"), F.lit(-wants).alias("wants"), F.lit(-holds).alias("holds"))
        return one.select(*keys, F.inline(F.array(begin, after)))

    changes = ends(wanted, 1, 0).unionByName(ends(held, 0, 1)).groupBy(*keys, "day").agg(
        F.sum("wants").alias("wants"), F.sum("holds").alias("holds")
    )
    series = Window.partitionBy(*keys).orderBy("day")
    stretches = changes.select(
        *keys, F.col("day").alias("start"), F.date_sub(F.lead("day").over(series), 1).alias("end"),
        F.sum("wants").over(series).alias("wants"), F.sum("holds").over(series).alias("holds"),
    )
    # Ends of held intervals outside the wanted ones cut nothing; neighbours that are both kept belong together.
    return merged(stretches.where("wants > 0 and holds = 0"), keys)


def days(intervals: DataFrame, name: str = "date") -> DataFrame:
    """Every day of every interval."""
    every = F.explode(F.expr("sequence(start, end, interval 1 day)")).alias(name)
    return intervals.where("start <= end").select(*[c for c in intervals.columns if c not in ("start", "end")], every)

"""Weather-shaped raw tables derived from the provided tables, row by row.

lineitem plays the observed archive (several versions per point and day, some null), events play
the forecast, hourly and river rows of thirty daily runs, and customers are the areas: fifteen
per supplier, which stands for a lattice point. Values are multiples of a sixteenth, so
double sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardmarts.params import Params

# Days from the line items' calendar to the events' one: the archive ends 5 days before the last run.
SHIFT_DAYS = 8117
PARAMS = Params(normal_years=(2018, 2022))


# Schemas by path: telling a file's schema is a job of its own, and models open a table several times.
_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def archive_daily(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    day = F.date_add(F.to_date("l_shipdate"), SHIFT_DAYS)
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("grid_id"),
        day.alias("date"),
        F.when(F.col("l_discount") > 0, F.col("l_quantity") / 4).alias("precipitation_sum"),
        F.col("l_linenumber").cast("double").alias("precipitation_hours"),
        F.date_add(day, F.col("l_linenumber")).cast("timestamp_ntz").alias("fetched_at"),
        *extra,
    )


def _event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_date = F.to_date("ts")
    offset = (F.pmod("event_id", F.lit(14)) - 7).cast("int")
    return table(spark, sf_dir, "events").select(
        run_date.alias("run_date"),
        F.col("user_id").cast("string").alias("grid_id"),
        F.date_add(run_date, offset).alias("date"),
        F.timestamp_add("DAY", offset, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("hour"),
        F.col("ts").alias("fetched_at"),
        "event_id",
        F.floor(F.col("value") * 4).cast("double").alias("quarters"),
    )


def forecast_daily(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return _event_rows(spark, sf_dir).select(
        "run_date", "grid_id", "date",
        F.when(F.pmod("event_id", F.lit(25)) != 3, F.col("quarters") / 16).alias("precipitation_sum"),
        F.pmod("event_id", F.lit(101)).cast("double").alias("precipitation_probability_max"),
        F.pmod("event_id", F.lit(25)).cast("double").alias("precipitation_hours"),
        "fetched_at", *extra,
    )


def forecast_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _event_rows(spark, sf_dir).select(
        "run_date", "grid_id", F.col("hour").alias("ts"),
        F.when(F.pmod("event_id", F.lit(20)) != 7, F.col("quarters") / 16).alias("precipitation"),
        "fetched_at",
    )


def flood_daily(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    flow = F.col("quarters") / 4
    return _event_rows(spark, sf_dir).select(
        "run_date", "grid_id", "date",
        flow.alias("river_discharge"),
        F.when(F.pmod("event_id", F.lit(30)) != 0, flow * 1.5).alias("river_discharge_max"),
        "fetched_at", *extra,
    )


def dim_barangay(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    people = F.pmod(key, F.lit(5000)) + 100
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("A"), key.cast("string")).alias("pcode"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("city"),
        people.alias("population"),
        F.when(F.col("c_acctbal") >= 0, F.floor(F.col("c_acctbal") / 25).cast("double") / 4).alias("score"),
        F.pmod(key, F.lit(1710)).cast("int").alias("rank_ncr"),
        (F.pmod(key, F.lit(8)) / 8).alias("pct_area_mh_25"),
        F.floor(people / 2).alias("est_pop_exposed_25"),
        (F.lit(14.35) + F.pmod(key, F.lit(46)) * F.lit(0.01)).alias("lat"),
        (F.lit(120.9) + F.pmod(key, F.lit(26)) * F.lit(0.01)).alias("lon"),
        F.floor(key / 15).cast("string").alias("grid_id"),
    )


class Sources(Mapping[str, DataFrame]):
    """The raw tables and the dimension by name, each opened only when asked for."""

    _readers = {f.__name__: f for f in (forecast_daily, forecast_hourly, flood_daily, archive_daily, dim_barangay)}

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._where = (spark, sf_dir)

    def __getitem__(self, name: str) -> DataFrame:
        return self._readers[name](*self._where)

    def __iter__(self) -> Iterator[str]:
        return iter(self._readers)

    def __len__(self) -> int:
        return len(self._readers)

"""Table rows packed into snapshot documents of parallel arrays, then flattened by the reader.

A document holds the rows of one fetch and point whose ids share a thousand, so its arrays stay
short however many rows a point has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.sources import points, snapshots, tables
from workload import twin
from workload.landed import ALL_RAW, flat, folder
from workload.registry import query
from workload.twin_sql import over


def _thousand(key: str) -> Column:
    return F.floor(F.col(key) / 1000).alias("thousand")


def _documents(
    rows: DataFrame, section: str, clock: str, measures: Sequence[str], offset: str = "+00:00"
) -> DataFrame:
    pattern = "yyyy-MM-dd" if clock == "date" else "yyyy-MM-dd'T'HH:mm"
    run_date = F.col("run_date") if "run_date" in rows.columns else F.col("date")
    text = rows.select(
        F.date_format(run_date, "yyyy-MM-dd").alias("run_date"),
        F.concat(F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(offset)).alias("fetched_at"),
        "grid_id", "thousand",
        F.date_format(clock, pattern).alias("time"),
        *[F.col(m).cast("string").alias(m) for m in measures],
    )
    packed = text.groupBy("run_date", "fetched_at", "grid_id", "thousand").agg(
        F.collect_list(F.struct("time", *measures)).alias("steps")
    )
    arrays = [F.col(f"steps.{name}").alias(name) for name in ("time", *measures)]
    response = F.struct(F.struct(*arrays).alias(section))
    point = F.struct("grid_id", response.alias("response"))
    return packed.select("run_date", "fetched_at", F.array(point).alias("points"))


@query(over("raw_forecast", query="SELECT * FROM raw_forecast"))
def flatten_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = twin.forecast_daily(spark, sf_dir, _thousand("event_id"))
    return snapshots.flatten_forecast_daily(_documents(rows, "daily", "date", schemas.FORECAST_DAILY_MEASURES))


@query(over("raw_flood", query="SELECT * FROM raw_flood"))
def flatten_flood(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = twin.flood_daily(spark, sf_dir, _thousand("event_id"))
    return snapshots.flatten_flood(_documents(rows, "daily", "date", schemas.FLOOD_MEASURES))


@query(over("raw_archive", query="SELECT * FROM raw_archive"))
def flatten_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = twin.archive_daily(spark, sf_dir, _thousand("l_orderkey"))
    return snapshots.flatten_archive(_documents(rows, "daily", "date", schemas.ARCHIVE_MEASURES))


@query("""
SELECT CAST(ts AS DATE) AS run_date, CAST(user_id AS VARCHAR) AS grid_id, date_trunc('minute', ts) AS ts,
       if(event_id % 10 = 0, NULL, value) AS precipitation, date_trunc('minute', ts) - INTERVAL 8 HOUR AS fetched_at
FROM events""")
def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly section; fetch times carry an offset of eight hours."""
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    rows = twin.table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("run_date"),
        F.col("user_id").cast("string").alias("grid_id"),
        minute.alias("ts"),
        F.when(F.pmod("event_id", F.lit(10)) != 0, F.col("value")).alias("precipitation"),
        minute.alias("fetched_at"),
        _thousand("event_id"),
    )
    documents = _documents(rows, "hourly", "ts", schemas.FORECAST_HOURLY_MEASURES, offset="+08:00")
    return snapshots.flatten_forecast_hourly(documents)


def _forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose points have both sections, the days and the hours of the same fetch."""
    keys = ["run_date", "grid_id", "fetched_at"]
    days = twin.forecast_daily(spark, sf_dir, F.col("event_id"), F.col("hour"), F.col("quarters"))
    hour = F.when(F.pmod("event_id", F.lit(20)) != 7, F.col("quarters") / 16)
    daily = [F.date_format("date", "yyyy-MM-dd").alias("time"), *[F.col(m).cast("string").alias(m) for m in schemas.FORECAST_DAILY_MEASURES]]
    hourly = [F.date_format("hour", "yyyy-MM-dd'T'HH:mm").alias("time"), hour.cast("string").alias("precipitation")]
    packed = days.groupBy(*keys, _thousand("event_id")).agg(
        F.collect_list(F.struct(F.struct(*daily).alias("d"), F.struct(*hourly).alias("h"))).alias("s")
    )
    section = lambda part, names: F.struct(*[F.col(f"s.{part}.{n}").alias(n) for n in names])
    response = F.struct(
        section("d", ("time", *schemas.FORECAST_DAILY_MEASURES)).alias("daily"),
        section("h", ("time", *schemas.FORECAST_HOURLY_MEASURES)).alias("hourly"),
    )
    stamp = F.concat(F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    return packed.select(
        F.date_format("run_date", "yyyy-MM-dd").alias("run_date"), stamp.alias("fetched_at"),
        F.array(F.struct("grid_id", response.alias("response"))).alias("points"),
    )


@query(ALL_RAW)
def landed_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw tables from JSON lines: written, landed by the incremental stream in two runs, and read back."""
    raw, out = folder(spark, sf_dir, "lines"), folder(spark, sf_dir, "landed")
    flood = _documents(twin.flood_daily(spark, sf_dir, _thousand("event_id")), "daily", "date", schemas.FLOOD_MEASURES)
    archive = _documents(twin.archive_daily(spark, sf_dir, _thousand("l_orderkey")), "daily", "date", schemas.ARCHIVE_MEASURES)
    points.write_points(_forecast_documents(spark, sf_dir), "forecast", raw)
    points.write_points(flood.where("run_date < '2024-01-16'"), "flood", raw)
    points.write_points(archive.withColumn("run_date", F.concat(F.substring("run_date", 1, 4), F.lit("-01-01"))), "archive", raw)
    points.land_points(spark, raw, out)
    points.write_points(flood.where("run_date >= '2024-01-16'"), "flood", raw)
    points.land_points(spark, raw, out)
    return flat(tables.read_landed(spark, out))

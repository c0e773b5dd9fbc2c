"""Flat tables: the landed raw tables and the area dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from hazardmarts import schemas

# Tables keyed by run are laid out by run, so that "the newest run" reads one directory.
PARTITIONS = {"forecast_daily": ["run_date"], "forecast_hourly": ["run_date"], "flood_daily": ["run_date"]}


def land(raw: dict[str, DataFrame], out_dir: str) -> None:
    """Write the raw tables as Parquet, replacing earlier content; repeating it changes nothing."""
    for name, df in raw.items():
        df.write.mode("overwrite").partitionBy(*PARTITIONS.get(name, [])).parquet(f"{out_dir}/{name}")


def read_landed(spark: SparkSession, out_dir: str, names: Iterable[str] = tuple(schemas.RAW)) -> dict[str, DataFrame]:
    """Landed tables under their declared schemas, also when no file was written for one."""

    def read(name: str) -> DataFrame:
        schema = schemas.RAW[name]
        return spark.read.schema(schema).parquet(f"{out_dir}/{name}").select(*schema.fieldNames())

    return {name: read(name) for name in names}


def row_counts(tables: dict[str, DataFrame]) -> dict[str, int]:
    """Rows per table; on Parquet this reads the file footers only."""
    return {name: df.count() for name, df in tables.items()}


def register(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Offer tables to SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Areas from CSV with declared types; text that does not fit its type raises."""
    reader = spark.read.schema(schemas.DIMENSION).option("header", True).option("mode", "FAILFAST")
    return reader.option("escape", '"').csv(path)


def read_columns(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """Named columns of a Parquet table; the others are never read."""
    return spark.read.parquet(path).select(*columns)

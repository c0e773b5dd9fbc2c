"""One row per run, appended; values a run did not reach stay empty."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from hazardmarts import schemas

# The statuses that readers of the log know.
STATUSES = ("ok", "fetch_failed", "gate_failed", "dbt_failed", "error")


def append_run(spark: SparkSession, path: str, row: Mapping[str, object]) -> None:
    unknown = set(row) - set(schemas.RUN_LOG.fieldNames())
    if unknown or row.get("status") not in STATUSES:
        raise ValueError(f"not a run log row: {dict(row)}")
    values = tuple(row.get(name) for name in schemas.RUN_LOG.fieldNames())
    entry = spark.createDataFrame([values], schemas.RUN_LOG).coalesce(1)
    entry.write.mode("append").option("header", True).option("escape", '"').csv(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RUN_LOG).option("header", True).option("escape", '"').csv(path)

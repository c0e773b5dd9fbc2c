"""Queries that write a table, log or extract and read it back through the library's own readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.plans.build import build_models
from hazardmarts.sinks import extracts, runlog
from hazardmarts.sources import tables
from workload import twin
from workload.landed import folder
from workload.registry import query
from workload.twin_sql import over

_RAW = ("raw_forecast", "raw_hourly", "raw_flood", "raw_archive")


def _landed(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    out = folder(spark, sf_dir, "raw")
    sources = twin.Sources(spark, sf_dir)
    tables.land({name: sources[name] for name in schemas.RAW}, out)
    return tables.read_landed(spark, out)


@query(over(*_RAW, query="""
SELECT 'forecast_daily' AS table_name, count(*) AS n FROM raw_forecast UNION ALL SELECT 'forecast_hourly', count(*) FROM raw_hourly
UNION ALL SELECT 'flood_daily', count(*) FROM raw_flood UNION ALL SELECT 'archive_daily', count(*) FROM raw_archive"""))
def landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per landed table, from the file footers."""
    return spark.createDataFrame(sorted(tables.row_counts(_landed(spark, sf_dir)).items()), "table_name string, n bigint")


@query(over(*_RAW, query="""
SELECT f.grid_id, count(*) AS days, count(*) FILTER (WHERE f.grid_id IN (SELECT grid_id FROM raw_archive)) AS observed_days
FROM raw_forecast f GROUP BY f.grid_id"""))
def declared_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed tables offered to SQL under their names, and asked there."""
    tables.register(_landed(spark, sf_dir), prefix="src_")
    return spark.sql("""
        SELECT f.grid_id, count(*) AS days, count(a.grid_id) AS observed_days FROM src_forecast_daily f
        LEFT JOIN (SELECT DISTINCT grid_id FROM src_archive_daily) a ON a.grid_id = f.grid_id GROUP BY f.grid_id""")


@query(over("dim", query="SELECT * FROM dim"))
def dimension_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension written as the sorted seed and read back with its declared types."""
    path = f"{folder(spark, sf_dir, 'seed')}/dim_barangay.csv"
    extracts.write_dimension(twin.dim_barangay(spark, sf_dir).select(*schemas.DIMENSION.fieldNames()), path)
    return tables.read_dimension(spark, path)


@query(over("dashboard", query="SELECT pcode, date, wet_exposure, warning_level FROM dashboard"))
def dashboard_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Parquet extract of the dashboard, of which four columns are read."""
    path = f"{folder(spark, sf_dir, 'extract')}/dashboard.parquet"
    dashboard = build_models(twin.Sources(spark, sf_dir), twin.PARAMS, names=["mart_dashboard"])["mart_dashboard"]
    _, columns, order = extracts.EXTRACTS["dashboard"]
    extracts.ordered(dashboard, columns, order).write.parquet(path)
    return tables.read_columns(spark, path, "pcode", "date", "wet_exposure", "warning_level")


@query(over("raw_forecast", "raw_flood", "raw_archive", "run", query="""
SELECT CAST((SELECT run_date FROM run) AS VARCHAR) AS run_date, status, (SELECT count(*) FROM raw_forecast) AS forecast_rows,
       (SELECT count(*) FROM raw_flood) AS flood_rows, (SELECT count(*) FROM raw_archive) AS archive_rows,
       CAST(NULL AS BIGINT) AS dashboard_rows, gates
FROM (VALUES ('ok', 'a=pass'), ('gate_failed', 'a=fail("quoted", text)')) t(status, gates)"""))
def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two entries with the counts of the raw tables, appended to the log and read back."""
    path, sources = f"{folder(spark, sf_dir, 'log')}/runs", twin.Sources(spark, sf_dir)
    counted = {"forecast_rows": "forecast_daily", "flood_rows": "flood_daily", "archive_rows": "archive_daily"}
    entry = {name: sources[table].count() for name, table in counted.items()}
    entry["run_date"] = str(sources["forecast_daily"].agg(F.max("run_date")).first()[0])
    for status, gates in (("ok", "a=pass"), ("gate_failed", 'a=fail("quoted", text)')):
        runlog.append_run(spark, path, entry | {"status": status, "gates": gates, "duration_s": "1.0"})
    return runlog.read_runs(spark, path).drop("started_at_utc", "duration_s")

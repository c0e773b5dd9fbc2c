"""Extract files: ordered, with text forms that spreadsheet tools and pandas read back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmarts import schemas
from hazardmarts.functions import python_float_text
from hazardmarts.plans.views import freshness

# Extract name: model, columns in output order, sort order.
EXTRACTS = {
    "dashboard": ("mart_dashboard", schemas.DASHBOARD_COLUMNS, ("date", "pcode")),
    "warnings": ("fct_warnings_hourly", schemas.WARNINGS_COLUMNS, ("grid_id", "ts")),
    "river": ("fct_river_grid_daily", schemas.RIVER_COLUMNS, ("grid_id", "date")),
    "monthly_normal": ("mart_monthly_normal", schemas.MONTHLY_COLUMNS, ("year", "month")),
}

# Attribution of the public weather data.
ATTRIBUTION = (
    "Open-Meteo forecast API (https://open-meteo.com), CC BY 4.0",
    "Open-Meteo flood API, GloFAS river discharge (Copernicus Emergency Management Service)",
    "Open-Meteo historical weather API, ERA5 reanalysis (Copernicus Climate Change Service)",
)
NOTE = "All rain and river values come from models; none is a gauge reading."


def ordered(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The column contract in a global order; nulls last, as SQL engines put them."""
    return df.select(*columns).orderBy(*[F.col(c).asc_nulls_last() for c in order])


def as_text(df: DataFrame) -> DataFrame:
    """Doubles and booleans in the spelling of Python; other types are left to the CSV writer.

    All doubles of a row are spelled by one function over an array. Written out for every column, the generated code of
    the rows becomes longer than what the JVM compiles, and is interpreted.
    """
    doubles = [field.name for field in df.schema if isinstance(field.dataType, T.DoubleType)]
    place = {name: i for i, name in enumerate(doubles)}
    texts = "_texts_of_doubles"
    spelled = df.withColumn(texts, F.transform(F.array(*doubles), python_float_text)) if doubles else df
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if field.name in place:
            column = F.col(texts)[place[field.name]]
        elif isinstance(field.dataType, T.BooleanType):
            column = F.initcap(column.cast("string"))
        columns.append(column.alias(field.name))
    return spelled.select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, ISO dates, seconds without fractions, doubled quotes; rows keep their order over
    the numbered part files."""
    (
        as_text(df)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("dateFormat", "yyyy-MM-dd")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss")
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("escape", '"')
    return reader.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path)


def write_extracts(models: Mapping[str, DataFrame], out_dir: str) -> None:
    """All CSV extracts and the dashboard as Parquet, whose rows the CSV is then written from."""
    for name, (model, columns, order) in EXTRACTS.items():
        rows = ordered(models[model], columns, order)
        if name == "dashboard":
            rows.write.mode("overwrite").parquet(f"{out_dir}/{name}.parquet")
            written = rows.sparkSession.read.schema(rows.schema).parquet(f"{out_dir}/{name}.parquet")
            rows = ordered(written, columns, order)
        write_csv(rows, f"{out_dir}/{name}.csv")


def write_dimension(dimension: DataFrame, path: str) -> None:
    """The dimension sorted by area code, as CSV."""
    write_csv(ordered(dimension, schemas.DIMENSION.fieldNames(), ["pcode"]), path)


def run_metadata(
    mart_dashboard: DataFrame,
    gates: DataFrame,
    run_date: dt.date,
    generated_at: dt.datetime,
    sources: Sequence[str] = ATTRIBUTION,
    note: str = NOTE,
) -> DataFrame:
    """One row describing the run; as JSON it is the metadata document."""
    outcome = F.struct("gate", F.when(F.col("passed"), "pass").otherwise("fail"))
    by_gate = gates.agg(F.map_from_entries(F.collect_list(outcome))).scalar()  # one entry per gate
    dates = ("latest_observed_date", "forecast_through")
    return freshness(mart_dashboard).select(
        F.lit(run_date.isoformat()).alias("run_date"),
        F.lit(generated_at.isoformat(timespec="seconds")).alias("generated_at_utc"),
        "dashboard_rows",
        *[F.col(c).cast("string").alias(c) for c in dates],
        "active_grid_points",
        by_gate.alias("gates"),
        F.array(*map(F.lit, sources)).alias("sources"),
        F.lit(note).alias("note"),
    )


def write_metadata(metadata: DataFrame, path: str) -> None:
    metadata.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)

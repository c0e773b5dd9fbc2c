"""Landing at scale: snapshot points as JSON lines, read once each by an incremental stream.

Layout: ``<raw>/<kind>/run_date=<date>/*.json`` with one point per line (run_date is the directory;
archive points have a ``run_date`` too, the day of their fetch). A document of many points can so be split over tasks, the
engine lists and remembers the files (its checkpoint is the log of what was landed), and nothing passes the driver. Files are
not changed once written; a later fetch is a new file.

Each run of :func:`land_points` takes all files that are new, parses every line once and writes
all tables of its kind. A batch replaces its own directory, so a batch that is repeated after a failure lands once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmarts import schemas
from hazardmarts.sources import snapshots

# Kind of snapshot: its tables and their readers.
TABLES = {
    "forecast": {
        "forecast_daily": snapshots.flatten_forecast_daily, "forecast_hourly": snapshots.flatten_forecast_hourly,
    },
    "flood": {"flood_daily": snapshots.flatten_flood},
    snapshots.ARCHIVE: {"archive_daily": snapshots.flatten_archive},
}


def line_schema(kind: str) -> T.StructType:
    """A line: the fetch time and the fields of a point."""
    point = schemas.SNAPSHOT[kind]["points"].dataType.elementType
    return T.StructType([T.StructField("fetched_at", T.StringType()), *point.fields])


def write_points(documents: DataFrame, kind: str, raw_dir: str) -> None:
    """The points of documents (run_date, fetched_at, points) as lines, a directory per run date."""
    points = documents.select("run_date", "fetched_at", F.inline("points"))
    points.write.mode("append").partitionBy("run_date").json(f"{raw_dir}/{kind}")


def as_documents(lines: DataFrame) -> DataFrame:
    """Lines in the shape of documents of one point each."""
    fields = [c for c in lines.columns if c not in ("run_date", "fetched_at")]
    run_date: Column = F.date_format("run_date", "yyyy-MM-dd").alias("run_date")
    return lines.select(run_date, "fetched_at", F.array(F.struct(*fields)).alias("points"))


def land_points(spark: SparkSession, raw_dir: str, out_dir: str, kinds: tuple[str, ...] = tuple(TABLES)) -> None:
    """Append the points of all new files to the tables under ``out_dir``, and return when that is done."""
    for kind in kinds:

        def write(batch: DataFrame, number: int, readers: Mapping = TABLES[kind]) -> None:
            # Only lines of several tables are kept parsed between them.
            documents = as_documents(batch)
            documents = documents.persist() if len(readers) > 1 else documents
            try:
                for table, flatten in readers.items():
                    rows = flatten(documents).withColumn("batch", F.lit(number))
                    layout = ["batch", *[c for c in ("run_date",) if c in rows.columns]]
                    target = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    target.partitionBy(*layout).parquet(f"{out_dir}/{table}")
            finally:
                if len(readers) > 1:
                    documents.unpersist()

        schema = T.StructType([*line_schema(kind).fields, T.StructField("run_date", T.DateType())])
        lines = spark.readStream.schema(schema).option("mode", "FAILFAST").json(f"{raw_dir}/{kind}")
        query = (
            lines.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{out_dir}/_log/{kind}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.session import shared_dir

# ASCII white space, as characters and as a regular expression.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared folder; only where none is set, under the warehouse."""
    base = shared_dir(spark, fallback=spark.conf.get("spark.sql.warehouse.dir"))
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: cuts lineage and survives lost executors."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps. Spark deletes them when the driver's memory is next collected, which a driver with
    little to do puts off, so that they stay beside those of the next steps."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


class Carried:
    """A value for all tasks, broadcast as bytes that carry the code of its classes too: a broadcast object itself could only be
    read where the package is installed. A worker process decodes it once."""

    def __init__(self, spark: SparkSession, value: object) -> None:
        self.held = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        if not hasattr(self.held, "decoded"):
            self.held.decoded = cloudpickle.loads(self.held.value)
        return self.held.decoded


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, wherever ``body`` repeats it."""
    return F.transform(F.array(value), body)[0]


def text_of(name: str = "text") -> Column:
    """A text column with null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def split_words(text: Column) -> Column:
    """Words between ASCII white space, in order; an empty array for a text without a word."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def fold(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; -1 for a null id, which so belongs to no held-out part."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))

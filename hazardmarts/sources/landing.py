"""Landing only what changed, with the result of a full reload.

Reading every snapshot again each day costs more every day. Here the landed files are listed,
with their times and sizes, beside the tables; a run or archive window is read again only when
one of its files is new or differs, and dropped when its files are gone. Each such unit is a directory of its own that is replaced as a whole, and
the list is written last, so an interrupted landing is simply repeated.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmarts import schemas
from hazardmarts.operators.checks import is_outside
from hazardmarts.sources import files, snapshots

MANIFEST = "landed_files.json"
FACTS = "landed_facts.json"
# Units whose rows are counted one by one in the pass that writes them; more are counted by one aggregation afterwards.
OBSERVED_UNITS = 16

# Table: kind of document, reader of its rows, directory column.
_TABLES = {
    "forecast_daily": ("forecast", snapshots.flatten_forecast_daily, "run_date"),
    "forecast_hourly": ("forecast", snapshots.flatten_forecast_hourly, "run_date"),
    "flood_daily": ("flood", snapshots.flatten_flood, "run_date"),
    "archive_daily": (snapshots.ARCHIVE, snapshots.flatten_archive, "window"),
}
Units = dict[str, dict[str, list[int]]]  # unit: path: modification time and size


def land_changes(
    spark: SparkSession, raw_dir: str, out_dir: str, full: bool = False, expected_points: int | None = None
) -> dict[str, int]:
    """Bring the landed tables up to date; returns how many units each table read again.

    With ``full``, or where there is no list of landed files, everything is read again. With
    ``expected_points`` a run's document that holds another number of points raises.
    """
    known = None if full else files.read_text(spark, f"{out_dir}/{MANIFEST}")
    before: dict[str, Units] = json.loads(known) if known else {}
    now = _landable(spark, raw_dir)
    read_again, counted = {}, {}
    for table, (kind, flatten, unit) in _TABLES.items():
        old, new = before.get(table, {}), now[table]
        changed = [u for u in new if old.get(u) != new[u]]
        if not old:
            files.remove(spark, f"{out_dir}/{table}")
        for name in {*changed, *(set(old) - set(new))}:
            files.remove(spark, f"{out_dir}/{table}/{unit}={name}")
        documents = snapshots.read_documents(spark, kind, sorted(p for u in changed for p in new[u]))
        if changed or not old:
            expected = None if kind == snapshots.ARCHIVE else expected_points
            rows = flatten(_filed(documents, unit, bool(changed)), keep=[unit], expected_points=expected)
            counted[table] = _written(rows, f"{out_dir}/{table}", table, unit, changed)
        read_again[table] = len(changed)
    _note_facts(spark, out_dir, before, now, counted)
    files.write_text(spark, f"{out_dir}/{MANIFEST}", json.dumps(now))
    return read_again


def write_observed(rows: DataFrame, path: str, unit: str, measures: Mapping[str, Column]) -> dict[str, object]:
    """Append rows by unit and return aggregates of them, taken in the same pass.

    Only the result of the attempt that a task ends with counts, so a task that is run again does not count twice.
    """
    seen = Observation()
    named = [column.alias(name) for name, column in measures.items()]
    rows.observe(seen, *named).write.mode("append").partitionBy(unit).parquet(path)
    return seen.get


def _measures(table: str, unit: str, of: str) -> dict[str, Column]:
    """What the gates ask of one run; a null measure is never out of range."""
    here = F.col(unit).cast("string") == of
    found = {"rows": F.count_if(here)}
    if table == "forecast_daily":
        found["horizon"] = F.max(F.when(here, F.col("date").cast("string")))
        found["nulls"] = F.count_if(here & F.col("precipitation_sum").isNull())
        found["lowest"] = F.min(F.when(here, F.col("precipitation_sum")))
        found["highest"] = F.max(F.when(here, F.col("precipitation_sum")))
    if table == "flood_daily":
        below = is_outside("river_discharge", low=0.0) | is_outside("river_discharge_max", low=0.0)
        found["negative"] = F.count_if(here & below)
    return found


def _written(rows: DataFrame, path: str, table: str, unit: str, units: Sequence[str]) -> dict[str, dict]:
    """Write the units of a table; returns the facts of each."""
    singly = list(units) if len(units) <= OBSERVED_UNITS else [max(units)]
    wanted = {f"{i}:{name}": c for i, u in enumerate(singly) for name, c in _measures(table, unit, u).items()}
    seen = write_observed(rows, path, unit, wanted or {"rows": F.count("*")})
    facts: dict[str, dict] = {u: {} for u in units}
    for i, u in enumerate(singly):
        facts[u] = {name: seen[f"{i}:{name}"] for name in _measures(table, unit, u)}
    if len(singly) < len(units):
        # At most one row per unit; only the directories' names and the files' footers are read.
        counts = rows.sparkSession.read.parquet(path).groupBy(F.col(unit).cast("string").alias("u")).count().collect()
        found = {row["u"]: row["count"] for row in counts}
        facts = {u: {"rows": found.get(u, 0)} | known for u, known in facts.items()}
    return facts


def _note_facts(
    spark: SparkSession, out_dir: str, before: dict[str, Units], now: dict[str, Units], counted: dict[str, dict[str, dict]]
) -> None:
    """Facts of all units that are landed now; units known before without facts get none, and are counted when asked for."""
    known = landed_facts(spark, out_dir) if before else {}
    facts = {t: {u: f for u, f in (known.get(t, {}) | counted.get(t, {})).items() if u in now[t]} for t in now}
    files.write_text(spark, f"{out_dir}/{FACTS}", json.dumps(facts, default=str))


def landed_facts(spark: SparkSession, out_dir: str) -> dict[str, dict[str, dict]]:
    """By table and unit, what was counted while it was written."""
    text = files.read_text(spark, f"{out_dir}/{FACTS}")
    return json.loads(text) if text else {}


def landed_rows(spark: SparkSession, out_dir: str, table: str) -> int | None:
    """Rows of a landed table, from the facts of its units; None if one of them has none."""
    units, facts = landed_units(spark, out_dir)[table], landed_facts(spark, out_dir).get(table, {})
    counts = [facts.get(u, {}).get("rows") for u in units]
    return None if None in counts else sum(counts)


def landed_units(spark: SparkSession, out_dir: str) -> dict[str, Units]:
    """The landed units of every table, with the files they came from."""
    known = files.read_text(spark, f"{out_dir}/{MANIFEST}")
    return {table: {} for table in _TABLES} | (json.loads(known) if known else {})


def read_units(spark: SparkSession, out_dir: str, table: str, units: Collection[str]) -> DataFrame:
    """Rows of some units of a landed table; the scan opens their directories only."""
    unit, schema = _TABLES[table][2], schemas.RAW[table]
    partitioned = schema if unit in schema.fieldNames() else T.StructType([*schema, T.StructField(unit, T.StringType())])
    rows = spark.read.schema(partitioned).parquet(f"{out_dir}/{table}")
    chosen = F.col(unit).cast("string").isin(*sorted(units)) if units else F.lit(False)
    return rows.where(chosen).select(*schema.fieldNames())


def _landable(spark: SparkSession, raw_dir: str) -> dict[str, Units]:
    def per_run(kind: str) -> Units:
        units: Units = {}
        for path, stamp in files.stats(spark, f"{raw_dir}/*/{kind}*.json").items():
            directory = path.split("/")[-2]
            if snapshots.iso_date(directory) is not None:
                units.setdefault(directory, {})[path] = stamp
        return units

    archive = files.stats(spark, f"{raw_dir}/{snapshots.ARCHIVE}/*.json")
    return {
        "forecast_daily": per_run("forecast"),
        "forecast_hourly": per_run("forecast"),
        "flood_daily": per_run("flood"),
        "archive_daily": {p.split("/")[-1].removesuffix(".json"): {p: stamp} for p, stamp in archive.items()},
    }


def _filed(documents: DataFrame, unit: str, has_files: bool) -> DataFrame:
    """Documents with the directory column; a run must lie in the directory of its date."""
    if unit == "window":
        stem = F.regexp_extract("_metadata.file_name", r"(.*)\.json$", 1) if has_files else F.lit("")
        return documents.withColumn("window", stem)
    if not has_files:
        return documents
    directory = F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1)
    misfiled = F.raise_error(F.concat(F.lit("snapshot of another date in directory "), directory))
    filed = F.when(F.col("run_date") == directory, F.col("run_date")).otherwise(misfiled)
    return documents.withColumn("run_date", filed)

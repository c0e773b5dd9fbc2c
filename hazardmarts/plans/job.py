"""The daily job as a list of stages: day, load, gates, models, table tests, publish.

A run that ended half-way goes on from its last finished stage when it is started again on the same inputs: a ledger
in the work folder has the results of gates, models, tests and publication. Finding the day and landing
changes cost little and are always done, since they tell what the inputs are.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmarts.params import Params
from hazardmarts.plans import gates as gate_plans
from hazardmarts.plans import incremental
from hazardmarts.plans.build import build_models
from hazardmarts.plans.ledger import Ledger, fingerprint
from hazardmarts.plans.table_tests import run_table_tests
from hazardmarts.sinks import extracts, publish, runlog
from hazardmarts.sources import snapshots, tables
from hazardmarts.sources.landing import land_changes, landed_facts, landed_rows, landed_units

LOG = logging.getLogger(__name__)

# Models that a replay writes as tables; the other staging models stay views over the landed Parquet. The
# staged archive is written because ranking all its versions is the widest exchange and three
# readers follow. Writing also cuts lineage: what was written is not recomputed when an
# executor is lost later on.
WRITTEN = (
    "stg_archive_daily", "int_rain_daily_unioned", "int_rain_rolling", "fct_warnings_hourly", "int_warnings_daily",
    "fct_rain_barangay_daily", "mart_dashboard", "fct_river_grid_daily", "mart_monthly_normal",
)


class FailedTests(RuntimeError):
    """Table tests that found rows, named in the message."""


class Stop(Exception):
    """Ends the job in order: the status for the log, and what to put there as outcome of the gates."""

    def __init__(self, status: str, note: str) -> None:
        super().__init__(note)
        self.status, self.note = status, note


@dataclass
class Job:
    """What the stages share: the request, what they have made so far, and the log entry."""

    spark: SparkSession
    raw_dir: str
    dimension: DataFrame
    work_dir: str
    export_dir: str
    params: Params
    skip_tests: Sequence[str]
    full_reload: bool
    expected_points: int | None
    sources: Sequence[str]
    started: dt.datetime
    day: dt.date | None = None
    raw: Mapping[str, DataFrame] = field(default_factory=dict)
    outcomes: DataFrame | None = None
    models: Mapping[str, DataFrame] = field(default_factory=dict)
    entry: dict[str, object] = field(default_factory=dict)

    def find_day(self) -> None:
        self.day = self.day or snapshots.latest_run_date(self.spark, self.raw_dir)
        if self.day is None:
            raise ValueError(f"no snapshots under {self.raw_dir}")
        self.entry["run_date"] = self.day.isoformat()

    def load(self) -> None:
        landed = f"{self.work_dir}/raw"
        land_changes(self.spark, self.raw_dir, landed, self.full_reload, self.expected_points)
        self.raw = tables.read_landed(self.spark, landed)
        counted = {"forecast_rows": "forecast_daily", "flood_rows": "flood_daily", "archive_rows": "archive_daily"}
        for name, table in counted.items():
            known = landed_rows(self.spark, landed, table)
            self.entry[name] = self.raw[table].count() if known is None else known

    def inputs(self) -> str:
        """A fingerprint of all that the later stages depend on."""
        units = landed_units(self.spark, f"{self.work_dir}/raw")
        dimension = incremental.fingerprint_rows(self.dimension)
        return fingerprint(self.day, units, dimension, self.params, list(self.skip_tests), list(self.sources), self.export_dir)

    def check_gates(self) -> dict:
        """Four outcomes reach the driver; the missing points of a failed run are kept as a table."""
        active, run = self.dimension.select("grid_id").distinct(), F.lit(self.day)
        inputs = (self.raw["forecast_daily"], self.raw["flood_daily"], active, run)
        found = self.gates_on_facts(*inputs[:3])
        if found is None:
            found = gate_plans.run_gates(*inputs, self.params)
        rows = [list(row) for row in found.collect()]
        self.restore_gates({"schema": found.schema.json(), "rows": rows})
        if not all(passed for _, _, passed, _ in rows):
            missing = gate_plans.missing_points(*inputs)
            missing.write.mode("overwrite").parquet(f"{self.work_dir}/missing_points/{self.day}")
            raise Stop("gate_failed", self.entry["gates"])
        return {"schema": found.schema.json(), "rows": rows}

    def gates_on_facts(self, forecast: DataFrame, flood: DataFrame, active: DataFrame) -> DataFrame | None:
        """The gates from what landing counted of the run, where it did."""
        facts = landed_facts(self.spark, f"{self.work_dir}/raw")
        known = [facts.get(table, {}).get(self.day.isoformat(), {}) for table in ("forecast_daily", "flood_daily")]
        if "nulls" not in known[0] or "negative" not in known[1]:
            return None
        return gate_plans.run_gates_on_facts(*known, forecast, flood, active, self.day, self.params)

    def restore_gates(self, result: dict) -> None:
        schema = T.StructType.fromJson(json.loads(result["schema"]))
        self.outcomes = self.spark.createDataFrame([tuple(row) for row in result["rows"]], schema)
        self.entry["gates"] = gate_plans.gate_report(self.outcomes).first()["report"]

    def build(self) -> dict:
        """The newest run brings the kept models up to date by the months it touches. A replay of an older run knows
        less than they hold; its models are written whole, elsewhere."""
        landed = f"{self.work_dir}/raw"
        kept = self.day.isoformat() >= max(landed_units(self.spark, landed)["forecast_daily"], default="")
        if kept:
            self.models, _ = incremental.update_from_landing(
                self.spark, landed, self.dimension, f"{self.work_dir}/models", self.params, self.day, self.full_reload
            )
        else:
            self.models = write_models(
                self.spark, self.raw, self.dimension, f"{self.work_dir}/replayed", self.params, self.day
            )
        return {"kept": kept, "schemas": {name: self.models[name].schema.json() for name in WRITTEN}}

    def restore_build(self, result: dict) -> None:
        types = {name: T.StructType.fromJson(json.loads(text)) for name, text in result["schemas"].items()}
        if result["kept"]:
            written = incremental.opened(self.spark, f"{self.work_dir}/models", types)
        else:
            written = {n: self.spark.read.schema(t).parquet(f"{self.work_dir}/replayed/{n}") for n, t in types.items()}
        self.models = build_models({**self.raw, "dim_barangay": self.dimension}, self.params, self.day, written=written)

    def test_tables(self) -> dict:
        try:
            require_sound(self.models, self.params, self.skip_tests)
        except FailedTests as failure:
            # The log's established spelling for failed table tests.
            raise Stop("dbt_failed", f"{self.entry['gates']};dbt=fail({failure})") from failure
        return {}

    def restore_tests(self, result: dict) -> None:
        """The tests left nothing but their passing."""

    def export(self) -> dict:
        def write(target: str) -> None:
            extracts.write_extracts(self.models, target)
            document = extracts.run_metadata(
                self.models["mart_dashboard"], self.outcomes, self.day, self.started, self.sources
            )
            extracts.write_metadata(document, f"{target}/metadata.json")

        publish.publish(self.spark, self.export_dir, write, label=self.day.isoformat())
        result = {"dashboard_rows": self.models["mart_dashboard"].count()}
        self.restore_export(result)
        return result

    def restore_export(self, result: dict) -> None:
        self.entry |= result


# Stages that always run, and those that are restored when the ledger has their result.
FIRST = (Job.find_day, Job.load)
LATER = (
    (Job.check_gates, Job.restore_gates), (Job.build, Job.restore_build), (Job.test_tables, Job.restore_tests),
    (Job.export, Job.restore_export),
)


def run(
    spark: SparkSession,
    raw_dir: str,
    dimension: DataFrame,
    work_dir: str,
    export_dir: str,
    log_path: str,
    run_date: dt.date | None = None,
    params: Params = Params(),
    skip_tests: Sequence[str] = (),
    full_reload: bool = False,
    expected_points: int | None = None,
    sources: Sequence[str] = extracts.ATTRIBUTION,
) -> str:
    """Run all stages and return the status written to the log.

    The first stage that fails ends the run and leaves the published version as it was; started again on the same
    inputs, the run goes on there.
    ``work_dir`` is a shared folder for landed and model tables. The run date defaults to the
    newest snapshot; any landed one can be replayed. ``skip_tests`` names table tests whose failures are
    tolerated. Only changed snapshots are read unless ``full_reload`` is set; the landed tables are the same
    either way. ``expected_points`` is the number of points a run's document must hold. Unexpected errors go to
    the log as one line and, with their traceback, to Python's logging.
    """
    job = Job(
        spark, raw_dir, dimension, work_dir, export_dir, params, skip_tests, full_reload, expected_points, sources,
        started=dt.datetime.now(dt.UTC), day=run_date,
    )
    clock, status, name = time.monotonic(), "ok", ""
    ledger = Ledger(spark, f"{work_dir}/ledger.json")
    try:
        for stage in FIRST:
            name = stage.__name__
            stage(job)
        ledger.begin(job.inputs(), afresh=full_reload)
        for stage, restore in LATER:
            name = stage.__name__
            if name in ledger.done:
                restore(job, ledger.done[name])
            else:
                ledger.finish(name, stage(job))
    except Stop as stop:
        status, job.entry["gates"] = stop.status, stop.note
    except Exception as failure:
        LOG.exception("stage %s failed", name)
        first_line = next(iter(str(failure).splitlines()), "")
        status, job.entry["gates"] = "error", f"error({type(failure).__name__}: {first_line})"
    times = {
        "started_at_utc": job.started.isoformat(timespec="seconds"), "status": status,
        "duration_s": f"{time.monotonic() - clock:.1f}",
    }
    runlog.append_run(spark, log_path, job.entry | times)
    if status == "ok":
        ledger.clear()
    return status


def write_models(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    dimension: DataFrame,
    out_dir: str,
    params: Params,
    run_date: dt.date,
) -> dict[str, DataFrame]:
    """Write the models in order of dependence, each reading its written inputs."""
    sources: dict[str, DataFrame] = {**raw, "dim_barangay": dimension}
    written: dict[str, DataFrame] = {}
    for name in WRITTEN:
        model = build_models(sources, params, run_date, names=[name], written=written)[name]
        model.write.mode("overwrite").parquet(f"{out_dir}/{name}")
        written[name] = spark.read.schema(model.schema).parquet(f"{out_dir}/{name}")
    return build_models(sources, params, run_date, written=written)


def require_sound(models: Mapping[str, DataFrame], params: Params, skip: Sequence[str] = ()) -> None:
    failed = run_table_tests(models, params).filter(~F.col("passed") & ~F.col("test").isin(*skip))
    found = failed.orderBy("model", "test", "column_name").collect()  # at most thirty rows
    if found:
        raise FailedTests(
            ", ".join(f"{f['test']}_{f['model']}_{f['column_name']} ({f['failures']})" for f in found)
        )

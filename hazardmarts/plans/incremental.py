"""Models kept up to date by the months that new versions touch.

Observed and forecast winners are stored (:mod:`hazardmarts.operators.winners`). A batch of versions is merged into
them; the winners that change give the days, and so the months, whose series, rolling sums and facts differ. Rolling sums
reach some days further, so a change at the end of a month touches the next one too. Only these months are computed and
replaced. The tables of the newest run and the dashboard cover a fixed number of days and are written whole; the
monthly normals rest on one stored row per month.

What is to be rewritten is noted before the winners change and struck out when all is done. An update that stops half-way is
repeated with the same batch: merging it again changes no winner, and the noted months are rewritten.

A later version of the dimension or of the parameters touches all months. Versions are never taken back by a merge: where landed
units were replaced or removed, the tables are built anew.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardmarts import schemas
from hazardmarts.functions import row_key
from hazardmarts.operators import coverage
from hazardmarts.operators.versions import fetch_limit, fetched_by, given_run
from hazardmarts.operators.winners import Winners
from hazardmarts.params import Params
from hazardmarts.plans import marts
from hazardmarts.plans.build import build_models
from hazardmarts.sinks import monthly
from hazardmarts.sources import files, landing, tables

PENDING = "pending.json"
MERGED = "merged_units.json"
MARK = "built_with.json"
STEPS = "steps"
UNITS = ("archive_daily", "forecast_daily")
BY_MONTH = ("int_rain_daily_unioned", "int_rain_rolling", "fct_rain_barangay_daily", "area_coverage")
# Areas that may be repeated for every month of the facts.
FEW_AREAS = 20_000
REACH = max(marts.ROLLING_DAYS.values()) - 1
Months = set[dt.date]


@dataclass(frozen=True)
class Store:
    """The kept tables and notes below one directory."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def observed(self) -> Winners:
        ties = ("precipitation_sum", "precipitation_hours")
        return Winners(self.path("observed_winners"), schemas.RAW["archive_daily"], ("grid_id", "date"), "fetched_at", ties)

    @property
    def forecast(self) -> Winners:
        ties = ("fetched_at", "precipitation_sum", "precipitation_hours", "precipitation_probability_max")
        return Winners(self.path("forecast_winners"), schemas.RAW["forecast_daily"], ("grid_id", "date"), "run_date", ties)

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Rows of a step, written and read again."""
        return self._written(df, f"{STEPS}/{label}-{uuid.uuid4().hex}")

    def whole(self, df: DataFrame, name: str) -> DataFrame:
        """A table of the newest run, replaced whole."""
        return self._written(df, name)

    def monthly(self, df: DataFrame, name: str, months: Months, date: str = "date", spread: bool = True) -> DataFrame:
        """A table of which the rows of some months are replaced by ``df``; returns all months."""
        if months:
            monthly.replace_months(df, self.path(name), months, date, spread)
        return monthly.read(self.spark, self.path(name), df.drop(monthly.MONTH).schema)

    def _written(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def note(self, name: str) -> dict:
        text = files.read_text(self.spark, self.path(name))
        return json.loads(text) if text else {}

    def write_note(self, name: str, content: Mapping) -> None:
        files.write_text(self.spark, self.path(name), json.dumps(content, default=str))


def staged_archive(store: Store, months: Months | None = None) -> DataFrame:
    """The staged archive, from the stored winners."""
    won = store.observed.read(store.spark, months)
    return won.select("grid_id", "date", "precipitation_sum", "precipitation_hours", row_key("grid_id", "date").alias("row_key"))


def reached(months: Months) -> Months:
    """The months, and those that a rolling sum of their last days reaches into."""
    return months | {monthly.following(m) for m in months}


def rolled(rain: DataFrame, months: Months) -> DataFrame:
    """Rolling sums of some months. Of the month before only the days within reach enter the window."""

    def falls(day: Column) -> Column:
        return F.trunc(day, "MM").isin(*sorted(months)) if months else F.lit(False)

    near = rain.where(falls(F.col("date")) | falls(F.date_add("date", REACH)))
    return marts.int_rain_rolling(near).where(falls(F.col("date")))


def facts_by_month(
    rolling: DataFrame, dimension: DataFrame, warnings: DataFrame, params: Params, months: Months
) -> DataFrame:
    """The facts of some months as they are stored: in order of their months, and without the key that follows from others.

    The facts, many times as many as point-days or areas, are written by the tasks that make them. Few areas are repeated for every
    month and meet the point-days month by month; where there are more, point-days are put in order of months and look up their areas,
    each of which is sent once.
    """
    areas = dimension
    if dimension.count() <= FEW_AREAS:
        listed = F.array(*[F.lit(m) for m in sorted(months)]) if months else F.array().cast("array<date>")
        areas = dimension.withColumn(monthly.MONTH, F.explode(listed))
    dated = rolling.withColumn(monthly.MONTH, monthly.month_of(F.col("date"))).where(monthly.within(months))
    return marts.fct_rain_barangay_daily(dated, areas, warnings, params, within=[monthly.MONTH]).drop("row_key")


def keyed(facts: DataFrame) -> DataFrame:
    """Stored facts with their key."""
    return facts.withColumn("row_key", row_key("pcode", "date"))


def update(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    batch: Mapping[str, DataFrame],
    dimension: DataFrame,
    root: str,
    params: Params,
    run_date: dt.date,
) -> tuple[dict[str, DataFrame], dict[str, Months]]:
    """Merge a batch and rewrite what it touches; returns all models, and the months rewritten of each monthly one.

    ``batch`` has new rows of archive_daily and forecast_daily, none fetched or run after ``run_date``, the newest run.
    ``raw`` offers all raw tables, of which only that run is read.
    """
    store, run = Store(spark, root), given_run(spark, run_date)
    valid = {name: batch[name].where("precipitation_sum is not null") for name in UNITS}
    newest = build_models({**raw, "dim_barangay": dimension}, params, run_date, names=["fct_warnings_hourly", "fct_river_grid_daily"])
    warned = marts.int_warnings_daily(newest["fct_warnings_hourly"], params)

    # What an update that stopped half-way has left, and what this one may change.
    left = {name: set(map(dt.date.fromisoformat, months)) for name, months in store.note(PENDING).items()}
    before = warned if not files.exists(spark, store.path("int_warnings_daily")) else (
        spark.read.schema(warned.schema).parquet(store.path("int_warnings_daily"))
    )
    offered = {
        "observed": monthly.months_in(valid["archive_daily"], F.col("date")),
        "forecast": monthly.months_in(valid["forecast_daily"], F.col("date")),
        "warnings": monthly.months_in(before, F.col("date")),
    }
    left = {name: left.get(name, set()) for name in offered}
    store.write_note(PENDING, {name: sorted(left[name] | offered[name]) for name in offered})

    observed = store.observed.merge(valid["archive_daily"], store.keep)
    forecast = store.forecast.merge(valid["forecast_daily"], store.keep)
    changed = observed.select("date").unionByName(forecast.select("date"))
    redone = left["observed"] | left["forecast"]
    touched = {
        "int_rain_daily_unioned": redone | monthly.months_in(changed, F.col("date")),
        "int_rain_rolling": reached(redone) | monthly.months_in(changed, F.col("date"), F.date_add("date", REACH)),
        "month_totals": left["observed"] | monthly.months_in(observed, F.col("date")),
    }

    models = {"dim_barangay": dimension, "int_latest_run": run, "stg_archive_daily": staged_archive(store)}
    models["fct_warnings_hourly"] = hourly = store.whole(newest["fct_warnings_hourly"], "fct_warnings_hourly")
    models["int_warnings_daily"] = daily = store.whole(marts.int_warnings_daily(hourly, params), "int_warnings_daily")
    models["fct_river_grid_daily"] = store.whole(newest["fct_river_grid_daily"], "fct_river_grid_daily")

    months = touched["int_rain_daily_unioned"]
    rain = marts.int_rain_daily_unioned(staged_archive(store, months), store.forecast.read(spark, months))
    models["int_rain_daily_unioned"] = store.monthly(rain, "int_rain_daily_unioned", months)

    months = touched["int_rain_rolling"]
    around = months | {monthly.preceding(m) for m in months}
    rain = monthly.read(spark, store.path("int_rain_daily_unioned"), rain.schema, around)
    models["int_rain_rolling"] = store.monthly(rolled(rain, months), "int_rain_rolling", months)

    mark = {"dimension": fingerprint_rows(dimension), "params": repr(params)}
    months = months | left["warnings"] | offered["warnings"] | monthly.months_in(daily, F.col("date"))
    if store.note(MARK) != mark:
        months = months | monthly.listed(spark, store.path("int_rain_rolling"))
    sums = monthly.read(spark, store.path("int_rain_rolling"), models["int_rain_rolling"].schema, months)
    facts = facts_by_month(sums, dimension, daily, params, months)
    models["fct_rain_barangay_daily"] = keyed(store.monthly(facts, "fct_rain_barangay_daily", months, spread=False))
    facts = facts.drop(monthly.MONTH)
    touched["fct_rain_barangay_daily"] = months

    # The areas of every day, from the months just written alone.
    written = monthly.read(spark, store.path("fct_rain_barangay_daily"), facts.schema, months)
    numbers = store.keep(coverage.numbered(dimension, "pcode"), "area-numbers")
    models["area_coverage"] = store.monthly(coverage.summed_up(written, "date", "pcode", numbers), "area_coverage", months)

    first = run_date - dt.timedelta(days=params.lookback_days)
    recent = {m for m in monthly.listed(spark, store.path("fct_rain_barangay_daily")) if m >= first.replace(day=1)}
    shown = monthly.read(spark, store.path("fct_rain_barangay_daily"), facts.schema, recent).where(F.col("date") >= F.lit(first))
    models["mart_dashboard"] = store.whole(marts.shown_facts(shown, run), "mart_dashboard")

    totals = marts.month_totals(staged_archive(store, touched["month_totals"])).withColumn("start", marts.month_start())
    totals = store.monthly(totals, "month_totals", touched["month_totals"], date="start")
    models["mart_monthly_normal"] = store.whole(marts.monthly_normals(totals.drop("start"), params), "mart_monthly_normal")

    store.write_note(MARK, mark)
    store.write_note(PENDING, {})
    files.remove(spark, store.path(STEPS))
    names = ("stg_forecast_daily", "stg_forecast_hourly", "stg_flood_daily")
    return build_models(raw, params, run_date, names=names, written=models), touched


def uncovered_dates(models: Mapping[str, DataFrame], until: Column) -> DataFrame:
    """Days of the whole fact up to a date that do not hold every area, from the kept coverage; the fact is not read."""
    areas = models["dim_barangay"].agg(F.count_distinct("pcode")).scalar()
    return coverage.incomplete_dates(models["area_coverage"], until, areas)


def fingerprint_rows(table: DataFrame) -> list[str]:
    """Number of rows and a sum of their hashes, which does not depend on their order."""
    row = table.agg(F.count("*"), F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))).first()
    return [str(value) for value in row]


def opened(spark: SparkSession, root: str, types: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """The kept models as an earlier update left them."""
    store = Store(spark, root)

    def read(name: str, schema: T.StructType) -> DataFrame:
        if name == "stg_archive_daily":
            return staged_archive(store)
        if name == "fct_rain_barangay_daily":
            stored = T.StructType([field for field in schema if field.name != "row_key"])
            return keyed(monthly.read(spark, store.path(name), stored))
        if name in BY_MONTH:
            return monthly.read(spark, store.path(name), schema)
        return spark.read.schema(schema).parquet(store.path(name))

    return {name: read(name, schema) for name, schema in types.items()}


def update_from_landing(
    spark: SparkSession, landed: str, dimension: DataFrame, root: str, params: Params, run_date: dt.date, full: bool = False
) -> tuple[dict[str, DataFrame], dict[str, Months]]:
    """Merge the landed units that are not merged yet. ``run_date`` is the newest landed run.

    Archive rows fetched after the run's day are held back for a later run. With ``full``, or where a merged unit was
    replaced or removed, all tables are built anew.
    """
    store, now = Store(spark, root), landing.landed_units(spark, landed)
    known = store.note(MERGED)
    merged = known.get("units", {})
    if full or any(now[name].get(unit) != stamp for name, units in merged.items() for unit, stamp in units.items()):
        files.remove(spark, root)
        known, merged = {}, {}
    fresh = {name: landing.read_units(spark, landed, name, set(now[name]) - set(merged.get(name, ()))) for name in UNITS}
    archive = fresh["archive_daily"]
    if known.get("held"):
        archive = archive.unionByName(spark.read.schema(archive.schema).parquet(known["held"]))
    due = fetched_by(archive, run_date, params.run_utc_offset_hours)
    held = store.path(f"held-{uuid.uuid4().hex}")
    archive.where(F.coalesce(F.col("fetched_at") >= fetch_limit(run_date, params.run_utc_offset_hours), F.lit(True))).write.parquet(held)
    batch = {"archive_daily": due, "forecast_daily": fresh["forecast_daily"]}
    models, touched = update(spark, tables.read_landed(spark, landed), batch, dimension, root, params, run_date)
    store.write_note(MERGED, {"units": {name: now[name] for name in UNITS}, "held": held})
    return models, touched

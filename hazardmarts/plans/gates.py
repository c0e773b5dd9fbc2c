"""Quality gates on the raw tables of one run; all are evaluated and all must pass."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.operators.checks import is_outside, missing_keys, null_share
from hazardmarts.operators.versions import in_run
from hazardmarts.params import Params


def run_gates(
    forecast_daily: DataFrame,
    flood_daily: DataFrame,
    active: DataFrame,
    run_date: Column,
    params: Params = Params(),
) -> DataFrame:
    """Four rows (position, gate, passed, detail), from one pass over each table of the run
    plus the anti joins of the coverage gate. Nothing but these rows reaches the driver.
    """
    forecast, flood = in_run(forecast_daily, run_date), in_run(flood_daily, run_date)
    rain = F.col("precipitation_sum")
    bad_flow = flood.agg(
        F.count_if(is_outside("river_discharge", low=0.0) | is_outside("river_discharge_max", low=0.0))
    ).scalar()
    facts = forecast.agg(
        F.max("date").alias("horizon"),
        null_share("precipitation_sum").alias("share"),
        F.count_if(F.coalesce((rain < 0) | (rain > params.max_daily_mm), F.lit(False))).alias("bad_rain"),
    ).withColumn("bad_flow", F.coalesce(bad_flow, F.lit(0)))
    return _judged(facts, run_date, params).unionByName(_coverage(forecast, flood, active))


def run_gates_on_facts(
    forecast: Mapping[str, object],
    flood: Mapping[str, object],
    forecast_daily: DataFrame,
    flood_daily: DataFrame,
    active: DataFrame,
    run_date: dt.date,
    params: Params = Params(),
) -> DataFrame | None:
    """The same four rows, three of them from facts that landing took of the run while writing it; only coverage reads the
    run's ids. None where the facts cannot tell, because rain out of range was landed and has to be counted."""
    lowest, highest = (0.0 if forecast[end] is None else forecast[end] for end in ("lowest", "highest"))
    # Not a number compares as larger than any in the gate, as smaller or larger than none here.
    if not (lowest >= 0 and highest <= params.max_daily_mm):
        return None
    spark, run = active.sparkSession, F.lit(run_date)
    horizon = None if forecast["horizon"] is None else dt.date.fromisoformat(forecast["horizon"])
    share = forecast["nulls"] / forecast["rows"] if forecast["rows"] else 1.0
    facts = spark.createDataFrame(
        [(horizon, share, 0, flood["negative"])], "horizon date, share double, bad_rain bigint, bad_flow bigint"
    )
    covered = _coverage(in_run(forecast_daily, run), in_run(flood_daily, run), active)
    return _judged(facts, run, params).unionByName(covered)


def _judged(measured: DataFrame, run_date: Column, params: Params) -> DataFrame:
    """Three gates from one row of measures."""
    facts = measured.withColumn("need", F.date_add(run_date, params.min_horizon_days))
    fresh = _gate(
        1, "freshness",
        F.coalesce(F.col("horizon") >= F.col("need"), F.lit(False)),
        F.concat(
            F.lit("max forecast date "), F.coalesce(F.col("horizon").cast("string"), F.lit("None")),
            F.lit(", need >= "), F.col("need").cast("string"),
        ),
    )
    nulls = _gate(
        3, "null_share",
        F.col("share") <= params.max_null_share,
        F.format_string(f"null share %.3f (max {params.max_null_share})", F.col("share")),
    )
    ranges = _gate(
        4, "ranges",
        (F.col("bad_rain") == 0) & (F.col("bad_flow") == 0),
        F.format_string(
            "%d rain rows out of range, %d discharge rows negative", F.col("bad_rain"), F.col("bad_flow")
        ),
    )
    return facts.select(F.inline(F.array(fresh, nulls, ranges)))


def missing_points(
    forecast_daily: DataFrame, flood_daily: DataFrame, active: DataFrame, run_date: Column
) -> DataFrame:
    """(table_name, grid_id) for every active point a table of the run lacks."""
    tables = {
        "forecast_daily": in_run(forecast_daily, run_date),
        "flood_daily": in_run(flood_daily, run_date),
    }
    return missing_keys(active, tables, "grid_id")


# The texts of the details below, which readers of the log know.
def _coverage(forecast: DataFrame, flood: DataFrame, active: DataFrame) -> DataFrame:
    """The detail names all missing ids per table, in order; there are at most as many as active points."""
    gaps = missing_keys(active, {"forecast_daily": forecast, "flood_daily": flood}, "grid_id")

    def part(table: str) -> Column:
        here = F.col("table_name") == table
        quoted = F.concat(F.lit("'"), F.col("grid_id"), F.lit("'"))
        ids = F.array_join(F.sort_array(F.collect_list(F.when(here, quoted))), ", ")
        return F.when(F.count_if(here) > 0, F.concat(F.lit(f"{table} missing ["), ids, F.lit("]")))

    present = active.agg(F.count_distinct("grid_id")).scalar()
    summary = gaps.agg(
        F.count(F.lit(1)).alias("missing"),
        F.concat_ws("; ", part("forecast_daily"), part("flood_daily")).alias("gaps"),
    )
    detail = F.when(F.col("missing") > 0, F.col("gaps")).otherwise(
        F.concat(present.cast("string"), F.lit(" grid points present"))
    )
    return summary.select(F.inline(F.array(_gate(2, "coverage", F.col("missing") == 0, detail))))


def _gate(position: int, name: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(position).alias("position"), F.lit(name).alias("gate"), passed.alias("passed"), detail.alias("detail")
    )


def gate_report(gates: DataFrame) -> DataFrame:
    """One row: whether all gates passed, and ``name=pass`` / ``name=fail(detail)`` joined by ``;``."""
    outcome = F.when(F.col("passed"), F.concat("gate", F.lit("=pass"))).otherwise(
        F.concat(F.col("gate"), F.lit("=fail("), F.col("detail"), F.lit(")"))
    )
    in_order = F.array_sort(F.collect_list(F.struct(F.col("position"), outcome.alias("text"))))
    return gates.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.array_join(F.transform(in_order, lambda g: g["text"]), ";").alias("report"),
    )

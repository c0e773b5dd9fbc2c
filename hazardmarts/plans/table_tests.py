"""The thirty data tests of the models, as one table of failure counts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.operators import checks
from hazardmarts.operators.series import date_gaps
from hazardmarts.params import Params


DASHBOARD, FACT = "mart_dashboard", "fct_rain_barangay_daily"
# Areas whose days share a task when the keys of the fact are counted: as many rows as the calendar has days, for each.
AREAS_PER_TASK = 1000


@dataclass(frozen=True)
class ModelTests:
    """Tests declared for one model."""

    unique: str | None = None
    key: tuple[str, ...] = ()  # typed columns that a text key is built of; rows are grouped by them
    not_null: tuple[str, ...] = ()
    accepted_values: tuple[tuple[str, tuple[str, ...]], ...] = ()
    accepted_range: tuple[tuple[str, float | None, float | None], ...] = ()
    relationships: tuple[tuple[str, str, str], ...] = ()  # column, parent model, parent column


def declared(params: Params = Params()) -> dict[str, ModelTests]:
    levels = tuple(params.levels)

    def keyed(*key: str) -> dict:
        return {"unique": "row_key", "key": key, "not_null": ("row_key",)}

    return {
        "dim_barangay": ModelTests(
            unique="pcode", not_null=("pcode", "grid_id"), accepted_range=(("score", 0.0, 100.0),)
        ),
        "stg_forecast_daily": ModelTests(
            **keyed("run_date", "grid_id", "date"), accepted_range=(("precipitation_sum", 0.0, params.max_daily_mm),)
        ),
        "stg_forecast_hourly": ModelTests(
            **keyed("run_date", "grid_id", "ts"), accepted_range=(("precipitation", 0.0, params.max_hourly_mm),)
        ),
        "stg_flood_daily": ModelTests(
            **keyed("run_date", "grid_id", "date"), accepted_range=(("river_discharge", 0.0, None),)
        ),
        "stg_archive_daily": ModelTests(
            unique="row_key", key=("grid_id", "date"), not_null=("row_key", "precipitation_sum")
        ),
        "fct_rain_barangay_daily": ModelTests(
            **keyed("pcode", "date"),
            relationships=(("pcode", "dim_barangay", "pcode"),),
            accepted_values=(("source", ("observed", "forecast")),),
            accepted_range=(("rain_3d_mm", 0.0, None),),
        ),
        DASHBOARD: ModelTests(
            not_null=("wet_exposure",), accepted_values=(("warning_level", levels),)
        ),
        "fct_warnings_hourly": ModelTests(accepted_values=(("warning_level", levels),)),
        "fct_river_grid_daily": ModelTests(
            accepted_range=(("river_discharge", 0.0, None),),
            accepted_values=(("source", ("past", "forecast")),),
        ),
        "mart_monthly_normal": ModelTests(not_null=("total_mm", "days_covered")),
    }


def run_table_tests(tables: Mapping[str, DataFrame], params: Params = Params()) -> DataFrame:
    """(model, test, column_name, failures, passed) for every declared test.

    All tests of a model share one pass over it, the two whole-table tests of the dashboard and relationships
    of the fact included; only other relationships need plans of their own.
    """
    results = []
    for model, tests in declared(params).items():
        df = tables[model]
        if model == DASHBOARD:
            results.append(_dashboard_pass(tables, tests, params))
        elif model == FACT:
            results.append(_one_pass(model, df, tests, _tasks(tables), tables))
            continue
        else:
            results.append(_one_pass(model, df, tests))
        results += [
            _counted(model, "relationships", c, checks.orphans(df, c, tables[parent], field))
            for c, parent, field in tests.relationships
        ]
    return reduce(DataFrame.unionByName, results).withColumn("passed", F.col("failures") == 0)


def missing_dates(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Calendar days missing between the dashboard's first and last date."""
    return date_gaps(tables[DASHBOARD], "date")


def uncovered_dates(tables: Mapping[str, DataFrame], params: Params = Params()) -> DataFrame:
    """Dashboard dates, up to one day short of the horizon, that do not hold every area.

    The last horizon day rests on a single run that may carry a few nulls, so it is not judged.
    """
    return checks.incomplete_dates(
        tables[DASHBOARD], "date", "pcode", _judged_until(tables, params), expected=tables["dim_barangay"]
    )


def _judged_until(tables: Mapping[str, DataFrame], params: Params) -> Column:
    return F.date_add(tables["int_latest_run"].scalar(), params.full_coverage_days)


def _row_tests(tests: ModelTests) -> list[tuple[str, str, Column]]:
    fails = [("not_null", c, F.col(c).isNull()) for c in tests.not_null]
    fails += [("accepted_values", c, checks.is_unexpected(c, v)) for c, v in tests.accepted_values]
    fails += [("accepted_range", c, checks.is_outside(c, lo, hi)) for c, lo, hi in tests.accepted_range]
    return fails


def _counts(fails: list[tuple[str, str, Column]]) -> list[Column]:
    return [F.count_if(failing).alias(f"_f{i}") for i, (_, _, failing) in enumerate(fails)]


def _tasks(tables: Mapping[str, DataFrame]) -> int:
    """Tasks over which the keys of area-days are dealt, by the number of areas."""
    least = int(tables["dim_barangay"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-tables["dim_barangay"].count() // AREAS_PER_TASK))


def _one_pass(
    model: str, df: DataFrame, tests: ModelTests, tasks: int | None = None, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Row-level tests as conditional counts; with a unique column they are first counted per key,
    so one aggregation on the key serves them all. A text key is unique if the columns it is built of are.

    Rows are dealt to ``tasks`` by the first column of the key before any is counted: as nearly every key has one row, counting before the
    exchange would hold all rows of a task and spare none. With ``parents``, relationships of that column are tested in the same pass:
    its values are all in one task, so counting them takes no further exchange of rows and the table is not made a second time."""
    fails = _row_tests(tests)
    outcomes = {(test, c): F.count_if(failing) for test, c, failing in fails}
    if key := tests.unique:
        group = tests.key or (key,)
        if tasks:
            flags = [failing.alias(f"_is{i}") for i, (_, _, failing) in enumerate(fails)]
            df = df.select(*group, *flags).repartition(tasks, group[0])
            fails = [(test, c, F.col(f"_is{i}")) for i, (test, c, _) in enumerate(fails)]
        df = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"), *_counts(fails))
        outcomes = {(test, c): F.sum(f"_f{i}") for i, (test, c, _) in enumerate(fails)}
        repeated = (F.col("_rows") > 1) & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in group])
        outcomes["unique", key] = F.count_if(repeated)
        if parents:
            ((child, parent, field),) = tests.relationships
            assert child == group[0]
            df = df.groupBy(child).agg(*[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(fails))], F.count_if(repeated).alias("_repeated"))
            known = parents[parent].select(F.col(field).alias(child)).distinct().withColumn("_known", F.lit(True))
            df = df.join(known, child, "left")
            outcomes["unique", key] = F.sum("_repeated")
            outcomes["relationships", child] = F.count_if(F.col(child).isNotNull() & F.col("_known").isNull())
    return _rows(model, df, outcomes)


def _dashboard_pass(tables: Mapping[str, DataFrame], tests: ModelTests, params: Params) -> DataFrame:
    """The dashboard's tests from one summary per date: its row-level failures, whether the
    calendar has gaps, and whether dates hold all areas (see :func:`uncovered_dates`)."""
    fails = _row_tests(tests)
    per_date = tables[DASHBOARD].groupBy("date").agg(F.count_distinct("pcode").alias("_areas"), *_counts(fails))
    areas = tables["dim_barangay"].agg(F.count(F.lit(1))).scalar()
    days = F.date_diff(F.max("date"), F.min("date")) + 1
    outcomes = {(test, c): F.sum(f"_f{i}") for i, (test, c, _) in enumerate(fails)}
    outcomes["date_continuity", "date"] = days - F.count("date")
    outcomes["full_coverage", "date"] = F.count_if(
        (F.col("date") <= _judged_until(tables, params)) & (F.col("_areas") != areas)
    )
    return _rows(DASHBOARD, per_date, outcomes)


def _rows(model: str, df: DataFrame, outcomes: Mapping[tuple[str, str], Column]) -> DataFrame:
    """One row per outcome of a single aggregation."""
    counted = [
        F.struct(
            F.lit(test).alias("test"), F.lit(column).alias("column_name"),
            F.coalesce(failures.cast("bigint"), F.lit(0)).alias("failures"),
        )
        for (test, column), failures in outcomes.items()
    ]
    return df.agg(F.array(*counted).alias("_outcomes")).select(F.lit(model).alias("model"), F.inline("_outcomes"))


def _counted(model: str, test: str, column: str, failing: DataFrame) -> DataFrame:
    return failing.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column_name"), "failures"
    )

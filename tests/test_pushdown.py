"""What reaches the scans of landed tables."""

import datetime as dt

import pytest

from hazardmarts.plans.build import build_models
from hazardmarts.sources import tables
from workload import twin


def _scans(df):
    """(name of the first table column, rows, files) of every file scan after running the plan."""
    df.collect()
    found = []

    def walk(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        if name.startswith("Scan parquet"):
            metrics = plan.metrics()
            location = plan.toString().split("Location: ")[1].split("]")[0].rsplit("/", 1)[-1]
            found.append((location, metrics.apply("numOutputRows").value(), metrics.apply("numFiles").value()))
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("landed"))
    sources = dict(twin.Sources(spark, "/root/testdata/sf0.01"))
    dimension = sources.pop("dim_barangay")
    # Archive windows follow each other in time, as landing writes them; none is fetched after the newest run.
    archive = sources["archive_daily"].where("fetched_at < timestamp_ntz'2024-01-30 00:00:00'")
    sources["archive_daily"] = archive.repartitionByRange(8, "date").sortWithinPartitions("date")
    tables.land(sources, out)
    return {**tables.read_landed(spark, out), "dim_barangay": dimension}


def test_dashboard_of_a_given_run_reads_its_days_only(landed):
    newest = build_models(landed, twin.PARAMS, names=["mart_dashboard"])["mart_dashboard"]
    given = build_models(landed, twin.PARAMS, dt.date(2024, 1, 30), names=["mart_dashboard"])["mart_dashboard"]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(given.collect(), key=key) == sorted(newest.collect(), key=key)
    scans = {name: (rows, files) for name, rows, files in _scans(given)}
    assert scans["archive_daily"][0] < 60000 / 4
    assert scans["forecast_hourly"][1] == 1


def test_river_reads_one_run(landed):
    river = build_models(landed, twin.PARAMS, names=["fct_river_grid_daily"])["fct_river_grid_daily"]
    assert {name: files for name, _, files in _scans(river)}["flood_daily"] == 1


def test_only_needed_columns_are_read(landed):
    monthly = build_models(landed, twin.PARAMS, names=["mart_monthly_normal"])["mart_monthly_normal"]
    plan = monthly._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(precipitation_sum)]" in plan
    assert "row_key" not in plan.split("== Physical Plan ==")[1]

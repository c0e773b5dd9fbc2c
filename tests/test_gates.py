import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.plans import gates
from hazardmarts.sources import snapshots
from tests import fixtures as fx


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return snapshots.read_raw(spark, str(fx.write_all(tmp_path_factory.mktemp("g") / "raw")))


def _run(spark, forecast, flood, active=(fx.A, fx.B)):
    points = spark.createDataFrame([(g,) for g in active], "grid_id string")
    return gates.run_gates(forecast, flood, points, F.lit(fx.RUN))


def _by_name(result):
    return {r.gate: r for r in result.collect()}


def test_gates_on_fixture(spark, raw):
    result = _run(spark, raw["forecast_daily"], raw["flood_daily"])
    by = _by_name(result)
    assert [r.gate for r in sorted(by.values())] == ["freshness", "coverage", "null_share", "ranges"]
    assert {n: r.passed for n, r in by.items()} == {
        "freshness": False, "coverage": True, "null_share": False, "ranges": True,
    }
    assert by["freshness"].detail == "max forecast date 2031-03-14, need >= 2031-03-20"
    assert by["null_share"].detail == "null share 0.250 (max 0.05)"
    assert by["coverage"].detail == "2 grid points present"
    report = gates.gate_report(result).first()
    assert not report.all_passed
    assert report.report.startswith("freshness=fail(max forecast date 2031-03-14, need >= 2031-03-20);coverage=pass;")


def test_coverage_names_missing_points(spark, raw):
    by = _by_name(_run(spark, raw["forecast_daily"], raw["flood_daily"], (fx.A, fx.B, fx.IDLE, "g0000")))
    assert by["coverage"].detail == "forecast_daily missing ['g0000', 'g0901']; flood_daily missing ['g0000', 'g0901']"
    active = spark.createDataFrame([(fx.IDLE,), (fx.A,)], "grid_id string")
    missing = gates.missing_points(raw["forecast_daily"], raw["flood_daily"], active, F.lit(fx.RUN))
    assert sorted(missing.collect()) == [("flood_daily", fx.IDLE), ("forecast_daily", fx.IDLE)]


def test_ranges(spark, raw):
    wet = raw["forecast_daily"].withColumn("precipitation_sum", F.lit(500.1))
    assert _by_name(_run(spark, wet, raw["flood_daily"]))["ranges"].detail == (
        "4 rain rows out of range, 0 discharge rows negative"
    )
    backwards = raw["flood_daily"].withColumn("river_discharge", F.lit(None).cast("double")).withColumn(
        "river_discharge_max", F.when(F.col("grid_id") == fx.A, -1.0)
    )
    assert _by_name(_run(spark, raw["forecast_daily"], backwards))["ranges"].detail == (
        "0 rain rows out of range, 2 discharge rows negative"
    )


def test_all_pass_on_good_data(spark, raw):
    daily = raw["forecast_daily"].fillna(0.0, ["precipitation_sum"])
    ahead = daily.filter("date = date '2031-03-14'").withColumn("date", F.lit(dt.date(2031, 3, 20)))
    result = _run(spark, daily.unionByName(ahead), raw["flood_daily"])
    report = gates.gate_report(result).first()
    assert report.all_passed and report.report == "freshness=pass;coverage=pass;null_share=pass;ranges=pass"


def test_empty_tables(spark):
    result = _run(spark, schemas.empty(spark, schemas.RAW["forecast_daily"]), schemas.empty(spark, schemas.RAW["flood_daily"]))
    by = _by_name(result)
    assert {n: r.passed for n, r in by.items()} == {
        "freshness": False, "coverage": False, "null_share": False, "ranges": True,
    }
    assert by["null_share"].detail == "null share 1.000 (max 0.05)"
    assert by["freshness"].detail == "max forecast date None, need >= 2031-03-20"

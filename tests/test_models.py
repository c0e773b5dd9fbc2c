import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.params import Params
from hazardmarts.plans import marts, views
from hazardmarts.plans.build import MODELS, build_models
from hazardmarts.plans import table_tests
from hazardmarts.plans.table_tests import declared, missing_dates, run_table_tests, uncovered_dates
from hazardmarts.sources import snapshots
from tests import fixtures as fx


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    raw = fx.write_all(tmp_path_factory.mktemp("m") / "raw")
    sources = {**snapshots.read_raw(spark, str(raw)), "dim_barangay": fx.dimension(spark)}
    return {name: df.cache() for name, df in build_models(sources).items() if name in MODELS or name == "dim_barangay"}


def test_columns(models):
    assert tuple(models["mart_dashboard"].columns) == schemas.DASHBOARD_COLUMNS
    assert tuple(models["fct_warnings_hourly"].columns) == schemas.WARNINGS_COLUMNS
    assert tuple(models["fct_river_grid_daily"].columns) == schemas.RIVER_COLUMNS
    assert tuple(models["mart_monthly_normal"].columns) == schemas.MONTHLY_COLUMNS
    assert models["mart_monthly_normal"].schema["year"].dataType.simpleString() == "bigint"


def test_staging(models):
    assert models["stg_archive_daily"].count() == 11
    assert models["stg_forecast_daily"].count() == 4
    keys = {r.row_key for r in models["stg_forecast_hourly"].collect()}
    assert f"{fx.RUN}|{fx.A}|2031-03-13 08:00:00" in keys and len(keys) == 8


def test_latest_valid_snapshot_wins(spark, tmp_path):
    """Of three fetches of a day the last with a value counts; a day only fetched late is added."""
    raw = fx.write_all(tmp_path / "raw")
    first, second, new = fx.ARCHIVE_DAYS[0], fx.ARCHIVE_DAYS[1], "2031-03-08"
    fx.write(raw / "archive" / "second.json", fx.archive("2031-03-14T09:00:00+00:00", [first, second], {fx.A: [7.5, 18.0]}))
    fx.write(raw / "archive" / "third.json", fx.archive("2031-03-15T09:00:00+00:00", [second, new], {fx.A: [None, 0.25]}))
    sources = snapshots.read_raw(spark, str(raw))
    staged = build_models(sources, names=["stg_archive_daily"])["stg_archive_daily"]
    rain = {str(r.date): r.precipitation_sum for r in staged.filter(F.col("grid_id") == fx.A).collect()}
    assert (rain[first], rain[second], rain[new]) == (7.5, 18.0, 0.25)
    assert len(rain) == 7


def test_replay_ignores_what_came_later(spark, tmp_path):
    raw = fx.write_all(tmp_path / "raw")
    dimension = fx.dimension(spark)

    def dashboard():
        sources = {**snapshots.read_raw(spark, str(raw)), "dim_barangay": dimension}
        rows = build_models(sources, run_date=fx.RUN, names=["mart_dashboard"])["mart_dashboard"].collect()
        return sorted(map(str, rows))

    before = dashboard()
    for i in range(1, 21):
        fx.write_run(raw, fx.RUN + dt.timedelta(days=i))
    late = fx.archive("2031-03-14T16:00:00+00:00", [fx.ARCHIVE_DAYS[0], "2031-03-13"], {fx.A: [99.5, 98.5]})
    fx.write(raw / "archive" / "late.json", late)
    assert before and dashboard() == before


def test_observed_beats_forecast(models):
    rows = models["int_rain_daily_unioned"].filter(F.col("grid_id") == fx.A).collect()
    source = {r.date.isoformat(): (r.source, r.rain_prob_max) for r in rows}
    assert source["2031-03-07"] == ("observed", None) and source["2031-03-13"] == ("forecast", 80.0)


def test_forecast_keeps_older_value_beyond_newest_run(spark, tmp_path):
    raw = tmp_path / "raw"
    days = ["2031-03-13", "2031-03-19"]
    fx.write_run(raw, dt.date(2031, 3, 13), days=days, rain={fx.A: [3.5, 6.5], fx.B: [3.5, 6.5]})
    fx.write_run(raw, fx.RUN, days=days, rain={fx.A: [5.0, None], fx.B: [5.0, 8.25]})
    sources = snapshots.read_raw(spark, str(raw))
    rows = build_models(sources, names=["int_rain_daily_unioned"])["int_rain_daily_unioned"].collect()
    rain = {(r.grid_id, r.date.day): r.rain_mm for r in rows}
    assert rain == {(fx.A, 13): 5.0, (fx.A, 19): 6.5, (fx.B, 13): 5.0, (fx.B, 19): 8.25}
    older = build_models(sources, run_date=dt.date(2031, 3, 13), names=["int_rain_daily_unioned", "int_latest_run"])
    assert older["int_latest_run"].first()[0] == dt.date(2031, 3, 13)
    assert {r.rain_mm for r in older["int_rain_daily_unioned"].collect()} == {3.5, 6.5}


def test_rolling_sums(models):
    rows = models["int_rain_rolling"].filter(F.col("grid_id") == fx.A).collect()
    sums = {r.date.isoformat(): (r.rain_3d_mm, r.rain_7d_mm) for r in rows}
    assert sums["2031-03-04"][0] == 57.75
    assert sums["2031-03-02"] == (4.5, 4.5)
    assert sums["2031-03-13"] == (9.25, 2.0 + 9.25)


def test_bands_and_daily_severity(models):
    hours = {(r.grid_id, r.ts.hour): r.warning_level for r in models["fct_warnings_hourly"].collect()}
    assert [hours[(fx.A, h)] for h in range(5, 9)] == ["none", "yellow", "orange", "red"]
    days = {r.grid_id: (r.max_hourly_mm, r.warning_level) for r in models["int_warnings_daily"].collect()}
    assert days == {fx.A: (44.0, "red"), fx.B: (0.5, "none")}


def test_fact_and_dashboard(models):
    fact = {(r.pcode, r.date.isoformat()): r for r in models["fct_rain_barangay_daily"].collect()}
    assert {p for p, _ in fact} == {"T1", "T2", "T3"}
    assert fact[("T1", "2031-03-13")].warning_level == "red"
    assert fact[("T1", "2031-03-04")].warning_level == "none" and fact[("T1", "2031-03-04")].max_hourly_mm is None
    assert fact[("T1", "2031-03-04")].wet_exposure == 23.1
    assert fact[("T2", "2031-03-04")].row_key == "T2|2031-03-04"
    shown = models["mart_dashboard"].collect()
    assert {r.run_date for r in shown} == {fx.RUN} and len(shown) == len(fact)
    same = {(r.pcode, r.date.isoformat()): (r.rain_3d_mm, r.rain_7d_mm, r.wet_exposure) for r in shown}
    assert same == {k: (r.rain_3d_mm, r.rain_7d_mm, r.wet_exposure) for k, r in fact.items()}


def test_dashboard_look_back_keeps_full_rolling_sums(spark, tmp_path):
    raw = fx.write_all(tmp_path / "raw")
    sources = {**snapshots.read_raw(spark, str(raw)), "dim_barangay": fx.dimension(spark)}
    short = build_models(sources, Params(lookback_days=9), names=["mart_dashboard"])["mart_dashboard"]
    rows = {r.date.isoformat(): r.rain_7d_mm for r in short.filter("pcode = 'T1'").collect()}
    assert min(rows) == "2031-03-05"
    assert rows["2031-03-05"] == 4.5 + 20.25 + 33.0 + 6.75


def test_river(models):
    rows = models["fct_river_grid_daily"].collect()
    assert len(rows) == 4
    assert {r.cities_served for r in rows if r.grid_id == fx.A} == {"Millbrook, Northgate"}
    assert {r.date.isoformat(): r.source for r in rows} == {"2031-03-13": "past", "2031-03-14": "forecast"}


def test_monthly_normal(spark):
    from hazardmarts.plans.marts import mart_monthly_normal

    rows = [("g1", dt.date(y, 1, d), float(y - 2018 + d % 2), 1.0, "k") for y in range(2020, 2027) for d in range(1, 32) if (y, d) != (2026, 31)]
    rows.append(("g2", dt.date(2020, 1, 1), 11.0, 1.0, "k"))
    rows.append(("g1", dt.date(2026, 2, 1), 5.0, 1.0, "k"))
    staged = spark.createDataFrame(rows, "grid_id string, date date, precipitation_sum double, precipitation_hours double, row_key string")
    got = {(r.year, r.month): r for r in mart_monthly_normal(staged).collect()}
    totals = {y: sum(y - 2018 + d % 2 for d in range(1, 32)) + (4.0 if y == 2020 else 0.0) for y in range(2020, 2026)}
    january = got[(2025, 1)]
    assert january.total_mm == totals[2025] and january.normal_mm == round(sum(totals.values()) / 6, 2)
    ordered = sorted(totals.values())
    assert january.p10_mm == round(ordered[0] + 0.5 * (ordered[1] - ordered[0]), 2)
    assert january.p90_mm == round(ordered[4] + 0.5 * (ordered[5] - ordered[4]), 2)
    assert january.is_complete and not january.is_current_year
    assert got[(2026, 1)].is_current_year and not got[(2026, 1)].is_complete and got[(2026, 1)].days_covered == 30
    assert got[(2026, 2)].normal_mm is None and got[(2026, 2)].month_start == dt.date(2026, 2, 1)


def test_thirty_table_tests(spark, models):
    report = {(r.model, r.test, r.column_name): r.failures for r in run_table_tests(models).collect()}
    assert len(report) == 30
    assert {k: n for k, n in report.items() if n} == {
        ("mart_dashboard", "date_continuity", "date"): 5,  # 8 to 12 March
        # T3 misses one observed day, T4 has no weather: no date holds all four areas
        ("mart_dashboard", "full_coverage", "date"): 8,
    }
    assert [r.date.isoformat() for r in missing_dates(models).orderBy("date").collect()] == [
        f"2031-03-{d:02d}" for d in range(8, 13)
    ]
    assert uncovered_dates(models).count() == 8
    assert sum(len(m.not_null) for m in declared().values()) == 11
    assert sum(m.unique is not None for m in declared().values()) == 6


def test_table_tests_find_failures(spark, models):
    broken = dict(models)
    forecast = models["stg_forecast_daily"]
    broken["stg_forecast_daily"] = forecast.withColumn("precipitation_sum", F.lit(999.0)).unionByName(forecast.limit(1))
    broken["stg_flood_daily"] = models["stg_flood_daily"].withColumn("row_key", F.lit(None).cast("string"))
    broken["dim_barangay"] = models["dim_barangay"].filter("pcode <> 'T1'")
    broken["fct_warnings_hourly"] = models["fct_warnings_hourly"].replace("red", "purple", ["warning_level"])
    report = {(r.model, r.test, r.column_name): r.failures for r in run_table_tests(broken).collect()}
    assert report[("stg_forecast_daily", "accepted_range", "precipitation_sum")] == 4
    assert report[("stg_forecast_daily", "unique", "row_key")] == 1
    assert report[("stg_flood_daily", "not_null", "row_key")] == 4
    assert report[("stg_flood_daily", "unique", "row_key")] == 0
    assert report[("fct_rain_barangay_daily", "relationships", "pcode")] == 1
    assert report[("fct_warnings_hourly", "accepted_values", "warning_level")] == 1


def test_views(models):
    shown = views.exposure_map(models["mart_dashboard"]).collect()
    assert {r.pcode: r.population for r in shown} == {"T1": 120.0, "T2": 240.0, "T3": 310.0}
    cities = views.city_forecast(models["mart_dashboard"], cities=["Eastside"]).collect()
    assert [(r.date.isoformat(), r.warning_level, r.rain_mm) for r in cities] == [("2031-03-14", "none", 2.75)]
    assert views.river_lines(models["fct_river_grid_daily"], [fx.A]).count() == 2
    card = views.freshness(models["mart_dashboard"]).first()
    assert card.latest_observed_date == dt.date(2031, 3, 7) and card.forecast_through == fx.RUN
    assert card.active_grid_points == 2
    assert views.observed_vs_normal(models["mart_monthly_normal"]).count() == 0


def test_keys_of_the_fact_are_dealt_before_they_are_counted(spark):
    """More areas take more tasks, and no task holds all rows it reads as keys."""
    assert table_tests._tasks({"dim_barangay": spark.range(20_500)}) == 21
    fact = spark.sql(
        "select 'a' || id % 40 as pcode, date'2031-01-01' + cast(id / 40 as int) as date, 'observed' as source, -1.0D as rain_3d_mm, "
        "if(id = 3, null, 'k' || id) as row_key from range(200) union all select 'a1', date'2031-01-01', 'odd', 1.0D, 'k'"
    )
    report = table_tests._one_pass(table_tests.FACT, fact, declared()[table_tests.FACT], 5)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(pcode") == 1 and "REPARTITION_BY_NUM" in plan
    assert {r.test: r.failures for r in report.collect()} == {"not_null": 1, "accepted_values": 1, "accepted_range": 200, "unique": 1}


def test_the_fact_is_made_once_for_all_its_tests(spark):
    """Its relationships are counted where its keys are, so no second exchange of its rows is made."""
    fact = spark.sql(
        "select nullif('a' || id % 40, 'a7') as pcode, date'2031-01-01' + cast(id / 40 as int) as date, 'observed' as source, 1.0D as rain_3d_mm, "
        "'k' || id as row_key from range(200) union all select 'a1', date'2031-01-01', 'odd', 1.0D, null"
    )
    areas = spark.sql("select nullif('a' || id, 'a9') as pcode from range(30) union all select 'a1'")
    report = table_tests._one_pass(table_tests.FACT, fact, declared()[table_tests.FACT], 5, {"dim_barangay": areas})
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.count("Range (0, 200") == 1
    want = {"not_null": 1, "accepted_values": 1, "accepted_range": 0, "unique": 1, "relationships": 11}
    assert {r.test: r.failures for r in report.collect()} == want
    empty = table_tests._one_pass(table_tests.FACT, fact.limit(0), declared()[table_tests.FACT], 5, {"dim_barangay": areas})
    assert {r.test: r.failures for r in empty.collect()} == dict.fromkeys(want, 0)


def test_day_texts_are_made_before_the_fan_out(spark):
    """Keys of area-days take the text of a point's day, which is not spelled again for every area."""
    sums = spark.sql("SELECT 'g' AS grid_id, date '2024-01-02' AS date, 'observed' AS source, 1.0D AS rain_mm, 2.0D AS rain_hours, "
                     "CAST(NULL AS DOUBLE) AS rain_prob_max, 3.0D AS rain_3d_mm, 4.0D AS rain_7d_mm")
    areas = spark.sql("SELECT pcode, 'g' AS grid_id, 'n' AS name, 'c' AS city, 5L AS population, 50.0D AS score, 0.5D AS pct_area_mh_25, "
                      "2L AS est_pop_exposed_25, 14.0D AS lat, 121.0D AS lon FROM VALUES ('A1'), ('A2'), (NULL) AS t(pcode)")
    warned = spark.sql("SELECT 'g' AS grid_id, date '2024-01-03' AS date, 9.0D AS max_hourly_mm, 'red' AS warning_level")
    facts = marts.fct_rain_barangay_daily(sums, areas, warned)
    assert "as string" not in facts._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    got = {(r.pcode, r.row_key, r.warning_level, r.wet_exposure) for r in facts.collect()}
    assert got == {("A1", "A1|2024-01-02", "none", 1.5), ("A2", "A2|2024-01-02", "none", 1.5), (None, None, "none", 1.5)}

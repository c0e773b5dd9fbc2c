"""One query per model, gate, table test, view and sink, over the derived raw tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.functions import round_half_away
from hazardmarts.operators.checks import duplicates
from hazardmarts.operators.spatial import active_points, lattice_points, with_nearest_point
from hazardmarts.plans import gates, incremental, table_tests, views
from hazardmarts.plans.build import build_models
from hazardmarts.plans.dimension import build_dimension
from hazardmarts.sinks import extracts, publish
from hazardmarts.sources import tables
from workload import twin
from workload.landed import ALL_RAW, flat, folder
from workload.registry import query
from workload.twin_sql import over


def models(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return build_models(twin.Sources(spark, sf_dir), twin.PARAMS, names=names or None)


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return models(spark, sf_dir, name)[name]


def _model(name: str, sql: str) -> None:
    query(sql, name=name)(lambda spark, sf_dir: model(spark, sf_dir, name))


_RUN_KEY = "CAST(run_date AS VARCHAR) || '|' || grid_id || '|' || CAST({} AS VARCHAR) AS row_key"

_model("stg_archive_daily", over("archive", query="SELECT * FROM archive"))
_model("stg_forecast_daily", over("raw_forecast", query=f"SELECT *, {_RUN_KEY.format('date')} FROM raw_forecast"))
_model("stg_forecast_hourly", over("raw_hourly", query=f"SELECT *, {_RUN_KEY.format('ts')} FROM raw_hourly"))
_model("stg_flood_daily", over("raw_flood", query=f"SELECT *, {_RUN_KEY.format('date')} FROM raw_flood"))
_model("int_latest_run", over("run", query="SELECT * FROM run"))
_model("int_rain_daily_unioned", over("rain", query="SELECT * FROM rain"))
_model("int_rain_rolling", over("rolling", query="SELECT * FROM rolling"))
_model("fct_warnings_hourly", over("warnings", query="SELECT * FROM warnings"))
_model("int_warnings_daily", over("warnings_daily", query="SELECT * FROM warnings_daily"))
_model("fct_rain_barangay_daily", over("fact", query="SELECT * FROM fact"))
_model("mart_dashboard", over("dashboard", query="SELECT * FROM dashboard"))
_model("fct_river_grid_daily", over("river", query="SELECT * FROM river"))
_model("mart_monthly_normal", over("monthly", query="SELECT * FROM monthly"))


@query(over("dashboard", query="SELECT * FROM dashboard")
       .replace("FROM lineitem)", "FROM lineitem WHERE CAST(l_shipdate AS DATE) + 8117 + l_linenumber < DATE '2024-01-11')")
       .replace("FROM events)", "FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-10')"))
def replayed_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard of a run twenty runs back, from tables that hold all later runs and fetches too."""
    day = dt.date(2024, 1, 10)
    sources = twin.Sources(spark, sf_dir)
    return build_models(sources, twin.PARAMS, day, names=["mart_dashboard"])["mart_dashboard"]


# --- gates and table tests --------------------------------------------------------------------

_GATES = """
, f AS (SELECT raw_forecast.* FROM raw_forecast SEMI JOIN run USING (run_date)),
w AS (SELECT raw_flood.* FROM raw_flood SEMI JOIN run USING (run_date)),
act AS (SELECT DISTINCT grid_id FROM dim),
facts AS (
  SELECT (SELECT run_date FROM run) + 6 AS need, max(date) AS horizon,
         1 - count(precipitation_sum) / CAST(count(*) AS DOUBLE) AS share,
         count(*) FILTER (WHERE precipitation_sum < 0 OR precipitation_sum > 500) AS rain_bad,
         (SELECT count(*) FROM w WHERE river_discharge < 0 OR river_discharge_max < 0) AS flow_bad,
         (SELECT count(*) FROM act WHERE grid_id NOT IN (SELECT grid_id FROM f)) AS f_gap,
         (SELECT string_agg('''' || grid_id || '''', ', ' ORDER BY grid_id) FROM act WHERE grid_id NOT IN (SELECT grid_id FROM f)) AS f_ids,
         (SELECT count(*) FROM act WHERE grid_id NOT IN (SELECT grid_id FROM w)) AS w_gap,
         (SELECT string_agg('''' || grid_id || '''', ', ' ORDER BY grid_id) FROM act WHERE grid_id NOT IN (SELECT grid_id FROM w)) AS w_ids
  FROM f),
gates AS (
  SELECT 1 AS position, 'freshness' AS gate, horizon >= need AS passed,
         'max forecast date ' || CAST(horizon AS VARCHAR) || ', need >= ' || CAST(need AS VARCHAR) AS detail FROM facts
  UNION ALL
  SELECT 2, 'coverage', f_gap + w_gap = 0,
         if(f_gap + w_gap = 0, (SELECT count(*) FROM act) || ' grid points present',
            concat_ws('; ', if(f_gap > 0, 'forecast_daily missing [' || f_ids || ']', NULL),
                      if(w_gap > 0, 'flood_daily missing [' || w_ids || ']', NULL))) FROM facts
  UNION ALL
  SELECT 3, 'null_share', share <= 0.05, printf('null share %.3f (max 0.05)', share) FROM facts
  UNION ALL
  SELECT 4, 'ranges', rain_bad + flow_bad = 0,
         rain_bad || ' rain rows out of range, ' || flow_bad || ' discharge rows negative' FROM facts)
"""


def _gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir, "dim_barangay", "int_latest_run", "forecast_daily", "flood_daily")
    active = m["dim_barangay"].select("grid_id").distinct()
    return gates.run_gates(m["forecast_daily"], m["flood_daily"], active, m["int_latest_run"].scalar(), twin.PARAMS)


def _over_gates(query_text: str) -> str:
    return over("raw_forecast", "raw_flood", "run", "dim", query=_GATES + query_text)


@query(_over_gates("SELECT * FROM gates"))
def quality_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gates(spark, sf_dir)


@query(_over_gates("""
SELECT bool_and(passed) AS all_passed,
       string_agg(gate || if(passed, '=pass', '=fail(' || detail || ')'), ';' ORDER BY position) AS report FROM gates"""))
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_report(_gates(spark, sf_dir))


@query(_over_gates("""
SELECT 'forecast_daily' AS table_name, grid_id FROM act WHERE grid_id NOT IN (SELECT grid_id FROM f)
UNION ALL SELECT 'flood_daily', grid_id FROM act WHERE grid_id NOT IN (SELECT grid_id FROM w)"""))
def coverage_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = models(spark, sf_dir, "dim_barangay", "int_latest_run", "forecast_daily", "flood_daily")
    active = m["dim_barangay"].select("grid_id").distinct()
    return gates.missing_points(m["forecast_daily"], m["flood_daily"], active, m["int_latest_run"].scalar())


def _count(model: str, test: str, column: str, relation: str, failing: str) -> str:
    return f"SELECT '{model}' AS model, '{test}' AS test, '{column}' AS column_name, (SELECT count(*) FROM {relation} WHERE {failing}) AS failures"


def _twice(model: str, column: str, relation: str, key: str) -> str:
    return f"SELECT '{model}', 'unique', '{column}', (SELECT count(*) FROM (SELECT 1 FROM {relation} GROUP BY {key} HAVING count(*) > 1))"


_TABLE_TESTS = " UNION ALL ".join([
    _count("dim_barangay", "not_null", "pcode", "dim", "pcode IS NULL"),
    _count("dim_barangay", "not_null", "grid_id", "dim", "grid_id IS NULL"),
    _count("dim_barangay", "accepted_range", "score", "dim", "score < 0 OR score > 100"),
    _twice("dim_barangay", "pcode", "dim", "pcode"),
    _count("stg_forecast_daily", "not_null", "row_key", "raw_forecast", "run_date IS NULL OR grid_id IS NULL OR date IS NULL"),
    _count("stg_forecast_daily", "accepted_range", "precipitation_sum", "raw_forecast", "precipitation_sum NOT BETWEEN 0 AND 500"),
    _twice("stg_forecast_daily", "row_key", "raw_forecast", "run_date, grid_id, date"),
    _count("stg_forecast_hourly", "not_null", "row_key", "raw_hourly", "run_date IS NULL OR grid_id IS NULL OR ts IS NULL"),
    _count("stg_forecast_hourly", "accepted_range", "precipitation", "raw_hourly", "precipitation NOT BETWEEN 0 AND 200"),
    _twice("stg_forecast_hourly", "row_key", "raw_hourly", "run_date, grid_id, ts"),
    _count("stg_flood_daily", "not_null", "row_key", "raw_flood", "run_date IS NULL OR grid_id IS NULL OR date IS NULL"),
    _count("stg_flood_daily", "accepted_range", "river_discharge", "raw_flood", "river_discharge < 0"),
    _twice("stg_flood_daily", "row_key", "raw_flood", "run_date, grid_id, date"),
    _count("stg_archive_daily", "not_null", "row_key", "archive", "row_key IS NULL"),
    _count("stg_archive_daily", "not_null", "precipitation_sum", "archive", "precipitation_sum IS NULL"),
    _twice("stg_archive_daily", "row_key", "archive", "row_key"),
    _count("fct_rain_barangay_daily", "not_null", "row_key", "fact", "row_key IS NULL"),
    _count("fct_rain_barangay_daily", "accepted_values", "source", "fact", "source NOT IN ('observed', 'forecast')"),
    _count("fct_rain_barangay_daily", "accepted_range", "rain_3d_mm", "fact", "rain_3d_mm < 0"),
    _twice("fct_rain_barangay_daily", "row_key", "fact", "row_key"),
    "SELECT 'fct_rain_barangay_daily', 'relationships', 'pcode', (SELECT count(DISTINCT pcode) FROM fact WHERE pcode NOT IN (SELECT pcode FROM dim))",
    _count("mart_dashboard", "not_null", "wet_exposure", "dashboard", "wet_exposure IS NULL"),
    _count("mart_dashboard", "accepted_values", "warning_level", "dashboard", "warning_level NOT IN ('none', 'yellow', 'orange', 'red')"),
    _count("fct_warnings_hourly", "accepted_values", "warning_level", "warnings", "warning_level NOT IN ('none', 'yellow', 'orange', 'red')"),
    _count("fct_river_grid_daily", "accepted_values", "source", "river", "source NOT IN ('past', 'forecast')"),
    _count("fct_river_grid_daily", "accepted_range", "river_discharge", "river", "river_discharge < 0"),
    _count("mart_monthly_normal", "not_null", "total_mm", "monthly", "total_mm IS NULL"),
    _count("mart_monthly_normal", "not_null", "days_covered", "monthly", "days_covered IS NULL"),
    "SELECT 'mart_dashboard', 'date_continuity', 'date', (SELECT greatest(0, ifnull(max(date) - min(date) + 1, 0) - count(DISTINCT date)) FROM dashboard)",
    """SELECT 'mart_dashboard', 'full_coverage', 'date', (SELECT count(*) FROM (
         SELECT date FROM dashboard WHERE date <= (SELECT run_date FROM run) + 5 GROUP BY date
         HAVING count(DISTINCT pcode) <> (SELECT count(*) FROM dim)))""",
])


@query(over("raw_forecast", "raw_hourly", "raw_flood", "archive", "fact", "dashboard", "warnings", "river", "monthly",
            query=f"SELECT *, failures = 0 AS passed FROM ({_TABLE_TESTS})"))
def table_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All thirty table tests in one table of failure counts."""
    return table_tests.run_table_tests(models(spark, sf_dir), twin.PARAMS)


@query(over("raw_forecast", query="""
SELECT CAST(run_date AS VARCHAR) || '|' || grid_id || '|' || CAST(date AS VARCHAR) AS row_key, count(*) AS n
FROM raw_forecast GROUP BY ALL HAVING count(*) > 1"""))
def duplicate_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates(model(spark, sf_dir, "stg_forecast_daily"), ["row_key"])


# --- views ------------------------------------------------------------------------------------


@query(over("dashboard", query="""
SELECT pcode, name, city, lat, lon, est_pop_exposed_25, avg(population) AS population,
       round(avg(wet_exposure), 6) AS wet_exposure, avg(rain_3d_mm) AS rain_3d_mm,
       ['none', 'yellow', 'orange', 'red'][max(list_position(['none', 'yellow', 'orange', 'red'], warning_level))] AS warning_level
FROM dashboard WHERE source = 'forecast' AND date - run_date IN (0, 1, 2) GROUP BY ALL"""))
def exposure_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = views.exposure_map(model(spark, sf_dir, "mart_dashboard"), twin.PARAMS.levels)
    return shown.withColumn("wet_exposure", round_half_away(F.col("wet_exposure"), 6))


@query(over("dashboard", query="""
SELECT date, warning_level, avg(rain_mm) AS rain_mm, max(max_hourly_mm) AS max_hourly_mm FROM dashboard
WHERE source = 'forecast' GROUP BY date, warning_level"""))
def city_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.city_forecast(model(spark, sf_dir, "mart_dashboard"))


@query(over("dashboard", query="""
SELECT date, warning_level, avg(rain_mm) AS rain_mm, max(max_hourly_mm) AS max_hourly_mm FROM dashboard
WHERE source = 'forecast' AND city IN ('Nation 3', 'Nation 7') GROUP BY date, warning_level"""))
def city_forecast_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = ["Nation 3", "Nation 7"]
    return views.city_forecast(model(spark, sf_dir, "mart_dashboard"), cities=chosen)


@query(over("monthly", query="""
SELECT month_start, total_mm, normal_mm, p10_mm, p90_mm FROM monthly
WHERE is_complete AND year >= (SELECT max(year) FROM monthly) - 1"""))
def observed_vs_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.observed_vs_normal(model(spark, sf_dir, "mart_monthly_normal"))


@query(over("river", query="""
SELECT date, grid_id, cities_served, avg(river_discharge) AS river_discharge FROM river GROUP BY ALL"""))
def river_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.river_lines(model(spark, sf_dir, "fct_river_grid_daily"))


@query(over("dashboard", query="""
SELECT max(run_date) AS run_date, max(if(source = 'observed', date, NULL)) AS latest_observed_date,
       max(date) AS forecast_through, count(DISTINCT grid_id) AS active_grid_points, count(*) AS dashboard_rows
FROM dashboard"""))
def freshness_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.freshness(model(spark, sf_dir, "mart_dashboard"))


# --- dimension --------------------------------------------------------------------------------


@query("""
WITH place AS (
  SELECT c_custkey, CAST(round(14.3e0 + (c_custkey * 37 % 601) / 1000e0, 6) AS DOUBLE) AS lat,
         CAST(round(120.85e0 + (c_custkey * 53 % 401) / 1000e0, 6) AS DOUBLE) AS lon FROM customer),
best AS (
  SELECT c_custkey, arg_min(format('g{:02d}{:02d}', r, c), (round(2 * 6371.0088e0 * asin(sqrt(
           pow(sin(radians(14.35e0 + r * 0.05e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(14.35e0 + r * 0.05e0))
           * pow(sin(radians(120.9e0 + c * 0.05e0 - lon) / 2), 2))), 6), r, c)) AS grid_id
  FROM place, range(10) a(r), range(6) b(c) GROUP BY c_custkey)
SELECT 'A' || c_custkey AS pcode, c_name AS name, n_name AS city, c_custkey + 1000 AS population,
       round(c_acctbal / 100e0, 4) AS score, CAST(c_custkey % 1710 AS INTEGER) AS rank_ncr,
       (c_custkey % 8) / 8e0 AS pct_area_mh_25, c_custkey % 977 AS est_pop_exposed_25,
       lat, lon, grid_id
FROM place JOIN best USING (c_custkey) JOIN customer USING (c_custkey) JOIN nation ON c_nationkey = n_nationkey""")
def dimension_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master rows and square outlines from customers, through the whole dimension build.

    Each square has a square hole around the same centre, which must not move the centroid.
    """
    key = F.col("c_custkey")
    customer = twin.table(spark, sf_dir, "customer")
    nation = twin.table(spark, sf_dir, "nation")
    master = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("A"), key.cast("string")).alias("pcode"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("City of "), F.col("n_name"), F.lit(" ")).alias("city"),
        (key + 1000).alias("population"),
        (F.col("c_acctbal") / 100).alias("score"),
        F.pmod(key, F.lit(1710)).alias("rank_ncr"),
        (F.pmod(key, F.lit(8)) / 8).alias("pct_area_mh_25"),
        F.pmod(key, F.lit(977)).alias("est_pop_exposed_25"),
    )
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    outline = F.array(
        *[
            F.struct(F.lit(ring).alias("ring"), F.lit(i).alias("seq"), F.lit(half * dx).alias("dx"), F.lit(half * dy).alias("dy"))
            for ring, half in ((0, 0.01), (1, 0.004))
            for i, (dx, dy) in enumerate(corners)
        ]
    )
    vertices = customer.select(
        F.concat(F.lit("A"), key.cast("string")).alias("pcode"),
        (F.lit(14.3) + F.pmod(key * 37, F.lit(601)) / 1000).alias("cy"),
        (F.lit(120.85) + F.pmod(key * 53, F.lit(401)) / 1000).alias("cx"),
        F.inline(outline),
    ).select("pcode", "ring", "seq", (F.col("cx") + F.col("dx")).alias("x"), (F.col("cy") + F.col("dy")).alias("y"))
    return build_dimension(master, vertices, twin.PARAMS)


@query("""
WITH place AS (
  SELECT c_custkey, CAST(14.3e0 + (c_custkey * 37 % 601) / 1000e0 AS DOUBLE) AS lat,
         CAST(120.85e0 + (c_custkey * 53 % 401) / 1000e0 AS DOUBLE) AS lon FROM customer),
best AS (
  SELECT c_custkey, arg_min(format('g{:02d}{:02d}', r, c), (round(2 * 6371.0088e0 * asin(sqrt(
           pow(sin(radians(14.35e0 + r * 0.05e0 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(14.35e0 + r * 0.05e0))
           * pow(sin(radians(120.9e0 + c * 0.05e0 - lon) / 2), 2))), 6), r, c)) AS grid_id
  FROM place, range(10) a(r), range(6) b(c) GROUP BY c_custkey)
SELECT grid_id, round(14.35e0 + CAST(grid_id[2:3] AS INTEGER) * 0.05e0, 4) AS lat,
       round(120.9e0 + CAST(grid_id[4:5] AS INTEGER) * 0.05e0, 4) AS lon
FROM (SELECT DISTINCT grid_id FROM best)""", name="active_points")
def active_points_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lattice points that customers, placed on a fine raster, are nearest to."""
    key = F.col("c_custkey")
    place = twin.table(spark, sf_dir, "customer").select(
        (F.lit(14.3) + F.pmod(key * 37, F.lit(601)) / 1000).alias("lat"),
        (F.lit(120.85) + F.pmod(key * 53, F.lit(401)) / 1000).alias("lon"),
    )
    lattice = twin.PARAMS.lattice
    return active_points(lattice_points(spark, lattice), with_nearest_point(place, lattice))


# --- kept up to date --------------------------------------------------------------------------


def _kept(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models after three updates: what was known ten days before the newest run, and five days, and then the rest."""
    sources, root, run = twin.Sources(spark, sf_dir), folder(spark, sf_dir, "kept"), dt.date(2024, 1, 30)
    known = dt.date(1900, 1, 1)
    for until in (run - dt.timedelta(days=10), run - dt.timedelta(days=5), dt.date(2100, 1, 1)):
        batch = {
            name: sources[name].where((F.to_date(time) > F.lit(known)) & (F.to_date(time) <= F.lit(until)))
            for name, time in (("archive_daily", "fetched_at"), ("forecast_daily", "run_date"))
        }
        raw = {name: sources[name] for name in schemas.RAW}
        kept, _ = incremental.update(spark, raw, batch, sources["dim_barangay"], root, twin.PARAMS, min(until, run))
        known = until
    return kept


@query(over("fact", query="SELECT * FROM fact"))
def kept_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after batches that rewrote only the months they touch."""
    return _kept(spark, sf_dir)["fct_rain_barangay_daily"]


@query(over("monthly", query="SELECT * FROM monthly"))
def kept_monthly_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The normals from one stored row per month, of which batches rewrote the touched ones."""
    return _kept(spark, sf_dir)["mart_monthly_normal"]


@query(over("archive", query="SELECT * FROM archive"))
def merged_winners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed winners merged from five batches, none of them in order of time."""
    store = incremental.Store(spark, folder(spark, sf_dir, "winners"))
    rows = twin.archive_daily(spark, sf_dir, F.pmod("l_orderkey", F.lit(5)).alias("part")).where("precipitation_sum is not null")
    for part in (3, 0, 4, 2, 1):
        store.observed.merge(rows.where(F.col("part") == part), store.keep)
    return incremental.staged_archive(store)


# --- sources and sinks ------------------------------------------------------------------------


@query(ALL_RAW)
def landed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw tables with all their columns, written by run and read back under their declared schemas."""
    out = folder(spark, sf_dir, "landed")
    tables.land(models(spark, sf_dir, *schemas.RAW), out)
    return flat(tables.read_landed(spark, out))


@query(over("dashboard", query="SELECT * FROM dashboard"))
def published_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard extract, published as CSV and read back from the current version."""
    out = folder(spark, sf_dir, "published")
    dashboard = model(spark, sf_dir, "mart_dashboard")
    _, columns, order = extracts.EXTRACTS["dashboard"]
    publish.publish(
        spark, out, lambda target: extracts.write_csv(extracts.ordered(dashboard, columns, order), f"{target}/dashboard.csv"), "q"
    )
    return extracts.read_csv(spark, f"{publish.current(spark, out)}/dashboard.csv", dashboard.schema)


@query(over("raw_forecast", "raw_flood", "run", "dim", "dashboard", query=_GATES + """
SELECT '2024-01-30' AS run_date, '2024-01-30T06:00:00+00:00' AS generated_at_utc, count(*) AS dashboard_rows,
       CAST(max(date) FILTER (WHERE source = 'observed') AS VARCHAR) AS latest_observed_date,
       CAST(max(date) AS VARCHAR) AS forecast_through, count(DISTINCT grid_id) AS active_grid_points,
       (SELECT string_agg(gate || '=' || if(passed, 'pass', 'fail'), ';' ORDER BY gate) FROM gates) AS gates,
       '""" + " | ".join(extracts.ATTRIBUTION) + "' AS sources, '" + extracts.NOTE + """' AS note
FROM dashboard"""))
def metadata_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's metadata row; the map of gates and the list of sources as text."""
    generated = dt.datetime(2024, 1, 30, 6, tzinfo=dt.UTC)
    document = extracts.run_metadata(
        model(spark, sf_dir, "mart_dashboard"), _gates(spark, sf_dir), dt.date(2024, 1, 30), generated
    )
    entries = F.transform(F.array_sort(F.map_entries("gates")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return document.withColumn("gates", F.array_join(entries, ";")).withColumn("sources", F.array_join("sources", " | "))

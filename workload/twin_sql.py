"""The derived raw tables and the models, in plain SQL.

Written as another way to the same answers: latest rows by ordered aggregates, rolling sums by
range self-joins, normals by grouping and joining.
"""

from __future__ import annotations

RAW_ARCHIVE = """raw_archive AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS grid_id,
         CAST(l_shipdate AS DATE) + 8117 AS date,
         CASE WHEN l_discount > 0 THEN l_quantity / 4e0 END AS precipitation_sum,
         CAST(l_linenumber AS DOUBLE) AS precipitation_hours,
         CAST(CAST(l_shipdate AS DATE) + 8117 + l_linenumber AS TIMESTAMP) AS fetched_at
  FROM lineitem)"""

EVENT_ROWS = """event_rows AS (
  SELECT CAST(ts AS DATE) AS run_date, CAST(user_id AS VARCHAR) AS grid_id,
         CAST(ts AS DATE) + CAST(event_id % 14 - 7 AS INTEGER) AS date,
         date_trunc('hour', ts) + to_days(CAST(event_id % 14 - 7 AS INTEGER)) AS hour,
         ts AS fetched_at, event_id, floor(value * 4e0) AS quarters
  FROM events)"""

RAW_FORECAST = """raw_forecast AS (
  SELECT run_date, grid_id, date,
         CASE WHEN event_id % 25 <> 3 THEN quarters / 16e0 END AS precipitation_sum,
         CAST(event_id % 101 AS DOUBLE) AS precipitation_probability_max,
         CAST(event_id % 25 AS DOUBLE) AS precipitation_hours, fetched_at
  FROM event_rows)"""

RAW_HOURLY = """raw_hourly AS (
  SELECT run_date, grid_id, hour AS ts,
         CASE WHEN event_id % 20 <> 7 THEN quarters / 16e0 END AS precipitation, fetched_at
  FROM event_rows)"""

RAW_FLOOD = """raw_flood AS (
  SELECT run_date, grid_id, date, quarters / 4e0 AS river_discharge,
         CASE WHEN event_id % 30 <> 0 THEN quarters / 4e0 * 1.5e0 END AS river_discharge_max, fetched_at
  FROM event_rows)"""

DIM = """dim AS (
  SELECT 'A' || CAST(c_custkey AS VARCHAR) AS pcode, c_name AS name, 'Nation ' || c_nationkey AS city,
         c_custkey % 5000 + 100 AS population,
         CASE WHEN c_acctbal >= 0 THEN floor(c_acctbal / 25e0) / 4e0 END AS score,
         CAST(c_custkey % 1710 AS INTEGER) AS rank_ncr,
         (c_custkey % 8) / 8e0 AS pct_area_mh_25,
         (c_custkey % 5000 + 100) // 2 AS est_pop_exposed_25,
         CAST(14.35 AS DOUBLE) + (c_custkey % 46) * CAST(0.01 AS DOUBLE) AS lat,
         CAST(120.9 AS DOUBLE) + (c_custkey % 26) * CAST(0.01 AS DOUBLE) AS lon,
         CAST(c_custkey // 15 AS VARCHAR) AS grid_id
  FROM customer)"""

ARCHIVE = """archive AS (
  SELECT grid_id, date, best.r AS precipitation_sum, best.h AS precipitation_hours,
         grid_id || '|' || CAST(date AS VARCHAR) AS row_key
  FROM (SELECT grid_id, date,
               max({'f': fetched_at, 'r': precipitation_sum, 'h': precipitation_hours}) AS best
        FROM raw_archive WHERE precipitation_sum IS NOT NULL GROUP BY ALL))"""

RUN = "run AS (SELECT max(run_date) AS run_date FROM raw_forecast)"

RAIN = """rain AS (
  SELECT grid_id, date, precipitation_sum AS rain_mm, precipitation_hours AS rain_hours,
         CAST(NULL AS DOUBLE) AS rain_prob_max, 'observed' AS source
  FROM archive
  UNION ALL
  SELECT grid_id, date, best.r, best.h, best.p, 'forecast'
  FROM (SELECT grid_id, date,
               max({'d': run_date, 'f': fetched_at, 'r': precipitation_sum, 'h': precipitation_hours,
                    'p': precipitation_probability_max}) AS best
        FROM raw_forecast WHERE precipitation_sum IS NOT NULL GROUP BY ALL)
  WHERE (grid_id, date) NOT IN (SELECT (grid_id, date) FROM archive))"""

ROLLING = """rolling AS (
  SELECT a.grid_id, a.date, any_value(a.source) AS source, any_value(a.rain_mm) AS rain_mm,
         any_value(a.rain_hours) AS rain_hours, any_value(a.rain_prob_max) AS rain_prob_max,
         sum(b.rain_mm) FILTER (WHERE b.date >= a.date - 2) AS rain_3d_mm, sum(b.rain_mm) AS rain_7d_mm
  FROM rain a JOIN rain b ON b.grid_id = a.grid_id AND b.date BETWEEN a.date - 6 AND a.date
  GROUP BY a.grid_id, a.date)"""

WARNINGS = """warnings AS (
  SELECT run_date, grid_id, ts, CAST(ts AS DATE) AS date, precipitation AS mm_per_hour,
         CASE WHEN precipitation < 7.5 THEN 'none' WHEN precipitation < 15 THEN 'yellow'
              WHEN precipitation < 30 THEN 'orange' ELSE 'red' END AS warning_level
  FROM raw_hourly
  WHERE run_date = (SELECT run_date FROM run) AND precipitation IS NOT NULL)"""

WARNINGS_DAILY = """warnings_daily AS (
  SELECT grid_id, date, max(mm_per_hour) AS max_hourly_mm, arg_max(warning_level, mm_per_hour) AS warning_level
  FROM warnings GROUP BY grid_id, date)"""

FACT = """fact AS (
  SELECT r.date, r.source, d.pcode, d.name, d.city, d.population, d.score, d.pct_area_mh_25,
         d.est_pop_exposed_25, r.grid_id, r.rain_mm, r.rain_prob_max, r.rain_hours, r.rain_3d_mm, r.rain_7d_mm,
         round(r.rain_3d_mm * d.score / 100e0, 3) AS wet_exposure, w.max_hourly_mm,
         ifnull(w.warning_level, 'none') AS warning_level, d.lat, d.lon,
         d.pcode || '|' || CAST(r.date AS VARCHAR) AS row_key
  FROM dim d JOIN rolling r USING (grid_id) LEFT JOIN warnings_daily w USING (grid_id, date))"""

DASHBOARD = """dashboard AS (
  SELECT fact.* EXCLUDE (row_key), run.run_date FROM fact, run WHERE fact.date >= run.run_date - 30)"""

RIVER = """river AS (
  SELECT f.run_date, f.grid_id, f.date, if(f.date < f.run_date, 'past', 'forecast') AS source,
         f.river_discharge, f.river_discharge_max, c.cities_served
  FROM raw_flood f SEMI JOIN run USING (run_date)
  JOIN (SELECT grid_id, string_agg(city, ', ' ORDER BY city) AS cities_served
        FROM (SELECT DISTINCT grid_id, city FROM dim) GROUP BY grid_id) c ON c.grid_id = f.grid_id)"""

MONTHLY = """month_totals AS (
  SELECT CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
         CAST(sum(CAST(rain_mm AS DECIMAL(30,12))) AS DOUBLE) AS total, count(*) AS days
  FROM (SELECT date, CAST(sum(CAST(precipitation_sum AS DECIMAL(30,12))) AS DOUBLE) / count(*) AS rain_mm FROM archive GROUP BY date)
  GROUP BY ALL),
base AS (
  SELECT month, avg(total) AS mid, quantile_cont(total, [0.1, 0.9]) AS q
  FROM month_totals WHERE year >= 2018 AND year <= 2022 GROUP BY month),
monthly AS (
  SELECT year, t.month, make_date(year, t.month, 1) AS month_start, round(total, 2) AS total_mm,
         round(mid, 2) AS normal_mm, round(q[1], 2) AS p10_mm, round(q[2], 2) AS p90_mm,
         year = (SELECT max(year) FROM month_totals) AS is_current_year, days AS days_covered,
         days = date_diff('day', make_date(year, t.month, 1), make_date(year, t.month, 1) + INTERVAL 1 MONTH)
           AS is_complete
  FROM month_totals t LEFT JOIN base b ON b.month = t.month)"""

# Each relation with the relations it is defined on, in order of definition.
_PARTS = {
    "raw_archive": (RAW_ARCHIVE, ()),
    "event_rows": (EVENT_ROWS, ()),
    "raw_forecast": (RAW_FORECAST, ("event_rows",)),
    "raw_hourly": (RAW_HOURLY, ("event_rows",)),
    "raw_flood": (RAW_FLOOD, ("event_rows",)),
    "dim": (DIM, ()),
    "archive": (ARCHIVE, ("raw_archive",)),
    "run": (RUN, ("raw_forecast",)),
    "rain": (RAIN, ("archive", "raw_forecast")),
    "rolling": (ROLLING, ("rain",)),
    "warnings": (WARNINGS, ("raw_hourly", "run")),
    "warnings_daily": (WARNINGS_DAILY, ("warnings",)),
    "fact": (FACT, ("dim", "rolling", "warnings_daily")),
    "dashboard": (DASHBOARD, ("fact", "run")),
    "river": (RIVER, ("raw_flood", "run", "dim")),
    "monthly": (MONTHLY, ("archive",)),
}


def over(*relations: str, query: str) -> str:
    """``query`` over the named relations and all they rest on."""
    needed: set[str] = set()

    def add(name: str) -> None:
        for below in _PARTS[name][1]:
            add(below)
        needed.add(name)

    for name in relations:
        add(name)
    return "WITH " + ",\n".join(sql for name, (sql, _) in _PARTS.items() if name in needed) + "\n" + query

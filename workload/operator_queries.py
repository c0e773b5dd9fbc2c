"""One query per reusable operator, directly on the provided tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.functions import (
    band, measure, past_or_forecast, round_half_away, row_key, utc_wall_time,
)
from hazardmarts.operators import backfill, checks, coverage, groups, intervals, joins, nearest, series, spatial, versions
from hazardmarts.params import Lattice, Params
from workload.landed import folder
from workload.registry import query
from workload.twin import table

PARAMS = Params()


# --- versions ---------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, r.shipdate AS l_shipdate, r.partkey AS l_partkey, r.suppkey AS l_suppkey,
       r.price AS l_extendedprice
FROM (SELECT l_orderkey, l_linenumber,
             max({'shipdate': l_shipdate, 'partkey': l_partkey, 'suppkey': l_suppkey, 'price': l_extendedprice}) AS r
      FROM lineitem WHERE l_discount > 0 GROUP BY ALL)""")
def latest_valid_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").filter("l_discount > 0")
    ties = ["l_partkey", "l_suppkey", "l_extendedprice"]
    return versions.latest_wins(lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ties).select(
        "l_orderkey", "l_linenumber", "l_shipdate", *ties
    )


@query("""
SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, max(o_orderkey) AS o_orderkey,
       arg_max(o_totalprice, o_orderkey) AS o_totalprice
FROM orders GROUP BY ALL""")
def latest_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    return versions.latest_wins(dated, ["o_custkey", "date"], "o_orderkey").select(
        "o_custkey", "date", "o_orderkey", "o_totalprice"
    )


@query("""
WITH dated AS (
  SELECT o_custkey, o_totalprice, CAST(o_orderdate AS DATE) AS date,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS place FROM orders),
best AS (SELECT o_custkey, date, min(place) AS place FROM dated GROUP BY ALL)
SELECT o_custkey, date, max(o_totalprice) AS amount,
       CASE place WHEN 1 THEN 'observed' WHEN 2 THEN 'partial' ELSE 'forecast' END AS source
FROM dated JOIN best USING (o_custkey, date, place) GROUP BY o_custkey, date, place""")
def prefer_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders are observations; partial ones and then all others fill the customer-days without one."""
    dated = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))

    def side(chosen: Column, source: str) -> tuple[DataFrame, list[str]]:
        return dated.filter(chosen).select(
            "o_custkey", "date", F.col("o_totalprice").alias("amount"), F.lit(source).alias("source"), "o_orderdate"
        ), ["o_orderdate"]

    status = F.col("o_orderstatus")
    sides = [
        side(status == "F", "observed"), side(status == "P", "partial"),
        side(~F.coalesce(status.isin("F", "P"), F.lit(False)), "forecast"),
    ]
    return series.prefer(sides, ["o_custkey", "date"], tie_break=["amount"])


@query("""
SELECT event_id, user_id, event_type, value FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AND value IS NOT NULL""")
def latest_run_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("run_date", F.to_date("ts"))
    newest = versions.latest_run(events)
    return versions.in_run(events, newest.scalar()).filter("value is not null").select(
        "event_id", "user_id", "event_type", "value"
    )


@query("""
SELECT event_id, CAST(ts AS DATE) AS run_date, value FROM events
QUALIFY dense_rank() OVER (ORDER BY CAST(ts AS DATE) DESC) <= 14""")
def newest_n_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("run_date", F.to_date("ts"))
    return versions.newest_runs(events, "run_date", PARAMS.newest_runs).select("event_id", "run_date", "value")


# --- series -----------------------------------------------------------------------------------


def _supplier_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(28,2)")
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    return lines.groupBy("l_suppkey", "date").agg(revenue.alias("revenue"))


@query("""
WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
  FROM lineitem GROUP BY ALL)
SELECT a.l_suppkey, a.date, CAST(any_value(a.revenue) AS DOUBLE) AS revenue,
       CAST(sum(b.revenue) FILTER (WHERE b.date >= a.date - 2) AS DOUBLE) AS revenue_3d,
       CAST(sum(b.revenue) AS DOUBLE) AS revenue_7d
FROM daily a JOIN daily b ON a.l_suppkey = b.l_suppkey AND b.date BETWEEN a.date - 6 AND a.date
GROUP BY a.l_suppkey, a.date""")
def rolling_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = series.rolling_sums(
        _supplier_revenue(spark, sf_dir), ["l_suppkey"], "date", "revenue", {"revenue_3d": 3, "revenue_7d": 7}
    )
    return rolled.select(
        "l_suppkey", "date", *[F.col(c).cast("double").alias(c) for c in ("revenue", "revenue_3d", "revenue_7d")]
    )


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY""")
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    last = versions.latest_run(orders, "date")
    return series.look_back(orders, "date", last, PARAMS.lookback_days).select("o_orderkey", "date", "o_totalprice")


@query("""
WITH present AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS date FROM lineitem)
SELECT l_suppkey, CAST(unnest(generate_series(date + 1, following - 1, INTERVAL 1 DAY)) AS DATE) AS date
FROM (SELECT *, lead(date) OVER (PARTITION BY l_suppkey ORDER BY date) AS following FROM present)
WHERE following > date + 1""")
def calendar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"))
    return series.date_gaps(lines, "date", keys=["l_suppkey"])


@query("""
WITH present AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS date FROM lineitem)
SELECT l_suppkey, date + 1 AS start, following - 1 AS "end"
FROM (SELECT *, lead(date) OVER (PARTITION BY l_suppkey ORDER BY date) AS following FROM present)
WHERE following > date + 1""")
def gap_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The holes of :func:`calendar_gaps`, a row each."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"))
    return intervals.gaps(lines, "date", ["l_suppkey"])


@query("""
SELECT l_suppkey, min(CAST(l_shipdate AS DATE)) AS first_date, max(CAST(l_shipdate AS DATE)) AS last_date
FROM lineitem GROUP BY l_suppkey""")
def date_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("date"))
    return series.date_bounds(lines, "date", keys=["l_suppkey"])


# --- bands and groups -------------------------------------------------------------------------


@query("""
SELECT event_id, value, CASE WHEN value < 7.5 THEN 'none' WHEN value < 15 THEN 'yellow'
       WHEN value < 30 THEN 'orange' ELSE 'red' END AS warning_level FROM events""")
def threshold_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = band(F.col("value"), PARAMS.bands, PARAMS.calm)
    return table(spark, sf_dir, "events").select("event_id", "value", level.alias("warning_level"))


@query("""
SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS max_value,
       CASE WHEN max(value) < 7.5 THEN 'none' WHEN max(value) < 15 THEN 'yellow'
            WHEN max(value) < 30 THEN 'orange' ELSE 'red' END AS warning_level
FROM events GROUP BY ALL""")
def severity_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", F.to_date("ts").alias("date"), "value",
        band(F.col("value"), PARAMS.bands, PARAMS.calm).alias("warning_level"),
    )
    return groups.daily_peak(
        events, ["user_id", "date"], "value", "warning_level", PARAMS.levels, peak="max_value"
    )


@query("""
WITH daily AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(floor(o_totalprice) AS DECIMAL(30,12))) AS DOUBLE) / count(*) AS amount
  FROM orders GROUP BY ALL),
monthly AS (
  SELECT CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, CAST(sum(CAST(amount AS DECIMAL(30,12))) AS DOUBLE) AS total,
         count(*) AS days_covered FROM daily GROUP BY ALL),
base AS (
  SELECT month, avg(total) AS normal, quantile_cont(total, 0.1) AS p10, quantile_cont(total, 0.9) AS p90
  FROM monthly WHERE year BETWEEN 1995 AND 2000 GROUP BY month)
SELECT m.year, m.month, round(total, 2) AS total, round(normal, 2) AS normal, round(p10, 2) AS p10,
       round(p90, 2) AS p90, days_covered
FROM monthly m LEFT JOIN base USING (month)""")
def monthly_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("date"), F.floor("o_totalprice").cast("double").alias("amount")
    )
    daily = groups.spatial_mean(orders, "date", "amount", "amount")
    monthly = groups.monthly_totals(daily, "date", "amount", "total")
    compared = groups.with_climatology(monthly, "total", (1995, 2000), {"p10": 0.1, "p90": 0.9}, mean="normal")
    return compared.select(
        "year", "month", "days_covered",
        *[round_half_away(F.col(c), 2).alias(c) for c in ("total", "normal", "p10", "p90")],
    )


@query("""
SELECT s_nationkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS brands
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY s_nationkey""")
def ordered_string_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    branded = lines.join(supplier, "l_suppkey").join(part, "l_partkey")
    return groups.distinct_text(branded, ["s_nationkey"], "p_brand", "brands")


# --- joins ------------------------------------------------------------------------------------


@query("""
WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL),
served AS (
  SELECT c_nationkey, string_agg(DISTINCT c_mktsegment, ', ' ORDER BY c_mktsegment) AS segments_served
  FROM customer GROUP BY c_nationkey)
SELECT l_suppkey, date, if(date < (SELECT max(date) FROM daily) - 7, 'past', 'forecast') AS source, quantity, segments_served
FROM daily JOIN supplier ON l_suppkey = s_suppkey JOIN served ON s_nationkey = c_nationkey""")
def served_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    segments = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "s_nationkey")
    served = groups.distinct_text(segments, ["s_nationkey"], "c_mktsegment", "segments_served")
    last = table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate"))).scalar()
    serving = supplier.join(served, "s_nationkey")
    return _supplier_days(spark, sf_dir).join(serving, "l_suppkey").select(
        "l_suppkey", "date", past_or_forecast(F.col("date"), F.date_sub(last, 7)).alias("source"),
        "quantity", "segments_served",
    )


def _supplier_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.to_date("l_shipdate"))
    return lines.groupBy("l_suppkey", "date").agg(F.sum("l_quantity").alias("quantity"))


@query("""
WITH daily AS (
  SELECT s_nationkey AS nation, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, sum(l_quantity) AS quantity
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT c_custkey, nation AS s_nationkey, month, quantity, round(quantity * floor(c_acctbal) / 100e0, 3) AS score
FROM daily JOIN customer ON c_nationkey = nation""")
def dim_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation-months fanned out to every customer of the nation, one row each.

    Lines are summed per supplier and day before the lookup, so a busy supplier is one row a day.
    """
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    daily = (
        _supplier_days(spark, sf_dir).join(supplier, "l_suppkey")
        .groupBy("s_nationkey", F.to_date(F.date_trunc("month", "date")).alias("month"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("s_nationkey"), "c_custkey", "c_acctbal"
    )
    score = round_half_away(F.col("quantity") * F.floor("c_acctbal") / F.lit(100.0), 3)
    return joins.fan_out(daily, customer, ["s_nationkey"], member="c_custkey").select(
        "c_custkey", "s_nationkey", "month", "quantity", score.alias("score")
    )


# --- expressions ------------------------------------------------------------------------------


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate,
       round(l_extendedprice * l_discount / 100e0, 3) AS scored FROM lineitem""")
def scored_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = round_half_away(F.col("l_extendedprice") * F.col("l_discount") / F.lit(100.0), 3)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", scored.alias("scored")
    )


@query("""
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || nullif(o_orderstatus, 'P')
       AS row_key FROM orders""", name="row_key")
def row_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", row_key(F.to_date("o_orderdate"), "o_custkey", status).alias("row_key")
    )


@query("""
SELECT event_id, CASE event_id % 4 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE value END AS value FROM events""")
def measure_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers as text, with words and NaN mixed in; both become null."""
    text = F.col("value").cast("string")
    noisy = (
        F.when(F.pmod("event_id", F.lit(4)) == 1, F.lit("NaN"))
        .when(F.pmod("event_id", F.lit(4)) == 2, F.concat(text, F.lit(" mm")))
        .otherwise(text)
    )
    return table(spark, sf_dir, "events").select("event_id", measure(noisy).alias("value"))


@query("SELECT event_id, ts - INTERVAL 8 HOUR AS fetched_at FROM events")
def fetch_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text with a +08:00 offset becomes naive UTC."""
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+08:00"))
    return table(spark, sf_dir, "events").select("event_id", utc_wall_time(iso).alias("fetched_at"))


# --- space ------------------------------------------------------------------------------------

# More than a hundred rows, so ids need three digits.
WIDE = Lattice(lat_min=-30.0, lat_max=30.0, lon_min=100.0, lon_max=150.0, step=0.5)


@query("""
WITH place AS (
  SELECT c_custkey, (c_custkey * 7919 % 100003) / 100003e0 * 70e0 - 35e0 AS lat,
         (c_custkey * 104729 % 99991) / 99991e0 * 60e0 + 95e0 AS lon FROM customer),
grid AS (
  SELECT r, c, r * 0.5e0 - 30e0 AS glat, c * 0.5e0 + 100e0 AS glon FROM range(121) a(r), range(101) b(c))
SELECT c_custkey, arg_min(format('g{:03d}{:03d}', r, c), (km, r, c)) AS grid_id, min(km) AS km
FROM (SELECT c_custkey, r, c, round(2 * 6371.0088e0 * asin(sqrt(pow(sin(radians(glat - lat) / 2), 2)
        + cos(radians(lat)) * cos(radians(glat)) * pow(sin(radians(glon - lon) / 2), 2))), 6) AS km
      FROM place, grid)
GROUP BY c_custkey""")
def nearest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers at scattered coordinates, in and around the lattice; the SQL compares all pairs."""
    key = F.col("c_custkey")
    place = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.pmod(key * 7919, F.lit(100003)) / 100003 * 70 - 35).alias("lat"),
        (F.pmod(key * 104729, F.lit(99991)) / 99991 * 60 + 95).alias("lon"),
    )
    located = spatial.with_nearest_point(place, WIDE)
    index = [F.substring("grid_id", start, 3).cast("double") for start in (2, 5)]
    glat, glon = index[0] * WIDE.step + WIDE.lat_min, index[1] * WIDE.step + WIDE.lon_min
    km = spatial.haversine_km(F.col("lat"), F.col("lon"), glat, glon)
    return located.select("c_custkey", "grid_id", round_half_away(km, 6).alias("km"))


@query("""
WITH place AS (
  SELECT c_custkey, (c_custkey * 7919 % 100003) / 100003e0 * 180e0 - 90e0 AS lat,
         (c_custkey * 104729 % 99991) / 99991e0 * 400e0 - 200e0 AS lon FROM customer),
listed AS (
  SELECT s_suppkey, if(s_suppkey % 3 = 0, 14.5e0 + (s_suppkey * 31 % 997) / 99700e0, (s_suppkey * 6007 % 10007) / 10007e0 * 180e0 - 90e0) AS plat,
         if(s_suppkey % 3 = 0, 121e0 + (s_suppkey // 6 * 37 % 991) / 99100e0, (s_suppkey // 2 * 7001 % 10009) / 10009e0 * 360e0 - 180e0) AS plon
  FROM supplier)
SELECT c_custkey, arg_min(s_suppkey, (km, s_suppkey)) AS s_suppkey, round(min(km), 6) AS km
FROM (SELECT c_custkey, s_suppkey, 2 * 6371.0088e0 * asin(sqrt(pow(sin(radians(plat - lat) / 2), 2)
        + cos(radians(lat)) * cos(radians(plat)) * pow(sin(radians(plon - lon) / 2), 2))) AS km
      FROM place, listed)
GROUP BY c_custkey""")
def nearest_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers all over the sphere and the nearest of irregular points, a third of them in one town; the SQL compares all pairs."""
    key, point = F.col("c_custkey"), F.col("s_suppkey")
    place = table(spark, sf_dir, "customer").select(
        "c_custkey",
        (F.pmod(key * 7919, F.lit(100003)) / 100003 * 180 - 90).alias("lat"),
        (F.pmod(key * 104729, F.lit(99991)) / 99991 * 400 - 200).alias("lon"),
    )
    town = F.pmod(point, F.lit(3)) == 0
    listed = table(spark, sf_dir, "supplier").select(
        point.alias("point_id"),
        F.when(town, F.pmod(point * 31, F.lit(997)) / 99700 + 14.5)
        .otherwise(F.pmod(point * 6007, F.lit(10007)) / 10007 * 180 - 90).alias("lat"),
        F.when(town, F.pmod(F.floor(point / 6) * 37, F.lit(991)) / 99100 + 121)
        .otherwise(F.pmod(F.floor(point / 2) * 7001, F.lit(10009)) / 10009 * 360 - 180).alias("lon"),
    )
    steps = folder(spark, sf_dir, "nearest")

    def keep(df: DataFrame, label: str) -> DataFrame:
        path = f"{steps}/{label}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    found = nearest.nearest_points(place, listed, keep, name="s_suppkey")
    return found.select("c_custkey", "s_suppkey", round_half_away(F.col("km"), 6).alias("km"))


@query("""
WITH points AS (
  SELECT vec_id, i - 1 AS seq, 121 + (1 + abs(CAST(embedding[i] AS DOUBLE))) * cos(2 * pi() * (i - 1) / 64) AS x,
         14.5e0 + (1 + abs(CAST(embedding[i] AS DOUBLE))) * sin(2 * pi() * (i - 1) / 64) AS y
  FROM embeddings, range(1, 65) t(i)),
edges AS (
  SELECT vec_id, a.x - 121 AS x0, a.y - 14.5e0 AS y0, b.x - 121 AS x1, b.y - 14.5e0 AS y1
  FROM points a JOIN points b USING (vec_id) WHERE b.seq = (a.seq + 1) % 64)
SELECT vec_id, round(14.5e0 + sum((y0 + y1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 6) AS lat,
       round(121 + sum((x0 + x1) * (x0 * y1 - x1 * y0)) / (3 * sum(x0 * y1 - x1 * y0)), 6) AS lon
FROM edges GROUP BY vec_id""")
def centroid_from_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each embedding as a star-shaped polygon: its values are the radii."""
    radius = F.abs(F.col("r").cast("double")) + 1
    angle = F.lit(2.0) * F.pi() * F.col("seq") / 64
    spokes = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("seq", "r"))
    closing = spokes.filter("seq = 0").withColumn("seq", F.lit(64))
    ring = spokes.unionByName(closing).select(
        "vec_id", F.lit(0).alias("ring"), "seq",
        (F.lit(121.0) + radius * F.cos(angle)).alias("x"), (F.lit(14.5) + radius * F.sin(angle)).alias("y"),
    )
    found = spatial.centroids(ring, "vec_id", origin=(121.0, 14.5))
    return found.select(
        "vec_id", round_half_away(F.col("lat"), 6).alias("lat"), round_half_away(F.col("lon"), 6).alias("lon")
    )


# --- backfill ---------------------------------------------------------------------------------

RUN_DAY = dt.date(2001, 8, 6)


@query("""
SELECT o_custkey, least(max(CAST(o_orderdate AS DATE)) + 1, DATE '2001-08-01' - 14) AS start, DATE '2001-08-01' AS "end"
FROM orders GROUP BY o_custkey""")
def backfill_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return backfill.refetch_windows(
        landed, "date", F.lit(RUN_DAY), PARAMS.archive_start, PARAMS.archive_lag_days,
        PARAMS.archive_refetch_days, keys=["o_custkey"],
    )


@query("""
WITH marks AS (
  SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS date FROM orders
  WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2001-08-01' - 15
  UNION ALL SELECT c_custkey, DATE '1995-12-31' FROM customer UNION ALL SELECT c_custkey, DATE '2001-08-02' FROM customer)
SELECT o_custkey, date + 1 AS start, following - 1 AS "end"
FROM (SELECT *, lead(date) OVER (PARTITION BY o_custkey ORDER BY date) AS following FROM marks)
WHERE following > date + 1""")
def fetch_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that fill every hole of each customer's days, also of customers without any."""
    ordered = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    everyone = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return backfill.fetch_holes(
        intervals.islands(ordered, "date", ["o_custkey"]), F.lit(RUN_DAY), dt.date(1996, 1, 1),
        PARAMS.archive_lag_days, PARAMS.archive_refetch_days, ["o_custkey"], everyone,
    )


@query("""
WITH span AS (
  SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS first, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY ALL)
SELECT o_custkey, min(day) AS start, max(day) AS "end"
FROM (SELECT o_custkey, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
GROUP BY o_custkey, year(day)""")
def year_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end")
    )
    return backfill.split_years(spans)


# --- checks -----------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT event_id, user_id, nullif(event_type, 'view') AS event_type FROM events WHERE event_type = 'view'")
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanked = F.nullif(F.col("event_type"), F.lit("view")).alias("event_type")
    return checks.nulls(table(spark, sf_dir, "events").select("event_id", "user_id", blanked), "event_type")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'P')")
def accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return checks.unexpected_values(orders, "o_orderstatus", ["F", "P"])


@query("SELECT event_id, value FROM events WHERE NOT (value BETWEEN 1 AND 100)")
def accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.out_of_range(table(spark, sf_dir, "events").select("event_id", "value"), "value", 1.0, 100.0)


@query("SELECT doc_id, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id")
def relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.orphans(table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id")


@query("""
WITH lines AS (SELECT l_suppkey, l_linestatus, strftime(l_shipdate, '%Y-%m') AS month FROM lineitem),
expected AS (SELECT s_suppkey || '|' || month AS key FROM supplier, (SELECT DISTINCT month FROM lines)),
sold AS (SELECT DISTINCT l_linestatus, l_suppkey || '|' || month AS key FROM lines)
SELECT 'open' AS table_name, key FROM expected WHERE key NOT IN (SELECT key FROM sold WHERE l_linestatus = 'O')
UNION ALL
SELECT 'done', key FROM expected WHERE key NOT IN (SELECT key FROM sold WHERE l_linestatus = 'F')""")
def expected_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Combinations of supplier and month without any line, per line status, over all lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM").alias("month"))
    months = lines.agg(F.collect_set("month")).scalar()  # the months of a calendar
    key = lambda supplier: F.concat(F.col(supplier).cast("string"), F.lit("|"), F.col("month")).alias("key")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.explode(months).alias("month"))
    sold = lines.select("l_linestatus", key("l_suppkey"))
    per_status = {n: sold.filter(F.col("l_linestatus") == s) for n, s in (("open", "O"), ("done", "F"))}
    return checks.missing_keys(supplier.select(key("s_suppkey")), per_status, "key")


@query("""
SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS n FROM events
WHERE CAST(ts AS DATE) <= (SELECT max(CAST(ts AS DATE)) FROM events) - 5 GROUP BY ALL
HAVING count(DISTINCT user_id) <> (SELECT count(*) FROM supplier)""")
def coverage_having(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    until = events.agg(F.date_sub(F.max("date"), 5)).scalar()
    return checks.incomplete_dates(events, "date", "user_id", until, expected=table(spark, sf_dir, "supplier"))


@query("""
SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS n FROM events
WHERE CAST(ts AS DATE) <= (SELECT max(CAST(ts AS DATE)) FROM events) - 5 GROUP BY ALL
HAVING count(DISTINCT user_id) <> (SELECT count(*) FROM supplier)""")
def coverage_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage from stored summaries of seven overlapping parts of the events."""
    events = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    numbers, path = coverage.numbered(events, "user_id", shards=3), f"{folder(spark, sf_dir, 'coverage')}/bits"
    part = F.pmod("event_id", F.lit(7))
    for i in range(7):
        rows = events.where((part == i) | (part == (i + 2) % 7))
        coverage.summed_up(rows, "date", "user_id", numbers).write.mode("append").parquet(path)
    until = events.agg(F.date_sub(F.max("date"), 5)).scalar()
    wanted = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    return coverage.incomplete_dates(spark.read.parquet(path), until, wanted)


@query("""
SELECT event_type, count(*) FILTER (WHERE value < 50) / CAST(count(*) AS DOUBLE) AS share FROM events GROUP BY event_type""",
       name="null_share")
def null_share_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = table(spark, sf_dir, "events").select(
        "event_type", F.when(F.col("value") >= 50, F.col("value")).alias("value")
    )
    return seen.groupBy("event_type").agg(checks.null_share("value").alias("share"))


@query("""
SELECT event_type, count(*) FILTER (WHERE value < 1 OR value > 200) AS outside FROM events GROUP BY event_type""")
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = F.count_if(checks.is_outside("value", 1.0, 200.0))
    return table(spark, sf_dir, "events").groupBy("event_type").agg(outside.alias("outside"))


@query("""
SELECT event_type, max(CAST(ts AS DATE)) AS horizon, max(CAST(ts AS DATE)) >= DATE '2024-01-30' AS fresh
FROM events GROUP BY event_type""")
def freshness_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    horizon = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max(F.to_date("ts")).alias("horizon"))
    return horizon.withColumn("fresh", F.col("horizon") >= F.lit(dt.date(2024, 1, 30)))


@query("""
SELECT max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_orderstatus = 'F') AS latest_observed_date,
       max(CAST(o_orderdate AS DATE)) AS forecast_through, count(DISTINCT o_custkey) AS customers, count(*) AS n
FROM orders""")
def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    observed = F.when(F.col("o_orderstatus") == "F", F.col("date"))
    return orders.agg(
        F.max(observed).alias("latest_observed_date"), F.max("date").alias("forecast_through"),
        F.count_distinct("o_custkey").alias("customers"), F.count(F.lit(1)).alias("n"),
    )

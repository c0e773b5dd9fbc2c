import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardmarts.operators import backfill, checks, groups, joins, series, versions
from hazardmarts.params import Lattice, Params

DAY0 = dt.date(2020, 1, 1)
quick = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _day(n):
    return DAY0 + dt.timedelta(days=n)


@quick
@given(st.data())
def test_rolling_sums_against_brute_force(spark, data):
    cells = data.draw(st.dictionaries(
        st.tuples(st.sampled_from("ab"), st.integers(0, 60)),
        st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60,
    ))
    block = data.draw(st.integers(1, 30))
    rows = [(k, _day(n), None if v is None else float(v)) for (k, n), v in cells.items()]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = series.rolling_sums(df, ["k"], "date", "v", {"s3": 3, "s7": 7}, block_days=block).collect()
    assert len(got) == len(rows)
    for r in got:
        n = (r.date - DAY0).days
        for name, days in (("s3", 3), ("s7", 7)):
            seen = [cells.get((r.k, m)) for m in range(n - days + 1, n + 1)]
            seen = [v for v in seen if v is not None]
            assert r[name] == (float(sum(seen)) if seen else None)


def test_rolling_sums_keep_every_row(spark):
    rows = [("a", _day(0), 1.0), ("a", _day(0), 2.0), ("a", None, 4.0), (None, _day(1), 8.0)]
    df = spark.createDataFrame(rows, "k string, date date, v double")
    got = series.rolling_sums(df, ["k"], "date", "v", {"s": 3}, block_days=1)
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(
        [("a", _day(0), 1.0, 3.0), ("a", _day(0), 2.0, 3.0), ("a", None, 4.0, 4.0), (None, _day(1), 8.0, 8.0)], key=key
    )


@quick
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 5)), max_size=40))
def test_latest_wins_is_the_maximum_and_idempotent(spark, rows):
    df = spark.createDataFrame([(k, o, v) for k, o, v in rows], "k string, o int, v int")
    once = versions.latest_wins(df, ["k"], "o", ["v"])
    expected = {}
    for k, o, v in rows:
        expected[k] = max(expected.get(k, (-1, -1)), (o, v))
    assert {r.k: (r.o, r.v) for r in once.collect()} == expected
    assert sorted(versions.latest_wins(once, ["k"], "o", ["v"]).collect()) == sorted(once.collect())


@quick
@given(st.lists(st.tuples(st.sampled_from(["p", "q"]), st.sampled_from("abcd"), st.integers(0, 4), st.integers(0, 9)), max_size=40))
def test_prefer_equals_anti_join(spark, rows):
    def side(name):
        own = [(k, _day(o), float(v), name) for s, k, o, v in rows if s == name]
        return spark.createDataFrame(own, "k string, o date, v double, source string")

    got = {r.k: (r.source, r.v) for r in series.prefer([(side("p"), ["o"]), (side("q"), ["o"])], ["k"], ["v"]).collect()}
    newest = {s: versions.latest_wins(side(s), ["k"], "o", ["v"]) for s in "pq"}
    rest = newest["q"].join(newest["p"], "k", "left_anti")
    assert got == {r.k: (r.source, r.v) for r in newest["p"].unionByName(rest).collect()}


def test_hot_key_sends_one_row_per_partition(spark):
    hot = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("o"),
    )
    latest = versions.latest_wins(hot, ["k"], "o")
    assert latest.filter("k = 'hot'").first().o == 29997
    assert "row_number(), 1, Partial" in latest._jdf.queryExecution().toString()


def test_newest_runs(spark):
    df = spark.createDataFrame([(_day(n % 5), n) for n in range(20)], "run date, n int")
    assert {r.run for r in versions.newest_runs(df, "run", 2).collect()} == {_day(3), _day(4)}
    assert versions.newest_runs(df, "run", 99).count() == 20
    assert versions.latest_run(df.limit(0), "run").first()[0] is None
    assert versions.latest_run(df, "run", as_of=_day(2)).first()[0] == _day(2)


def test_date_gaps(spark):
    rows = [("a", _day(0)), ("a", _day(3)), ("b", _day(5)), ("b", _day(5)), ("b", None)]
    df = spark.createDataFrame(rows, "k string, d date")
    assert sorted(series.date_gaps(df, "d", ["k"]).collect()) == [("a", _day(1)), ("a", _day(2))]
    assert [r.date for r in series.date_gaps(df, "d").orderBy("date").collect()] == [_day(1), _day(2), _day(4)]
    assert series.date_gaps(df.limit(0), "d").count() == 0


def _hot_tables(spark):
    random.seed(3)
    heavy = [("hot" if n % 3 == 0 else f"k{n % 40}", n) for n in range(1500)] + [(None, -1), ("only heavy", -2)]
    light = [("hot", m) for m in range(7)] + [(f"k{n}", n) for n in range(30)] + [("only light", 0), (None, 1)]
    return spark.createDataFrame(heavy, "k string, n int"), spark.createDataFrame(light, "k string, m int")


@pytest.fixture(params=["-1", "10MB"])
def broadcast_limit(spark, request):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("parts", [2, 20, 1000])
def test_fan_out_equals_plain_join(spark, tmp_path, broadcast_limit, parts):
    members, facts = _hot_tables(spark)
    expected = sorted(facts.join(members, "k").select("k", "n", "m").collect())
    assert sorted(joins.fan_out(facts, members, ["k"], "n", parts).select("k", "n", "m").collect()) == expected
    members.write.parquet(str(tmp_path / "members"))
    small = spark.read.parquet(str(tmp_path / "members"))
    assert joins.fits_broadcast(small) == (broadcast_limit != "-1")
    joined = joins.fan_out(facts, small, ["k"], "n", parts)
    assert ("_salt" in joined._jdf.queryExecution().toString()) == (broadcast_limit == "-1")
    assert sorted(joined.select("k", "n", "m").collect()) == expected


def test_hot_key_is_spread_over_salts(spark):
    members, facts = _hot_tables(spark)
    settings_ = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings_}
    for key, value in settings_.items():
        spark.conf.set(key, value)
    try:
        joined = joins.fan_out(facts, members, ["k"], "n", parts=20).withColumn("task", F.spark_partition_id())
        per_task = {r.task: r["count"] for r in joined.filter("k = 'hot'").groupBy("task").count().collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(per_task.values()) == 500 * 7
    assert len(per_task) >= 4 and max(per_task.values()) < 500 * 7 / 2


def test_groups(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "yellow", "Z"), ("a", 9.0, "red", "Y"), ("a", 5.0, "none", "Z"), ("b", None, "odd", None)],
        "k string, v double, level string, city string",
    )
    levels = Params().levels
    assert levels == ("none", "yellow", "orange", "red")
    assert sorted(groups.daily_peak(df, ["k"], "v", "level", levels, "top").collect()) == [("a", 9.0, "red"), ("b", None, "none")]
    assert {r.k: r.all for r in groups.distinct_text(df, ["k"], "city", "all").collect()} == {"a": "Y, Z", "b": None}


def test_backfill_windows(spark):
    p = Params()
    landed = spark.createDataFrame([("a", dt.date(2021, 6, 30)), ("b", dt.date(2021, 1, 1)), ("c", None)], "k string, d date")

    def plan(run, keys=("k",), df=landed):
        windows = backfill.refetch_windows(df, "d", F.lit(run), p.archive_start, p.archive_lag_days, p.archive_refetch_days, list(keys))
        return sorted(tuple(r) for r in windows.collect())

    assert plan(dt.date(2021, 7, 3)) == [
        ("a", dt.date(2021, 6, 14), dt.date(2021, 6, 28)),
        ("b", dt.date(2021, 1, 2), dt.date(2021, 6, 28)),
        ("c", dt.date(2020, 1, 1), dt.date(2021, 6, 28)),
    ]
    assert plan(dt.date(2021, 7, 10), keys=()) == [(dt.date(2021, 6, 21), dt.date(2021, 7, 5))]
    assert plan(dt.date(2019, 12, 1), keys=(), df=landed.limit(0)) == []


def test_year_split(spark):
    df = spark.createDataFrame([(dt.date(2024, 11, 1), dt.date(2026, 2, 3)), (dt.date(2024, 2, 2), dt.date(2024, 2, 1))], "start date, end date")
    assert sorted(tuple(r) for r in backfill.split_years(df).collect()) == [
        (dt.date(2024, 11, 1), dt.date(2024, 12, 31)),
        (dt.date(2025, 1, 1), dt.date(2025, 12, 31)),
        (dt.date(2026, 1, 1), dt.date(2026, 2, 3)),
    ]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, -1.0), (None, 9.0), ("b", 5.0)], "k string, v double")
    assert [tuple(r) for r in checks.duplicates(df, ["k"]).collect()] == [("a", 2)]
    assert checks.nulls(df, "k").count() == 2
    assert [r.k for r in checks.unexpected_values(df, "k", ["a"]).collect()] == ["b"]
    assert checks.out_of_range(df, "v", low=0.0).count() == 1
    assert checks.out_of_range(df, "v", low=0.0, high=5.0).count() == 2
    assert checks.out_of_range(df, "v", high=5.0).count() == 1
    with pytest.raises(ValueError):
        checks.out_of_range(df, "v")
    parent = spark.createDataFrame([("a",), (None,)], "id string")
    assert [tuple(r) for r in checks.orphans(df, "k", parent, "id").collect()] == [("b", 1)]
    missing = checks.missing_keys(df, {"x": df.limit(0), "y": df.filter("k = 'a'")}, "k")
    assert sorted(tuple(r) for r in missing.collect()) == [("x", "a"), ("x", "b"), ("y", "b")]


def test_params_are_checked():
    p = Params()
    assert p.past_days > p.archive_lag_days and p.archive_refetch_days >= p.archive_lag_days
    for bad in (
        {"bands": ((1.0, "a"), (2.0, "b"))}, {"normal_years": (2025, 2020)}, {"past_days": 5},
        {"archive_refetch_days": 1},
    ):
        with pytest.raises(ValueError):
            Params(**bad)
    with pytest.raises(ValueError):
        Lattice(lat_min=2.0, lat_max=1.0)

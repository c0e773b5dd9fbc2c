"""Intervals of days against sets of days."""

import datetime as dt
import random

from pyspark.sql import functions as F

from hazardmarts.operators import backfill, intervals
from hazardmarts.plans.archive_plan import archive_hole_plan
from hazardmarts.operators.series import date_gaps
from hazardmarts.params import Params

DAY = dt.date(2030, 2, 20)
ROWS = "k string, start date, end date"


def _day(n):
    return DAY + dt.timedelta(days=n)


def _as_days(rows):
    """Days by key; fails where two intervals overlap or adjoin."""
    held = {}
    for k, start, end in sorted(rows, key=str):
        days = {start + dt.timedelta(days=i) for i in range(-1, (end - start).days + 2)}
        assert start <= end and not days & held.get(k, set()), (k, start, end)
        held.setdefault(k, set()).update(sorted(days)[1:-1])
    return held


def _made(seed, n=60):
    rng = random.Random(seed)
    starts = [(rng.choice(["a", "b", None]), rng.randrange(150)) for _ in range(n)]
    return [(k, _day(s), _day(s + rng.randrange(-2, 5))) for k, s in starts]


def _covered(rows):
    held = {}
    for k, start, end in rows:
        held.setdefault(k, set()).update(start + dt.timedelta(days=i) for i in range((end - start).days + 1))
    return {k: days for k, days in held.items() if days}


def test_merged_and_subtracted(spark):
    wanted, held = _made(1), _made(2, 40)
    one, other = (spark.createDataFrame(rows, ROWS) for rows in (wanted + wanted[:9], held))
    assert _as_days(map(tuple, intervals.merged(one, ["k"]).collect())) == _covered(wanted)
    left = {k: days - _covered(held).get(k, set()) for k, days in _covered(wanted).items()}
    got = intervals.subtracted(one, other, ["k"])
    assert _as_days(map(tuple, got.collect())) == {k: days for k, days in left.items() if days}
    assert sorted(map(tuple, intervals.days(got).select("k", "date").collect()), key=str) == sorted(
        ((k, d) for k, days in left.items() for d in days), key=str
    )
    assert intervals.subtracted(one, one, ["k"]).count() == 0
    assert intervals.merged(one.limit(0), ["k"]).count() == 0
    assert len(intervals.merged(one.drop("k")).collect()) == len(intervals.islands(intervals.days(one.drop("k")), "date").collect())


def test_islands_and_gaps(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *map(_day, range(80))])) for _ in range(90)]
    df = spark.createDataFrame(rows + rows[:20], "k string, date date")
    present = {k: {d for key, d in rows if key == k and d} for k in ("a", "b", None)}
    assert _as_days(map(tuple, intervals.islands(df, "date", ["k"]).collect())) == present
    # Spark's equality joins leave null keys apart, so the gaps of a null key are judged by themselves.
    holes = _as_days(map(tuple, intervals.gaps(df, "date", ["k"]).collect()))
    for k, days in present.items():
        assert holes.get(k, set()) == {min(days) + dt.timedelta(days=i) for i in range((max(days) - min(days)).days)} - days
    named = df.where("k is not null")
    expanded = intervals.days(intervals.gaps(named, "date", ["k"]))
    assert sorted(expanded.collect()) == sorted(date_gaps(named, "date", ["k"]).collect())


def test_long_gaps_are_not_expanded(spark):
    df = spark.createDataFrame([("a", dt.date(1, 1, 1)), ("a", dt.date(9999, 12, 31))], "k string, date date")
    found = intervals.gaps(df, "date", ["k"])
    assert [tuple(r) for r in found.collect()] == [("a", dt.date(1, 1, 2), dt.date(9999, 12, 30))]
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_fetch_holes(spark):
    landed = spark.createDataFrame([("a", _day(0), _day(9)), ("a", _day(20), _day(40)), ("z", _day(50), _day(60))], ROWS)
    expected = spark.createDataFrame([("a",), ("new",)], "k string")
    got = backfill.fetch_holes(landed, F.lit(_day(45)), _day(-3), 5, 14, ["k"], expected)
    assert sorted(map(tuple, got.collect())) == [
        ("a", _day(-3), _day(-1)), ("a", _day(10), _day(19)), ("a", _day(26), _day(40)),
        ("new", _day(-3), _day(40)), ("z", _day(-3), _day(40)),
    ]
    assert [tuple(r) for r in backfill.fetch_holes(landed.drop("k").limit(0), F.lit(_day(45)), _day(30), 5, 14).collect()] == [(_day(30), _day(40))]


def test_archive_hole_plan(spark, tmp_path):
    """A missing window in the middle is asked for again, cut at the end of the year."""
    (tmp_path / "archive").mkdir()
    for name in ("2030-01-01_2030-12-20", "2031-01-10_2031-03-31", "notes_x"):
        (tmp_path / "archive" / f"{name}.json").write_text("{}")
    plan = archive_hole_plan(spark, str(tmp_path), dt.date(2031, 3, 20), Params(archive_start=dt.date(2030, 1, 1)))
    assert sorted(map(tuple, plan.collect())) == [
        (dt.date(2030, 12, 21), dt.date(2030, 12, 31)), (dt.date(2031, 1, 1), dt.date(2031, 1, 9)),
        (dt.date(2031, 3, 1), dt.date(2031, 3, 15)),
    ]

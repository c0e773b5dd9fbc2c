"""Winners kept by merging, and models rewritten by touched months."""

import datetime as dt
import random
import re
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.operators import checks, coverage
from hazardmarts.operators.winners import Winners
from hazardmarts.params import Params
from hazardmarts.plans import incremental
from hazardmarts.plans.build import MODELS, build_models
from hazardmarts.sinks import monthly

ARCHIVE = schemas.RAW["archive_daily"]
DAY = dt.date(2031, 1, 1)


def _versions(seed, n, days=200, points=5):
    rng = random.Random(seed)
    return [
        (f"p{rng.randrange(points)}", DAY + dt.timedelta(days=rng.randrange(days)), float(rng.randrange(9)), rng.choice([None, 2.0, 3.0]),
         dt.datetime(2031, 8, 1, rng.randrange(20)))
        for _ in range(n)
    ]


def _winners(path):
    return Winners(str(path), ARCHIVE, ("grid_id", "date"), "fetched_at", ("precipitation_sum", "precipitation_hours"))


def _kept(spark, tmp_path):
    return incremental.Store(spark, str(tmp_path / "kept")).keep


def test_ten_batches_in_any_order_equal_one_ranking(spark, tmp_path):
    rows = _versions(1, 400, days=60)
    batches = [rows[i::9] for i in range(9)] + [rows[:40]]
    random.Random(1).shuffle(batches)
    winners, seen, current = _winners(tmp_path / "w"), [], {}
    for batch in batches:
        changed = winners.merge(spark.createDataFrame(batch, ARCHIVE), _kept(spark, tmp_path)).collect()
        seen += batch
        want = {r[:2]: tuple(r) for r in winners.rank(spark.createDataFrame(seen, ARCHIVE)).collect()}
        assert {tuple(r) for r in changed} == set(want.values()) - set(current.values())
        current = want
    assert sorted(map(tuple, winners.read(spark).collect()), key=str) == sorted(current.values(), key=str)
    assert {r[:2] for r in rows} == set(current)


def test_stored_rows_are_not_shuffled_and_other_months_not_read(spark, tmp_path):
    winners = _winners(tmp_path / "w")
    winners.merge(spark.createDataFrame(_versions(3, 3000, days=90), ARCHIVE), _kept(spark, tmp_path))
    batch = spark.createDataFrame([("p1", DAY, 1.0, 1.0, dt.datetime(2031, 9, 1))], ARCHIVE)
    prior = winners.prior(_kept(spark, tmp_path)(batch, "batch"), {DAY})
    assert len(prior.collect()) == 1
    plan = prior._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "PartitionFilters: [isnotnull(part_month" in plan and "Exchange hashpartitioning" not in plan


def test_months_without_a_changed_winner_keep_their_files(spark, tmp_path):
    winners = _winners(tmp_path / "w")
    rows = _versions(4, 500, days=90)
    winners.merge(spark.createDataFrame(rows, ARCHIVE), _kept(spark, tmp_path))
    before = _files(tmp_path / "w")
    stale = [(p, d, 0.0, None, dt.datetime(2030, 1, 1)) for p, d, *_ in rows]
    assert winners.merge(spark.createDataFrame(stale + rows, ARCHIVE), _kept(spark, tmp_path)).count() == 0
    assert _files(tmp_path / "w") == before
    newer = [(None, DAY, 1.0, None, dt.datetime(2032, 1, 1)), ("p9", dt.date(2031, 3, 5), 1.0, None, dt.datetime(2032, 1, 1))]
    assert winners.merge(spark.createDataFrame(newer, ARCHIVE), _kept(spark, tmp_path)).count() == 1
    assert {m for m, f in _files(tmp_path / "w").items() if f != before.get(m)} == {"part_month=2031-03-01"}


def _files(table):
    return {m.name: {f.name: f.stat().st_mtime_ns for f in m.glob("*.parquet")} for m in Path(table).glob("part_month=*")}


def test_replaced_months(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.sql("select date'2031-01-15' + cast(id * 10 as int) as date, id from range(12)")
    monthly.replace_months(df, path, {DAY, dt.date(2031, 2, 1), dt.date(2031, 3, 1), dt.date(2031, 4, 1), dt.date(2031, 5, 1)})
    assert monthly.listed(spark, path) == {dt.date(2031, m, 1) for m in (1, 2, 3, 4, 5)}
    rest = monthly.read(spark, path, df.schema, {DAY, dt.date(2031, 3, 1)}).where("id = 0")
    monthly.replace_months(rest, path, {DAY, dt.date(2031, 3, 1)})
    assert monthly.listed(spark, path) == {dt.date(2031, m, 1) for m in (1, 2, 4, 5)}
    assert {r.id for r in monthly.read(spark, path, df.schema).collect()} == {0} | {
        r.id for r in df.where("month(date) in (2, 4, 5)").collect()
    }
    assert monthly.read(spark, str(tmp_path / "none"), df.schema, {DAY}).count() == 0
    assert monthly.following(dt.date(2031, 12, 1)) == dt.date(2032, 1, 1) and monthly.preceding(DAY) == dt.date(2030, 12, 1)


RUN = dt.date(2031, 6, 20)
POINTS = [f"p{i}" for i in range(4)]


def _raw(spark, run=RUN):
    """Half a year of observed days up to five before the run, and two runs of forecasts around it."""
    observed = [
        (p, day, None if (i + k) % 11 == 0 else float((i * 7 + k) % 40), 1.0, dt.datetime.combine(day + dt.timedelta(days=5), dt.time(1)))
        for k, p in enumerate(POINTS)
        for i, day in enumerate(run - dt.timedelta(days=n) for n in range(170, 4, -1))
    ]
    runs = [run - dt.timedelta(days=1), run]
    forecast = [
        (r, p, r + dt.timedelta(days=o), float((o + k + 9) % 13), 50.0, 2.0, dt.datetime.combine(r, dt.time(2)))
        for r in runs for k, p in enumerate(POINTS) for o in range(-7, 7)
    ]
    hourly = [
        (r, p, dt.datetime.combine(r, dt.time(h)), float(h * (k + 1)), dt.datetime.combine(r, dt.time(2)))
        for r in runs for k, p in enumerate(POINTS) for h in range(0, 24, 5)
    ]
    flood = [(r, p, r, 5.0, 6.0, dt.datetime.combine(r, dt.time(2))) for r in runs for p in POINTS]
    rows = {"archive_daily": observed, "forecast_daily": forecast, "forecast_hourly": hourly, "flood_daily": flood}
    return {name: spark.createDataFrame(values, schemas.RAW[name]) for name, values in rows.items()}


def _areas(spark, score=40.0):
    rows = [(f"a{i}", f"Area {i}", "City", 10, score, i, 0.5, 5, 14.4, 121.0, POINTS[i % 3]) for i in range(7)]
    return spark.createDataFrame(rows, schemas.DIMENSION)


def _same(models, raw, areas, run, names=None):
    full = build_models({**raw, "dim_barangay": areas}, Params(), run)
    for name in names or ("dim_barangay", *MODELS):
        got, want = (sorted(map(tuple, m[name].collect()), key=str) for m in (models, full))
        assert got == want, name
        assert models[name].schema.simpleString() == full[name].schema.simpleString(), name


def test_one_new_window_rewrites_its_months_only(spark, tmp_path):
    raw, areas, root = _raw(spark), _areas(spark), tmp_path / "models"

    def update(batch, all_raw, dimension=areas):
        empty = {name: raw[name].limit(0) for name in incremental.UNITS}
        return incremental.update(spark, all_raw, empty | batch, dimension, str(root), Params(), RUN)

    models, touched = update(raw, raw)
    _same(models, raw, areas, RUN)
    tables_ = ("int_rain_daily_unioned", "int_rain_rolling", "fct_rain_barangay_daily", "month_totals", "observed_winners")
    before = {t: _files(root / t) for t in tables_}
    assert len(before["int_rain_rolling"]) == 6

    # A window of two days, the second of them the last of March: its sums reach into April.
    days = [dt.date(2031, 3, 30), dt.date(2031, 3, 31)]
    window = spark.createDataFrame([(p, d, 99.0, 1.0, dt.datetime(2031, 6, 19)) for p in POINTS[:2] for d in days], ARCHIVE)
    later = raw | {"archive_daily": raw["archive_daily"].unionByName(window)}
    models, touched = update({"archive_daily": window}, later)
    _same(models, later, areas, RUN)
    march, april, run_month = (dt.date(2031, m, 1) for m in (3, 4, 6))
    assert touched["int_rain_daily_unioned"] == touched["month_totals"] == {march}
    assert touched["int_rain_rolling"] == {march, april} and touched["fct_rain_barangay_daily"] == {march, april, run_month}
    after = {t: _files(root / t) for t in tables_}
    changed = {t: {dt.date.fromisoformat(m[-10:]) for m in after[t] if after[t][m] != before[t].get(m)} for t in tables_}
    assert changed == {
        "int_rain_daily_unioned": {march}, "int_rain_rolling": {march, april}, "month_totals": {march}, "observed_winners": {march},
        "fct_rain_barangay_daily": {march, april, run_month},
    }
    assert not (root / incremental.STEPS).exists()

    # Another dimension touches every month of the facts, and nothing below them.
    models, touched = update({}, later, _areas(spark, 50.0))
    _same(models, later, _areas(spark, 50.0), RUN, ["fct_rain_barangay_daily"])
    assert not touched["int_rain_rolling"] and len(touched["fct_rain_barangay_daily"]) == 6


def test_coverage_of_the_fact_without_reading_it(spark, tmp_path):
    raw, areas, root = _raw(spark), _areas(spark), str(tmp_path / "m")
    late = raw["archive_daily"].where("not (grid_id = 'p1' and date between '2031-03-05' and '2031-03-08')")
    first = raw | {"archive_daily": late.where("date > '2031-02-10'")}
    incremental.update(spark, first, first, areas, root, Params(), RUN)
    batch = {"archive_daily": late.where("date <= '2031-02-10'"), "forecast_daily": raw["forecast_daily"].limit(0)}
    models, _ = incremental.update(spark, raw, batch, areas, root, Params(), RUN)
    until = F.lit(dt.date(2031, 6, 25))
    found = incremental.uncovered_dates(models, until)
    want = checks.incomplete_dates(models["fct_rain_barangay_daily"], "date", "pcode", until, models["dim_barangay"])
    assert sorted(found.collect()) == sorted(want.collect()) != []
    assert {dt.date(2031, 3, d) for d in (5, 6, 7, 8)} <= {r.date for r in found.collect()}
    assert "fct_rain_barangay_daily" not in found._jdf.queryExecution().executedPlan().toString()


def test_bitmaps_merge_in_any_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, *(DAY + dt.timedelta(days=i) for i in range(4))]), rng.choice([None, *map(str, range(70_000))])) for _ in range(3000)]
    df = spark.createDataFrame(rows + rows[:100], "date date, k string")
    members = spark.range(70_000).select(F.col("id").cast("string").alias("k"))
    # One shard of more members than a bitmap has bits.
    numbers = coverage.numbered(members, "k", 1).cache()
    assert numbers.select("shard", "place").distinct().count() == 70_000
    parts = [coverage.summed_up(p, "date", "k", numbers) for p in (df.where("k > '3'"), df.where("k <= '5'"))]
    want = {}
    for day, k in rows:
        if day is not None and k is not None:
            want.setdefault(day, set()).add(k)
    merged = coverage.members_per_date(parts[0].unionByName(parts[1])).collect()
    assert {r.date: r.n for r in merged} == {d: len(s) for d, s in want.items()}
    assert coverage.members_per_date(coverage.summed_up(df.limit(0), "date", "k", numbers)).count() == 0


def test_an_update_that_stops_is_repeated(spark, tmp_path, monkeypatch):
    raw, areas, root = _raw(spark), _areas(spark), str(tmp_path / "models")
    first = raw | {"archive_daily": raw["archive_daily"].where("date < '2031-04-28' or date > '2031-05-02'")}
    incremental.update(spark, first, first, areas, root, Params(), RUN)
    batch = {"archive_daily": raw["archive_daily"], "forecast_daily": raw["forecast_daily"].limit(0)}
    replace = monthly.replace_months
    for stop_at in ("int_rain_daily_unioned", "fct_rain_barangay_daily"):

        def stopping(df, path, *args, **kwargs):
            if path.endswith(stop_at):
                raise RuntimeError("lost")
            replace(df, path, *args, **kwargs)

        monkeypatch.setattr(monthly, "replace_months", stopping)
        with pytest.raises(RuntimeError, match="lost"):
            incremental.update(spark, raw, batch, areas, root, Params(), RUN)
    monkeypatch.setattr(monthly, "replace_months", replace)
    models, _ = incremental.update(spark, raw, batch, areas, root, Params(), RUN)
    _same(models, raw, areas, RUN, ["int_rain_rolling", "fct_rain_barangay_daily", "mart_monthly_normal"])


def test_many_areas_are_not_repeated_for_every_month(spark, monkeypatch):
    """Every area is sent once, a hot point's areas to several tasks, and facts still leave in order of months."""
    raw, areas = _raw(spark), _areas(spark)
    models = build_models({**raw, "dim_barangay": areas}, Params(), RUN)
    months = monthly.months_in(models["int_rain_rolling"], F.col("date"))
    facts = {}
    for few in (7, 6):
        monkeypatch.setattr(incremental, "FEW_AREAS", few)
        made = incremental.facts_by_month(models["int_rain_rolling"], areas, models["int_warnings_daily"], Params(), months)
        facts[few] = made.withColumn("task", F.spark_partition_id()).collect()
    kept = [sorted(map(str, (r.asDict() | {"task": 0} for r in rows))) for rows in facts.values()]
    assert kept[0] == kept[1] != []
    by_task = {}
    for r in facts[6]:
        by_task.setdefault(r.task, []).append(r.part_month)
    assert all(seen == sorted(seen) for seen in by_task.values())
    # One sort by month, of the point-days, below the join; the one asked for above it is spared.
    plan = made.sortWithinPartitions(monthly.MONTH)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Sort \[part_month", plan)) == 1 and plan.index("ShuffledHashJoin") < plan.index("Sort [part_month")
    assert "SortMergeJoin [part_month" not in plan


def test_days_of_a_shard_share_a_task(spark, monkeypatch):
    """So a date has one bitmap of a shard, not one of every task."""
    monkeypatch.setattr(coverage, "SHARD_MEMBERS", 50)
    members = spark.range(600).select(F.concat(F.lit("A"), "id").alias("k"))
    numbers = coverage.numbered(members, "k").cache()
    shards = numbers.agg(F.max("shard")).first()[0] + 1
    df = members.crossJoin(spark.range(5).select(F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("date"))).repartition(7)
    summary = coverage.summed_up(df, "date", "k", numbers)
    assert {(r.date, r.n) for r in coverage.members_per_date(summary).collect()} == {(DAY + dt.timedelta(days=i), 600) for i in range(5)}
    sent = []

    def partials(plan):
        if plan.nodeName() == "Exchange" and "_groupingexpression" in plan.toString().splitlines()[0]:
            sent.append(plan.metrics().apply("shuffleRecordsWritten").value())
        if plan.nodeName() == "AdaptiveSparkPlan":
            partials(plan.executedPlan())
        elif plan.nodeName().endswith("QueryStage"):
            partials(plan.plan())
        children = plan.children()
        for i in range(children.size()):
            partials(children.apply(i))

    summary.collect()
    partials(summary._jdf.queryExecution().executedPlan())
    assert shards == 16 and sent == [shards * 5]


def test_texts_of_facts_have_no_bounds_in_their_files(spark, tmp_path):
    df = spark.sql("select date'2031-01-15' as date, cast(id as string) as text, id, date'2031-01-01' as part_month from range(9)")
    monthly.replace_months(df, str(tmp_path / "t"), {DAY}, spread=False)
    for file in (tmp_path / "t").rglob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0)
        bounds = {c.path_in_schema: c.statistics is not None and c.statistics.has_min_max for c in map(group.column, range(group.num_columns))}
        assert bounds == {"date": True, "text": False, "id": True}


def test_months_that_hold_nothing_are_not_ranked_again(spark, tmp_path, monkeypatch):
    """Their rows win; those of stored months still have to."""
    winners, beaten, ranked = _winners(tmp_path / "w"), Winners._beaten, []
    monkeypatch.setattr(Winners, "_beaten", lambda self, best, months: ranked.append((best.count(), months)) or beaten(self, best, months))
    first = _versions(7, 300, days=31)
    assert winners.merge(spark.createDataFrame(first, ARCHIVE), _kept(spark, tmp_path)).count() == len({r[:2] for r in first})
    second = _versions(8, 600, days=59)
    winners.merge(spark.createDataFrame(second, ARCHIVE), _kept(spark, tmp_path))
    assert ranked == [(len({r[:2] for r in second if r[1] < dt.date(2031, 2, 1)}), {DAY})]
    want = winners.rank(spark.createDataFrame(first + second, ARCHIVE)).collect()
    assert sorted(map(tuple, winners.read(spark).collect()), key=str) == sorted(map(tuple, want), key=str)


def test_winners_are_few_files_after_many_merges(spark, tmp_path):
    winners = _winners(tmp_path / "w")
    for seed in range(3):
        winners.merge(spark.createDataFrame(_versions(seed, 2000, days=90), ARCHIVE).repartition(8), _kept(spark, tmp_path))
    assert {len(files) for files in _files(tmp_path / "w").values()} == {1}


def test_facts_leave_their_tasks_by_month_and_without_a_key(spark, tmp_path):
    """So neither an exchange nor a sort of area-days stands before the write."""
    raw, areas, root = _raw(spark), _areas(spark), tmp_path / "m"
    models, _ = incremental.update(spark, raw, raw, areas, str(root), Params(), RUN)
    assert "row_key" not in spark.read.parquet(str(root / "fct_rain_barangay_daily")).columns
    assert models["fct_rain_barangay_daily"].where("row_key <=> concat_ws('|', pcode, date)").count() > 0
    months = monthly.listed(spark, str(root / "int_rain_rolling"))
    facts = incremental.facts_by_month(models["int_rain_rolling"], areas, models["int_warnings_daily"], Params(), months)
    rows = facts.select(F.spark_partition_id().alias("task"), monthly.MONTH, "date").collect()
    assert len(rows) == models["fct_rain_barangay_daily"].count() and all(r.part_month == r.date.replace(day=1) for r in rows)
    by_task = {}
    for r in rows:
        by_task.setdefault(r.task, []).append(r.part_month)
    assert all(seen == sorted(seen) for seen in by_task.values())
    plan = facts.sortWithinPartitions(monthly.MONTH)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [part_month" in plan and not re.search(r"Sort \[part_month#\d+ ASC NULLS FIRST\]", plan)

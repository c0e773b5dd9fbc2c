import datetime as dt
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hazardmarts.plans import gates
from hazardmarts.sources import landing, snapshots, tables
from hazardmarts.sources.landing import land_changes
from tests import fixtures as fx


def _same_as_reload(spark, raw, out):
    landed = tables.read_landed(spark, str(out))
    for name, df in snapshots.read_raw(spark, str(raw)).items():
        key = lambda r: tuple(str(v) for v in r)
        assert sorted(landed[name].collect(), key=key) == sorted(df.collect(), key=key), name


def test_changes_equal_a_full_reload(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"

    def land(**changes):
        read = land_changes(spark, str(raw), str(out), **changes)
        _same_as_reload(spark, raw, out)
        return tuple(read[t] for t in ("forecast_daily", "forecast_hourly", "flood_daily", "archive_daily"))

    assert land() == (0, 0, 0, 0)
    fx.write_all(raw)
    assert land() == (1, 1, 1, 1)
    assert land() == (0, 0, 0, 0)

    for i in (1, 2):
        fx.write_run(raw, fx.RUN + dt.timedelta(days=i))
    assert land() == (2, 2, 2, 0)
    assert list((out / "flood_daily").glob(f"run_date={fx.RUN}/*.parquet"))

    changed = fx.forecast(fx.RUN, rain={fx.A: [1.25, 2.25], fx.B: [3.25, 4.25]})
    fx.write(raw / str(fx.RUN) / "forecast.json", changed, indent=2)
    fx.write(raw / "archive" / "2031-03-09_2031-03-09.json", fx.archive(days=["2031-03-09"], rain={fx.A: [1.25]}))
    assert land() == (1, 1, 0, 1)

    emptied = {**fx.forecast(fx.RUN), "points": []}
    fx.write(raw / str(fx.RUN) / "forecast.json", emptied)
    assert land() == (1, 1, 0, 0)

    fx.write(raw / "2031-03-16" / "forecast-0002.json", fx.forecast(fx.RUN + dt.timedelta(days=2)))
    assert land() == (1, 1, 0, 0)
    assert land(full=True) == (3, 3, 3, 2)

    # Removed runs and windows (moved out of the tree) leave the tables too.
    (raw / "2031-03-15").rename(tmp_path / "elsewhere")
    (raw / "archive" / f"{fx.ARCHIVE_DAYS[0]}_{fx.ARCHIVE_DAYS[-1]}.json").rename(tmp_path / "window.json")
    assert land() == (0, 0, 0, 0)
    assert not list((out / "flood_daily").glob("run_date=2031-03-15/*.parquet"))


def test_misfiled_run_raises_and_is_not_listed_as_landed(spark, tmp_path):
    raw, out = tmp_path / "raw", tmp_path / "out"
    fx.write(raw / "2031-03-15" / "flood.json", fx.flood(fx.RUN))
    for _ in range(2):
        with pytest.raises(Exception, match="snapshot of another date in directory 2031-03-15"):
            land_changes(spark, str(raw), str(out))


def _gates_agree(spark, out):
    """The gates on what landing counted, and on the landed rows."""
    landed, facts = tables.read_landed(spark, str(out)), landing.landed_facts(spark, str(out))
    active = spark.createDataFrame([(fx.A,), (fx.B,)], "grid_id string")
    seen = 0
    for run in sorted(landing.landed_units(spark, str(out))["forecast_daily"]):
        day = dt.date.fromisoformat(run)
        inputs = (landed["forecast_daily"], landed["flood_daily"], active)
        want = sorted(gates.run_gates(*inputs, F.lit(day)).collect())
        known = facts["forecast_daily"].get(run, {}), facts["flood_daily"].get(run, {})
        if "nulls" in known[0] and "negative" in known[1]:
            found = gates.run_gates_on_facts(*known, *inputs, day)
            if found is None:
                assert not want[3].passed
            else:
                assert sorted(found.collect()) == want
            seen += 1
    for table, df in landed.items():
        assert landing.landed_rows(spark, str(out), table) in (None, df.count())
    return seen


def test_facts_of_the_landing_pass_equal_scans(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", tmp_path / "out"
    land = lambda **changes: land_changes(spark, str(raw), str(out), **changes)
    land()
    fx.write_all(raw)
    fx.good_run(raw, fx.RUN + dt.timedelta(days=1))
    bad = fx.forecast(fx.RUN + dt.timedelta(days=2), rain={fx.A: [700.0, None], fx.B: [None, None]})
    fx.write(raw / str(fx.RUN + dt.timedelta(days=2)) / "forecast.json", bad)
    fx.write(raw / str(fx.RUN + dt.timedelta(days=2)) / "flood.json", fx.flood(fx.RUN + dt.timedelta(days=2)))
    land()
    assert _gates_agree(spark, out) == 3
    assert landing.landed_rows(spark, str(out), "forecast_daily") == 4 + 28 + 4
    # A run that shrinks, and one that goes.
    fx.write(raw / str(fx.RUN) / "forecast.json", {**fx.forecast(fx.RUN), "points": []})
    (raw / str(fx.RUN + dt.timedelta(days=2))).rename(tmp_path / "gone")
    land()
    assert _gates_agree(spark, out) == 2 and landing.landed_rows(spark, str(out), "forecast_daily") == 28
    # Many units at once are counted afterwards, only the newest in the pass.
    monkeypatch.setattr(landing, "OBSERVED_UNITS", 1)
    land(full=True)
    assert _gates_agree(spark, out) == 1 and landing.landed_rows(spark, str(out), "forecast_daily") == 28


def test_a_task_that_is_run_again_counts_once(tmp_path):
    """Each task fails once after it has read its rows; the facts are those of the rows that were written."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from pyspark import TaskContext
from pyspark.sql import functions as F
from hazardmarts import session
from hazardmarts.sources.landing import write_observed
spark = session.build("retry", master="local[2,3]", spark__ui__enabled="false")
def fail_once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")
rows = spark.range(0, 1000, 1, 3).mapInArrow(fail_once, "id bigint").select("id", (F.col("id") % 2).alias("unit"))
seen = write_observed(rows, {str(tmp_path / "out")!r}, "unit", {{"rows": F.count("*"), "odd": F.count_if(F.col("unit") == 1), "last": F.max("id")}})
assert seen == {{"rows": 1000, "odd": 500, "last": 999}}, seen
assert spark.read.parquet({str(tmp_path / "out")!r}).count() == 1000
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240)
    assert done.returncode == 0 and "lost" in done.stderr, done.stderr[-3000:]

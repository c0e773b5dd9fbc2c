"""The nearest of a list of points, against all pairs."""

import math
import random
import re
import uuid

import pytest

from hazardmarts.operators import nearest


def _km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))


def _found(spark, tmp_path, queries, points):
    def keep(df, label):
        path = str(tmp_path / f"{label}-{uuid.uuid4().hex}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    q = spark.createDataFrame([(i, *p) for i, p in enumerate(queries)], "id int, lat double, lon double")
    p = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "point_id int, lat double, lon double")
    return {r.id: (r.point_id, r.km) for r in nearest.nearest_points(q, p, keep).collect()}


def _check(spark, tmp_path, queries, points):
    found = _found(spark, tmp_path, queries, points)
    assert len(found) == len(queries)
    for i, q in enumerate(queries):
        best = min(_km(q, p) for p in points)
        got, km = found[i]
        assert abs(km - best) < 1e-6, (q, points[got])
        # The first of the equally near ones, up to rounding.
        assert got <= min(j for j, p in enumerate(points) if _km(q, p) <= best - 1e-9 or _km(q, p) == best)


def test_irregular_points(spark, tmp_path, monkeypatch):
    """A dense town, a line, scattered points, both poles and both sides of the date line; queries everywhere."""
    monkeypatch.setattr(nearest, "LEAF", 4)
    rng = random.Random(5)
    points = [(14.5 + rng.gauss(0, 0.002), 121 + rng.gauss(0, 0.002)) for _ in range(300)]
    points += [(0.0, i * 0.5) for i in range(40)] + [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(60)]
    points += [(90.0, 0.0), (-90.0, 10.0), (10.0, 179.99), (10.0, -179.98)] + points[:5]
    queries = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(150)]
    queries += [(14.5 + rng.gauss(0, 0.01), 121 + rng.gauss(0, 0.01)) for _ in range(150)]
    queries += [(89.9, 77.0), (-89.99, -170.0), (10.0, 180.0), (10.0, -180.0), (10.0, 539.99), (-14.5, -59.0), points[7], points[7]]
    _check(spark, tmp_path, queries, points)


def test_ties_go_to_the_first(spark, tmp_path):
    points = [(0.0, 2.0), (0.0, 0.0), (0.0, 2.0), (0.0, 0.0)]
    found = _found(spark, tmp_path, [(0.0, 1.0), (0.0, 0.1), (5.0, 1.0)], points)
    assert [found[i][0] for i in range(3)] == [0, 1, 0]


@pytest.mark.parametrize("points", [[], [(None, 1.0)], [(3.0, 4.0)]])
def test_few_points_and_missing_coordinates(spark, tmp_path, points):
    found = _found(spark, tmp_path, [(1.0, None), (None, None), (-3.0, -176.0)], points)
    assert found[0] == found[1] == (None, None)
    assert found[2][0] == (0 if points == [(3.0, 4.0)] else None)


def test_the_least_distance_is_kept_by_hash(spark):
    """The many pairs of places and points are not sorted in the tasks that make them; ties still go by rank, then by id."""
    leaves = spark.createDataFrame([(0.0, 1.0, 3, 7), (0.0, 1.0, 3, 8), (5.0, 1.0, 3, 8)], "lat double, lon double, level int, cell bigint")
    rows = [(3, 7, 10, 2, 0.0, 2.0), (3, 8, 11, 1, 0.0, 0.0), (3, 8, 9, 1, 0.0, 0.0), (3, 7, 12, 0, 0.0, 2.1)]
    offered = spark.createDataFrame(rows, "level int, cell bigint, point_id int, rank int, to_lat double, to_lon double")
    best = nearest._first_of_nearest(leaves, offered)
    assert re.search(r"HashAggregate\(.*partial_min\(\([0-9.]+ \* ASIN", best._jdf.queryExecution().executedPlan().toString())
    assert {r.lat: (r.best.rank, r.best.point_id) for r in best.collect()} == {0.0: (1, 9), 5.0: (1, 9)}

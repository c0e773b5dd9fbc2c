import math
import random

import pytest
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.functions import haversine_km
from hazardmarts.operators.spatial import active_points, centroids, lattice_points, with_nearest_point
from hazardmarts.params import Lattice, Params
from hazardmarts.plans.dimension import build_dimension
from tests import fixtures as fx


def _km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(min(1.0, a)))


def test_lattice(spark):
    points = lattice_points(spark, Lattice()).collect()
    assert len(points) == Lattice().size == 60 and len({p.grid_id for p in points}) == 60
    by_id = {p.grid_id: (p.lat, p.lon) for p in points}
    assert by_id["g0000"] == (14.35, 120.9) and by_id["g0905"] == (14.8, 121.15) and by_id["g0203"] == (14.45, 121.05)


def test_distance(spark):
    """Along a meridian and the equator a degree is an arc of one degree; opposite points are half a circle apart."""
    arc = 6371.0088 * math.pi / 180
    pairs = [(10.0, 50.0, 11.0, 50.0, arc), (0.0, -3.0, 0.0, -1.0, 2 * arc), (30.0, 20.0, -30.0, -160.0, 180 * arc), (7.0, 8.0, 7.0, 8.0, 0.0)]
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double, km double")
    for r in df.select("km", haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("got")).collect():
        assert abs(r.got - r.km) < 1e-6


def test_ids_of_large_lattices_are_unique(spark):
    lattice = Lattice(0.0, 11.0, 0.0, 11.0, 0.1)
    ids = lattice_points(spark, lattice)
    assert ids.count() == ids.select("grid_id").distinct().count() == 111 * 111
    place = spark.createDataFrame([(10.1, 0.0), (1.0, 10.0)], "lat double, lon double")
    assert [r.grid_id for r in with_nearest_point(place, lattice).collect()] == ["g101000", "g010100"]


def _check_nearest(spark, lattice, places):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "i int, lat double, lon double")
    grid = [(p.grid_id, p.lat, p.lon) for p in lattice_points(spark, lattice).orderBy("grid_id").collect()]
    for r in with_nearest_point(df, lattice).collect():
        distance = {g: _km(r.lat, r.lon, la, lo) for g, la, lo in grid}
        # equal up to rounding noise: on exact midlines either neighbour is nearest
        assert distance[r.grid_id] <= min(distance.values()) + 1e-9, (r, min(distance, key=distance.get))


def test_nearest_in_and_around_the_box(spark):
    random.seed(1)
    places = [(random.uniform(14.2, 14.95), random.uniform(120.75, 121.3)) for _ in range(400)]
    places += [(14.35 + 0.025 * i, 120.9 + 0.025 * (i % 7)) for i in range(20)]
    _check_nearest(spark, Lattice(), places)


def test_nearest_from_anywhere_on_earth(spark):
    random.seed(2)
    places = [(random.uniform(-90, 90), random.uniform(-180, 180)) for _ in range(400)]
    places += [(90.0, 0.0), (-90.0, 10.0), (14.5, -59.0), (-14.5, -59.0), (0.0, 0.0)]
    _check_nearest(spark, Lattice(), places)
    _check_nearest(spark, Lattice(-60.0, 75.0, -120.0, 140.0, 7.5), places)


def test_known_points_and_nulls(spark):
    df = spark.createDataFrame(
        [(14.8, 121.15), (14.44, 121.06), (14.71, 121.08), (14.5, None), (None, 121.0)], "lat double, lon double"
    )
    assert [r.grid_id for r in with_nearest_point(df, Lattice()).collect()] == ["g0905", "g0203", "g0704", None, None]


def test_active_points(spark):
    points = active_points(lattice_points(spark, Lattice()), fx.dimension(spark))
    assert sorted(p.grid_id for p in points.collect()) == [fx.A, fx.B, fx.IDLE]


def _ring(ring, corners):
    closed = [*corners, corners[0]]
    return [(ring, i, float(x), float(y)) for i, (x, y) in enumerate(closed)]


def test_centroids_with_holes_and_parts(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4)]
    hole = [(2, 2), (2, 4), (4, 4), (4, 2)]
    island = [(10, 0), (12, 0), (12, 2), (10, 2)]
    shapes = {
        "square": _ring(0, square),
        "clockwise": _ring(0, square[::-1]),
        "holed": _ring(0, square) + _ring(1, hole),
        "parts": _ring(0, square) + _ring(-1, island),
        "triangle": _ring(0, [(0, 0), (3, 0), (0, 3)]),
    }
    rows = [(k, *v) for k, vs in shapes.items() for v in vs]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, ring int, seq int, x double, y double")
    got = {r.id: (round(r.lon, 9), round(r.lat, 9)) for r in centroids(df, "id", origin=(1.5, -7.0)).collect()}
    assert got == {
        "square": (2.0, 2.0), "clockwise": (2.0, 2.0), "triangle": (1.0, 1.0),
        "holed": (round((16 * 2 - 4 * 3) / 12, 9),) * 2,
        "parts": (round((16 * 2 + 4 * 11) / 20, 9), round((16 * 2 + 4 * 1) / 20, 9)),
    }


@pytest.mark.parametrize("corners, message", [
    ([(0, 0, 0), (1, 2, 0), (2, 2, 2), (3, 0, 2)], "not closed"),
    ([(0, 0, 0), (1, 2, 0), (3, 2, 2), (4, 0, 2), (5, 0, 0)], "not closed or not gapless: odd"),
    ([(0, 0, 0), (1, 2, 0), (1, 2, 1), (2, 0, 2), (3, 0, 0)], "not gapless"),
    ([(0, 0, 0), (1, 2, 0), (2, 4, 0), (3, 0, 0)], "polygon without area: odd"),
])
def test_unsound_rings_raise(spark, corners, message):
    rows = [("odd", 0, i, float(x), float(y)) for i, x, y in corners]
    df = spark.createDataFrame(rows, "id string, ring int, seq int, x double, y double")
    with pytest.raises(Exception, match=message):
        centroids(df, "id", origin=(0.0, 0.0)).collect()


def test_build_dimension(spark):
    master = spark.createDataFrame(
        [("T1", "First", "City of Northgate", 640, 12.34565, 2, 0.75, 480), ("T9", "No shape", "X", 1, 1.0, 1, 0.1, 1)],
        "pcode string, name string, city string, population bigint, score double, rank_ncr int, "
        "pct_area_mh_25 double, est_pop_exposed_25 bigint",
    )
    corners = [(121.0, 14.4), (121.125, 14.4), (121.125, 14.5), (121.0, 14.5)]
    vertices = spark.createDataFrame(
        [("T1", *v) for v in _ring(0, corners)], "pcode string, ring int, seq int, x double, y double"
    )
    built = build_dimension(master, vertices, Params())
    assert built.schema == schemas.DIMENSION or built.columns == schemas.DIMENSION.fieldNames()
    assert [tuple(r) for r in built.collect()] == [
        ("T1", "First", "Northgate", 640, 12.3456, 2, 0.75, 480, 14.45, 121.0625, "g0203")
    ]

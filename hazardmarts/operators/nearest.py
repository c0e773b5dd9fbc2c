"""The nearest of any list of points, by great-circle distance.

Places are unit vectors, so neither the date line nor the poles are special, and the straight distance of two vectors grows with
their distance on the sphere. A tree of cubic cells holds the points: a cell of one level has up to 64 of the next, a
quarter as wide, and each knows how many points it has and the box they fill.

A query starts from a bound: its distance to some point in the smallest cell around it that is not empty. The cells of about
that width that the bound reaches are its candidates. In every round a candidate with many points gives way to
its own cells. The far corner of a box bounds the distance of the nearest point from above, the near side that
of all its points from below; cells that begin beyond the least upper bound are dropped. Rounds end when
no candidate has more than ``LEAF`` points or can be divided, after at most ``LEVELS`` of them, and all points of
the remaining ones are compared. A dropped cell is farther away than a point that exists, so it holds no nearest one, and
no equally near one either.

Dense places are divided further, so neither many points nor many queries in one place make a cell large. Queries at
the same place are answered once. Equally near points are settled by the smallest ``rank``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazardmarts.functions import haversine_km

# Levels of the tree below the whole sphere: the smallest cells are 2 / 4 ** 10 wide, some twelve metres.
LEVELS = 10
# Points up to which a cell is not divided.
LEAF = 64
# Width that rounding may add to a bound, on the unit sphere: some centimetres.
MARGIN = 1e-8
AXES = ("x", "y", "z")
Keep = Callable[[DataFrame, str], DataFrame]  # writes rows under a label and returns them as read again


def _placed(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Adds the unit vector."""
    phi, lam = F.radians(F.col(lat)), F.radians(F.col(lon))
    return df.withColumns({"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)})


def _index(value: Column, level: Column) -> Column:
    """The number of the cell along one axis."""
    cells = F.pow(F.lit(4.0), level).cast("bigint")
    return F.least(F.greatest(F.floor((value + 1) / 2 * cells), F.lit(0)), cells - 1)


def _cell(i: Column, j: Column, k: Column) -> Column:
    """One number for three of up to twenty bits."""
    return F.shiftleft(i, 40).bitwiseOR(F.shiftleft(j, 20)).bitwiseOR(k)


def _own_cell(level: Column) -> Column:
    return _cell(*[_index(F.col(a), level) for a in AXES])


def _parent(cell: Column) -> Column:
    part = lambda shift: F.shiftright(F.shiftright(cell, shift).bitwiseAND(F.lit((1 << 20) - 1)), 2)
    return _cell(part(40), part(20), part(0))


def _levels(df: DataFrame, first: int) -> DataFrame:
    """A row for the cell of every level from ``first`` on."""
    levels = df.withColumn("level", F.explode(F.sequence(F.lit(first), F.lit(LEVELS))))
    return levels.withColumn("cell", _own_cell(F.col("level")))


def _nodes(points: DataFrame) -> DataFrame:
    """All cells with points: their number, the box they fill, and one of them."""
    box = [f(a).alias(f"{a}_{n}") for a in AXES for n, f in (("low", F.min), ("high", F.max))]
    some = F.min(F.struct("rank", *AXES)).alias("some")
    cells = _levels(points, 0).groupBy("level", "cell").agg(F.count("*").alias("n"), some, *box)
    return cells.withColumn("parent", _parent(F.col("cell")))


def _open(node: str = "") -> Column:
    """Whether a cell is divided further."""
    return (F.col(f"{node}n") > LEAF) & (F.col(f"{node}level") < LEVELS)


def _length(parts: list[Column]) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def _least() -> Column:
    """From a query to the near side of a box."""
    zero = F.lit(0.0)
    return _length([F.greatest(F.col(f"{a}_low") - F.col(a), F.col(a) - F.col(f"{a}_high"), zero) for a in AXES])


def _most() -> Column:
    """From a query to the far corner of a box."""
    return _length([F.greatest(F.abs(F.col(a) - F.col(f"{a}_low")), F.abs(F.col(f"{a}_high") - F.col(a))) for a in AXES])


def _seeded(queries: DataFrame, nodes: DataFrame) -> DataFrame:
    """Queries with ``bound``: the distance to a point in the smallest cell around them that has any; 2 where only the
    whole sphere does. Cells are looked up once for all queries of a smallest cell."""
    celled = queries.withColumn("home", _own_cell(F.lit(LEVELS)))
    homes = celled.groupBy("home").agg(*[F.min(a).alias(a) for a in AXES])
    around = _levels(homes, 1).select("home", "level", "cell")
    found = around.join(nodes.select("level", "cell", "some"), ["level", "cell"])
    closest = found.groupBy("home").agg(F.max(F.struct("level", "some")).getField("some").alias("some"))
    bound = _length([F.col(a) - F.col(f"some.{a}") for a in AXES])
    return celled.join(closest, "home", "left").withColumn("bound", F.coalesce(bound, F.lit(2.0))).drop("home", "some")


def _starts(seeded: DataFrame, nodes: DataFrame) -> DataFrame:
    """The first candidates: cells at least as wide as the bound, of which it reaches two along each axis at most."""
    wide = F.floor(F.log(2.0, F.lit(2.0) / F.greatest(F.col("bound") + MARGIN, F.lit(1e-9))) / 2)
    levelled = seeded.withColumn("level", F.least(F.greatest(wide, F.lit(0)), F.lit(LEVELS)).cast("int"))
    reach = F.col("bound") + MARGIN
    spans = {
        a: F.array_distinct(F.array(*[_index(F.col(a) + side * reach, F.col("level")) for side in (-1, 0, 1)])) for a in AXES
    }
    cells = F.flatten(F.flatten(F.transform(
        spans["x"], lambda i: F.transform(spans["y"], lambda j: F.transform(spans["z"], lambda k: _cell(i, j, k)))
    )))
    return levelled.withColumn("cell", F.explode(cells)).join(nodes.drop("some", "parent"), ["level", "cell"])


def _pruned(candidates: DataFrame) -> DataFrame:
    """Candidates that may hold the nearest point, with the bound that all of a query's candidates give."""
    tighter = F.least(F.col("bound"), F.min(_most()).over(Window.partitionBy("lat", "lon")))
    return candidates.withColumn("bound", tighter).where(_least() <= F.col("bound") + MARGIN)


def _first_of_nearest(leaves: DataFrame, offered: DataFrame) -> DataFrame:
    """(lat, lon, best) for every place: the least km, rank and point_id of all points of its cells.

    A place meets many points. The least distance is one number per place, kept by hash while the points go by; only the points
    at that distance are then put in order. Ordering all pairs at once would sort them in the tasks that make them.
    """
    place = ["lat", "lon"]
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("to_lat"), F.col("to_lon"))
    least = leaves.join(offered, ["level", "cell"]).groupBy(*place).agg(F.min(km).alias("least"))
    reached = [leaves[c].eqNullSafe(least[c]) for c in place]
    near = leaves.join(least, reached).select(leaves["*"], least["least"])
    nearest = near.join(offered, ["level", "cell"]).where(km <= F.col("least"))
    return nearest.groupBy(*place).agg(F.min(F.struct(km.alias("km"), "rank", "point_id")).alias("best"))


def nearest_points(
    queries: DataFrame, points: DataFrame, keep: Keep, lat: str = "lat", lon: str = "lon", name: str = "point_id", rank: str | None = None
) -> DataFrame:
    """Adds to ``queries`` the id of the nearest of ``points`` (point_id, lat, lon) as ``name``, and ``km``.

    ``rank`` names the column of ``points`` that settles ties, the id by default. Points without coordinates are left
    out; queries without get null, as do all where there is no point. ``keep`` stores the rows of a step.
    """
    listed = points.select("point_id", "lat", "lon", F.col(rank or "point_id").alias("rank")).dropna(subset=["lat", "lon"])
    indexed = keep(_placed(listed, "lat", "lon"), "points")
    nodes = keep(_nodes(indexed), "nodes")
    places = queries.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).dropna().distinct()
    query = ["lat", "lon", *AXES]
    found = keep(_pruned(_starts(_seeded(_placed(places, "lat", "lon"), nodes), nodes)), "round")

    children = nodes.drop("some").withColumn("level", F.col("level") - 1).withColumnRenamed("cell", "child")
    boxes = [f"{a}_{n}" for a in AXES for n in ("low", "high")]
    leaves = [found.where(~_open())]
    while found.where(_open()).limit(1).count():
        # Leaves stay beside the cells of the others, so that both tighten the bound.
        parents = found.where(_open()).select(*query, "bound", "level", F.col("cell").alias("parent"))
        divided = parents.join(children, ["level", "parent"]).select(
            *query, "bound", (F.col("level") + 1).alias("level"), F.col("child").alias("cell"), "n", *boxes
        )
        rest = found.where(~_open()).select(*divided.columns)
        found = keep(_pruned(divided.unionByName(rest)), "round")
        leaves = [found.where(~_open())]

    holders = nodes.where(~_open()).select("level", "cell")
    held = _levels(indexed, 0).join(holders, ["level", "cell"])
    offered = held.select("level", "cell", "point_id", "rank", F.col("lat").alias("to_lat"), F.col("lon").alias("to_lon"))
    best = _first_of_nearest(leaves[0].select("lat", "lon", "level", "cell"), offered)
    answers = best.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.col("best.point_id").alias(name), F.col("best.km").alias("km"))
    same = (queries[lat] == F.col("_lat")) & (queries[lon] == F.col("_lon"))
    return queries.join(answers, same, "left").drop("_lat", "_lon")

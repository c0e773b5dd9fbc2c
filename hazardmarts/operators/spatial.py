"""Regular lattice, nearest lattice point and polygon centroids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardmarts.functions import haversine_km, round_half_even
from hazardmarts.params import Lattice


def point_id(row: Column, col: Column, lattice: Lattice) -> Column:
    """Row and column in as many digits as the larger side needs, at least two, so that ids are unique."""
    digits = max(2, len(str(max(lattice.n_rows, lattice.n_cols) - 1)))
    return F.format_string(f"g%0{digits}d%0{digits}d", row, col)


def _coordinate(start: float, step: float, index: Column) -> Column:
    return round_half_even(F.lit(start) + index.cast("double") * F.lit(step), 4)


def lattice_points(spark: SparkSession, lattice: Lattice) -> DataFrame:
    """All points in row-major order: grid_id, lat, lon."""
    row = F.floor(F.col("id") / F.lit(lattice.n_cols)).cast("int")
    col = F.pmod(F.col("id"), F.lit(lattice.n_cols)).cast("int")
    return spark.range(lattice.size).select(
        point_id(row, col, lattice).alias("grid_id"),
        _coordinate(lattice.lat_min, lattice.step, row).alias("lat"),
        _coordinate(lattice.lon_min, lattice.step, col).alias("lon"),
    )


def active_points(points: DataFrame, dimension: DataFrame) -> DataFrame:
    """Lattice points that at least one area uses."""
    return points.join(dimension.select("grid_id").distinct(), "grid_id", "left_semi")


def with_nearest_point(
    df: DataFrame, lattice: Lattice, lat: str = "lat", lon: str = "lon", name: str = "grid_id"
) -> DataFrame:
    """Attach the id of the nearest lattice point by great-circle distance.

    Needs no join and no exchange, because the candidates follow from the coordinates. In any
    row the nearest column is the one with the least difference in longitude. In a column that
    differs by ``d``, the distance grows with the gap to the latitude atan2(sin lat, cos lat cos d).
    In the box grown by one step that latitude differs from the point's own by far less than half
    a step, so the four surrounding points hold the answer. Anywhere else the surrounding points
    of that latitude and the ends of rows and columns do. Ties go to the first point in
    row-major order.
    """
    la, lo = F.col(lat), F.col(lon)

    def around(position: Column, count: int) -> list[Column]:
        below = F.floor(position)
        return [_clamp(below, count), _clamp(below + F.lit(1), count)]

    def candidate(row: Column, col: Column) -> Column:
        distance = haversine_km(
            la, lo,
            _coordinate(lattice.lat_min, lattice.step, row),
            _coordinate(lattice.lon_min, lattice.step, col),
        )
        return F.struct(distance.alias("km"), row.alias("row"), col.alias("col"))

    def row_position(latitude: Column) -> Column:
        return (latitude - F.lit(lattice.lat_min)) / F.lit(lattice.step)

    def closest_row(col: Column) -> list[Column]:
        gap = F.radians(lo - _coordinate(lattice.lon_min, lattice.step, col))
        phi = F.radians(la)
        best = F.degrees(F.atan2(F.sin(phi), F.cos(phi) * F.cos(gap)))
        return [*around(row_position(best), lattice.n_rows), F.lit(0), F.lit(lattice.n_rows - 1)]

    west_offset = lo - F.lit(lattice.lon_min)
    near_cols = around(west_offset / F.lit(lattice.step), lattice.n_cols)
    near = F.least(*[candidate(r, c) for r in around(row_position(la), lattice.n_rows) for c in near_cols])

    ends = [F.lit(0), F.lit(lattice.n_cols - 1)]
    far_cols = F.array(*around(F.pmod(west_offset, F.lit(360.0)) / F.lit(lattice.step), lattice.n_cols), *ends)
    far_cells = F.flatten(
        F.transform(far_cols, lambda c: F.array(*[F.struct(r.alias("r"), c.alias("c")) for r in closest_row(c)]))
    )
    far = F.array_min(F.transform(far_cells, lambda cell: candidate(cell["r"], cell["c"])))

    margin = lattice.step
    close = la.between(lattice.lat_min - margin, lattice.lat_max + margin) & lo.between(
        lattice.lon_min - margin, lattice.lon_max + margin
    )
    located = la.isNotNull() & lo.isNotNull()
    found = df.withColumn("_near", F.when(located, F.when(close, near).otherwise(far)))
    identifier = F.when(F.col("_near").isNotNull(), point_id(F.col("_near.row"), F.col("_near.col"), lattice))
    return found.withColumn(name, identifier).drop("_near")


def _clamp(index: Column, count: int) -> Column:
    return F.least(F.greatest(index, F.lit(0)), F.lit(count - 1)).cast("int")


def centroids(vertices: DataFrame, key: str, origin: tuple[float, float]) -> DataFrame:
    """Area-weighted centroid per key from closed rings (key, ring, seq, x, y).

    Rings numbered 0 and below are the outer rings of the area's parts and add their area; rings
    above 0 are holes and take it away, whatever the orientation. ``seq`` counts up by one
    within a ring and the last vertex repeats the first. A ring that is open or has a gap or a repeated
    position raises an error that names its key, and so does an area of size zero.

    Every vertex is sent to the edge it starts and the edge it ends, keyed by ring and position,
    so the vertices of one huge polygon are spread over tasks; the sums are combined before the
    second exchange. Coordinates are taken relative to ``origin`` (a point near the polygons) to
    keep the products small and the sums exact to far more than the published six decimals.
    """
    x, y = F.col("x") - F.lit(origin[0]), F.col("y") - F.lit(origin[1])
    ends = vertices.select(
        key,
        "ring",
        F.inline(
            F.array(
                F.struct(F.col("seq").alias("edge"), F.lit(True).alias("starts"), x.alias("px"), y.alias("py")),
                F.struct((F.col("seq") - 1).alias("edge"), F.lit(False).alias("starts"), x.alias("px"), y.alias("py")),
            )
        ),
    )

    def at(starts: bool, value: str) -> Column:
        return F.max(F.when(F.col("starts") == F.lit(starts), F.col(value)))

    edges = (
        ends.groupBy(key, "ring", "edge")
        .agg(
            at(True, "px").alias("x0"), at(True, "py").alias("y0"),
            at(False, "px").alias("x1"), at(False, "py").alias("y1"),
            F.count_if("starts").alias("n_starts"),
        )
        .withColumn("cross", F.expr("x0 * y1 - x1 * y0"))
    )
    # A sound ring has one edge without an end (after its last vertex) and one without a start (before its first).
    lone_start, lone_end = F.col("x1").isNull(), F.col("x0").isNull()
    rings = edges.groupBy(key, "ring").agg(
        F.sum("cross").alias("area2"),
        F.sum(F.expr("(x0 + x1) * cross")).alias("sx"),
        F.sum(F.expr("(y0 + y1) * cross")).alias("sy"),
        F.count_if(lone_start).alias("lone_starts"),
        F.max("n_starts").alias("repeats"),
        F.max(F.when(lone_start, F.struct("x0", "y0"))).alias("last"),
        F.max(F.when(lone_end, F.struct("x1", "y1"))).alias("first"),
    )
    closed = (F.col("last.x0") == F.col("first.x1")) & (F.col("last.y0") == F.col("first.y1"))
    sound = (F.col("lone_starts") == 1) & (F.col("repeats") == 1) & F.coalesce(closed, F.lit(False))
    blame = F.concat(F.lit("ring not closed or not gapless: "), F.col(key).cast("string"))
    rings = rings.withColumn("area2", F.when(sound, F.col("area2")).otherwise(F.raise_error(blame)))
    turn = F.signum("area2") * F.when(F.col("ring") > 0, -1.0).otherwise(1.0)
    areas = rings.groupBy(key).agg(
        F.sum(turn * F.col("area2")).alias("area2"),
        F.sum(turn * F.col("sx")).alias("sx"),
        F.sum(turn * F.col("sy")).alias("sy"),
    )
    flat = F.raise_error(F.concat(F.lit("polygon without area: "), F.col(key).cast("string")))
    areas = areas.withColumn("area2", F.when(F.col("area2") != 0, F.col("area2")).otherwise(flat))
    return areas.select(
        key,
        (F.lit(origin[1]) + F.expr("sy / (3 * area2)")).alias("lat"),
        (F.lit(origin[0]) + F.expr("sx / (3 * area2)")).alias("lon"),
    )

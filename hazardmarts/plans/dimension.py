"""The area dimension: attributes, centroid and nearest lattice point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardmarts import schemas
from hazardmarts.functions import normalize_city, round_half_even
from hazardmarts.operators.spatial import centroids, with_nearest_point
from hazardmarts.params import Lattice, Params


def area_centroids(vertices: DataFrame, params: Params = Params()) -> DataFrame:
    """(pcode, lat, lon) from ring vertices (pcode, ring, seq, x, y) in WGS 84 degrees."""
    return centroids(vertices, "pcode", origin=_middle(params.lattice))


def build_dimension(master: DataFrame, vertices: DataFrame, params: Params = Params()) -> DataFrame:
    """Areas present in both inputs, in the dimension's column order. Sorting is left to the sink."""
    located = with_nearest_point(
        master.join(area_centroids(vertices, params), "pcode", "inner"), params.lattice
    )
    rounded = {"lat": 6, "lon": 6, "score": 4, "pct_area_mh_25": 6}
    columns = {c: round_half_even(F.col(c).cast("double"), digits) for c, digits in rounded.items()}
    finished = located.withColumns({**columns, "city": normalize_city(F.col("city"))})
    return finished.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in schemas.DIMENSION]
    )


def _middle(lattice: Lattice) -> tuple[float, float]:
    return ((lattice.lon_min + lattice.lon_max) / 2, (lattice.lat_min + lattice.lat_max) / 2)

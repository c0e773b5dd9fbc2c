"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius in km.
EARTH_RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    half_dphi = (phi2 - phi1) / F.lit(2.0)
    half_dlambda = F.radians(lon2 - lon1) / F.lit(2.0)
    chord = F.pow(F.sin(half_dphi), F.lit(2.0)) + (
        F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), F.lit(2.0))
    )
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))

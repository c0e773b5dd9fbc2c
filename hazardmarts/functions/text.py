"""Names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_city(name: Column) -> Column:
    """Drop a leading "City of " and surrounding blanks."""
    return F.regexp_replace(F.regexp_replace(name, "^City of ", ""), "^\\s+|\\s+$", "")

"""Text keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_key(*parts: str | Column) -> Column:
    """Parts joined by a bar. A null part makes the key null, which not-null tests rely on."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    pieces = [columns[0].cast("string")]
    for column in columns[1:]:
        pieces += [F.lit("|"), column.cast("string")]
    return F.concat(*pieces)

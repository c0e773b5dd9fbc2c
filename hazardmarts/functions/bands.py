"""Threshold bands and their order of severity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(value: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first band whose lower bound (inclusive) the value reaches.

    ``bands`` are given strictest first. A null value gets ``otherwise``.
    """
    label = None
    for limit, name in bands:
        reached = value >= F.lit(float(limit))
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return F.lit(otherwise) if label is None else label.otherwise(otherwise)


def severity_of(label: Column, levels: Sequence[str]) -> Column:
    """Position of a label in ``levels`` (calm first); unknown labels and null count as calm."""
    rank = F.when(label == levels[0], 0)
    for position, name in enumerate(levels[1:], start=1):
        rank = rank.when(label == name, position)
    return rank.otherwise(0)


def level_of(severity: Column, levels: Sequence[str]) -> Column:
    """Inverse of :func:`severity_of`."""
    label = F.when(severity == 0, levels[0])
    for position, name in enumerate(levels[1:], start=1):
        label = label.when(severity == position, name)
    return label.otherwise(levels[0])


def past_or_forecast(date: Column, run_date: Column) -> Column:
    return F.when(date < run_date, "past").otherwise("forecast")

"""Rounding of doubles with a stated tie rule, and their text form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int) -> Column:
    """Round the binary product half away from zero.

    Spark's ``round`` works on the decimal text (1.005 gives 1.01); SQL engines that scale the
    double itself give 1.0, and the published marts follow the latter.
    """
    scale = F.lit(float(10**digits))
    return F.signum(value) * F.floor(F.abs(value) * scale + F.lit(0.5)) / scale


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the nearest integer with ties to even, and scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def python_float_text(value: Column) -> Column:
    """A double as Python and pandas print it: plain digits from 1e-4 up to 1e16.

    Spark switches to exponents below 1e-3 and from 1e7, and spells them E-4 rather than e-04.
    """
    text = value.cast("string")
    size = F.abs(value)
    plain = F.regexp_replace(text.try_cast("decimal(38,20)").cast("string"), "(\\.[0-9]*?)0+$", "$1")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), "\\.0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    short = F.concat(
        mantissa, F.lit("e"), F.when(exponent < 0, "-").otherwise("+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), "0"),
    )
    return (
        F.when(~text.contains("E"), text)
        .when((size >= F.lit(1e-4)) & (size < F.lit(1e16)), plain)
        .otherwise(short)
    )

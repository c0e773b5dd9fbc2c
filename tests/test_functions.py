


from pyspark.sql import functions as F

from hazardmarts.functions import (
    band, level_of, normalize_city, python_float_text, round_half_away, round_half_even, row_key, severity_of,
)
from hazardmarts.params import Params


def _map(spark, kind, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("x"))).collect()]


def test_rounding(spark):
    values = [1.005, 2.5, -2.5, 0.125, -0.125, None]
    assert _map(spark, "double", values, lambda x: round_half_away(x, 2)) == [1.0, 2.5, -2.5, 0.13, -0.13, None]
    assert _map(spark, "double", values, lambda x: round_half_even(x, 0)) == [1.0, 2.0, -2.0, 0.0, -0.0, None]


def test_python_float_text(spark):
    values = [0.0, 5.0, 0.5, 0.0005, 0.00012345, 0.0001, 0.00001, 1.5e-7, 12345678.9, 1e7, 123456789012345.6, 1e16, 2.5e20, 1e-120, -0.00025, None]
    expected = [None if v is None else repr(v) for v in values]
    assert _map(spark, "double", values, python_float_text) == expected


def test_bands(spark):
    p = Params()
    values = [None, 0.0, 7.49, 7.5, 14.99, 15.0, 29.99, 30.0, 99.0]
    labels = ["none"] * 3 + ["yellow"] * 2 + ["orange"] * 2 + ["red"] * 2
    assert _map(spark, "double", values, lambda x: band(x, p.bands, p.calm)) == labels
    assert _map(spark, "string", ["red", "none", "yellow", "orange", "odd", None], lambda x: severity_of(x, p.levels)) == [3, 0, 1, 2, 0, 0]
    assert _map(spark, "int", [0, 1, 2, 3], lambda x: level_of(x, p.levels)) == list(p.levels)


def test_city_names(spark):
    names = ["City of Caloocan", "Quezon City", "Pateros", " City of X ", "City of \tY\n"]
    assert _map(spark, "string", names, normalize_city) == ["Caloocan", "Quezon City", "Pateros", "City of X", "Y"]


def test_row_key(spark):
    df = spark.sql("select date '2026-09-04' d, 'g1' g, timestamp_ntz '2026-09-03 01:00:00' t, cast(null as string) n")
    row = df.select(row_key("d", "g", "t").alias("a"), row_key("g", "n").alias("b")).first()
    assert tuple(row) == ("2026-09-04|g1|2026-09-03 01:00:00", None)

"""Poisson replication: the distribution, the rates and the draws."""

import math

import pytest

from hazardmarts.llm import mixing


def test_distribution_function():
    for mean in (0.0, 0.01, 1.0, 7.5, 300.0):
        steps = mixing.poisson_cdf(mean)
        assert all(a <= b for a, b in zip(steps, steps[1:])) and steps[-1] >= 1 - 2**-32
        k = int(mean)
        want = sum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(k + 1)) if mean else 1.0
        assert abs(steps[k] - want) < 1e-9
    with pytest.raises(ValueError):
        mixing.poisson_cdf(501)


def test_large_means_are_sums_of_draws(spark):
    df = spark.createDataFrame([(i, "t", "s" if i else "tiny") for i in range(1000)], "doc_id long, text string, source string")
    counts = mixing.mix(df, {"s": 0.0, "tiny": 1.0}, total=3000.0).groupBy("doc_id").count().collect()
    assert len(counts) == 1 and counts[0].doc_id == 0 and abs(counts[0]["count"] - 3000) < 300


def test_rates_reach_the_shares():
    got = mixing.rates({"a": 100, "b": 900, None: 50}, {"a": 0.5, "b": 0.3, "absent": 0.1}, 0.1, 1000)
    assert got == {"a": 5.0, "b": 1 / 3, "absent": 0.0, None: 2.0}


def test_counts_follow_the_target(spark):
    rows = [(i, "x" * 10, "hot" if i % 3 else "rare") for i in range(30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(df, {"hot": 0.4, "rare": 0.6}).groupBy("source").count().collect()
    counts = {r["source"]: r["count"] for r in mixed}
    assert abs(counts["hot"] - 12_000) < 500 and abs(counts["rare"] - 18_000) < 600


def test_draws_repeat_and_follow_the_seed(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(500)], "doc_id long, text string, source string")
    draw = lambda seed: sorted((r.doc_id, r["copy"]) for r in mixing.mix(df, {"s": 1.0}, seed=seed).repartition(3).collect())
    assert draw(1) == draw(1) != draw(2)


def test_order_is_global(spark):
    df = spark.createDataFrame([(i, "t", "s") for i in range(2000)], "doc_id long, text string, source string")
    keys = [r.mix_key for r in mixing.mix(df, {"s": 1.0}, total=4000).collect()]
    assert keys == sorted(keys)


def test_edge_cases(spark):
    rows = [(None, None, None, 1), (1, "", "a", 2), (2, "text", "a", 3), (2, "text", "a", 3), (3, "y" * 1_000_000, "b", 4), (4, "z", "new", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    got = mixing.mix(df, {"a": 1.0, "b": 1.0, "gone": 1.0}, rest=1.0, total=4_000.0).collect()
    assert all(r.rate > 0 for r in got)
    twins = [r["copy"] for r in got if r.doc_id == 2]
    assert all(twins.count(c) == 2 for c in twins)
    assert mixing.mix(df.limit(0), {"a": 1.0}).count() == 0
    assert mixing.mix(df, {}, rest=1.0).count() >= 0

"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixture, measured in characters of text. Its mean repetition rate is
share x mixture size / size of the source. A document's count is drawn by inverting the Poisson
distribution of that mean at a uniform number taken from a hash of seed and id, so that draws need no state
and repeat on a lost task. Counts are exploded, then copies are put in a global random order: range
partitions of a hash of the copy, each sorted by it.

The sizes per source are aggregated to one row per named source and one for the rest, which is as many
rows as the caller's weights have entries, plus one. Only that is collected. The documents themselves are
scanned once more and shuffled once, by hash, so that a source with a third of all rows is spread
like any other.

Null sources and sources without a weight share ``rest``. A source without text gets rate 0. Null
ids are drawn as the empty id; rows that share an id share its draw. Null and empty texts count no
characters but are replicated like any other. Input columns called ``copy``, ``rate`` or
``mix_key`` are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import text_of

ADDED = ("copy", "rate", "mix_key")
# Larger means are drawn as sums of independent draws of equal smaller means.
LARGEST_MEAN = 500


def unit(seed: int, *keys: Column) -> Column:
    """A number in (0, 1) from 32 bits of a hash of the seed and the keys."""
    return (_bits(seed, *keys) + 0.5) / F.lit(4294967296.0)


def _bits(seed: int, *keys: Column) -> Column:
    parts = [F.coalesce(k.cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 8), 16, 10).cast("bigint")


def poisson_cdf(mean: float) -> list[float]:
    """The distribution function from 0 on, up to where a 32-bit uniform number cannot pass."""
    if not 0 <= mean <= LARGEST_MEAN:
        raise ValueError(f"a mean must be between 0 and {LARGEST_MEAN}")
    term = total = math.exp(-mean)
    out = [total]
    k = 0
    while total < 1 - 2**-34 and k < mean + 40 * math.sqrt(mean + 1):
        k += 1
        term *= mean / k
        total += term
        out.append(total)
    return out


def rates(sizes: Mapping[str | None, int], weights: Mapping[str, float], rest: float, total: float) -> dict:
    """Mean repetition of each named source and, under None, of all others together."""
    shares = {**weights, None: rest}
    whole = sum(shares.values())
    return {
        s: (share / whole) * total / sizes[s] if sizes.get(s) else 0.0 for s, share in shares.items()
    }


def source_sizes(docs: DataFrame, weights: Mapping[str, float], source: str, text: str) -> dict:
    """Characters per named source, and of the rest under None; at most ``len(weights) + 1`` rows."""
    named = F.when(F.col(source).isin(list(weights)), F.col(source)) if weights else F.lit(None).cast("string")
    sized = docs.select(named.alias("s"), F.length(text_of(text)).cast("bigint").alias("n"))
    return {r["s"]: r["n"] for r in sized.groupBy("s").agg(F.sum("n").alias("n")).collect()}


def mix(
    docs: DataFrame, weights: Mapping[str, float], rest: float = 0.0, total: float | None = None, seed: int = 1,
    source: str = "source", text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """One row per copy with ``copy`` (from 0), ``rate`` and ``mix_key``, in global order of ``mix_key``.

    ``total``: characters of the mixture; as many as the input has, unless given.
    """
    sizes = source_sizes(docs, weights, source, text)
    means = rates(sizes, weights, rest, sum(sizes.values()) if total is None else total)
    kept = [c for c in docs.columns if c not in ADDED]
    key = F.col(doc_id)
    count, rate = _count(seed, key, means[None]), F.lit(means[None])
    for name in weights:
        count = F.when(F.col(source) == name, _count(seed, key, means[name])).otherwise(count)
        rate = F.when(F.col(source) == name, F.lit(means[name])).otherwise(rate)
    copies = (
        docs.select(*kept, rate.alias("rate"), count.alias("copy"))
        .where("copy > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copy") - 1)))
    )
    keyed = copies.withColumn("mix_key", _bits(seed + 1, key, F.col("copy")))
    return keyed.repartitionByRange("mix_key", doc_id, "copy").sortWithinPartitions("mix_key", doc_id, "copy")


def _count(seed: int, key: Column, mean: float) -> Column:
    """A Poisson draw: how many steps of the distribution function lie at or below a uniform number."""
    parts = max(1, math.ceil(mean / LARGEST_MEAN))
    steps = F.array(*[F.lit(p) for p in poisson_cdf(mean / parts)])
    below = lambda draw: F.size(F.filter(steps, lambda p: p <= draw))
    if parts == 1:
        return below(unit(seed, key))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(parts)), F.lit(0), lambda total, part: total + below(unit(seed, key, part))
    )

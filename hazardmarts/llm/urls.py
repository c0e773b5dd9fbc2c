"""URL filters: allow and block rules first, boosted trees on lexical features for the rest.

Rules name a host and a path. A rule fits its host and all subdomains when the url's path starts with the
rule's; the longest rule wins, then the first in alphabetical order. The rules are a list of the caller's and
become one CASE expression. URLs that a rule decides are the labelled ones: gradient-boosted trees learn from
them to tell block from allow by length, depth, digit ratio, entropy, parameter counts, hyphens and
smoothed label statistics of the host's last label. All of it is DataFrame expressions and MLlib's trees.

Null urls, and urls without ``://``, have an empty host and path and fit no rule; the trees judge
them by their features like any other. An empty path fits no rule path that starts with ``/``. Texts of any
length are read whole. Repeated rows are judged alike. If the labelled urls are all of one kind, that kind is
every verdict; without any labelled url, all others are allowed. Columns of the input are passed
through, except those with the names of added columns, which are replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import let, stored, text_of

# Bound of the labelled urls that the trees are fitted on; beyond it, they are a sample by hash.
MAX_LABELLED = 50_000
SMOOTHING = 20.0
TREES, DEPTH, STEP = 12, 4, 0.3
FEATURES = (
    "f_length", "f_host_length", "f_path_length", "f_depth", "f_labels", "f_digits", "f_host_digits", "f_hyphens",
    "f_params", "f_entropy", "f_host_entropy", "f_fragment", "f_extension", "f_suffix",
)
ADDED = ("host", "path", "rule", "verdict", "block_score")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        at = (host == rule.host) | host.endswith(f".{rule.host}")
        out = F.when(at & path.startswith(rule.path), F.lit(rule.name)).otherwise(out)
    return out


def entropy(text: Column) -> Column:
    """Bits per character; 0 for an empty text."""

    def of(pair: Column) -> Column:
        count, size = pair["n"], F.greatest(pair["size"], F.lit(1)).cast("double")
        return F.aggregate(count, F.lit(0.0), lambda a, n: a - (n / size) * F.log2(n / size))

    chars = F.array_remove(F.array_distinct(F.split(text, "")), "")
    counts = F.transform(chars, lambda c: F.length(text) - F.length(F.replace(text, c, F.lit(""))))
    return let(F.struct(counts.alias("n"), F.length(text).alias("size")), of)


def _count(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, f"(?s)[^{pattern}]", "")).cast("double")


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def features(urls: DataFrame, url: str, rates: DataFrame, prior: float) -> DataFrame:
    """The columns of ``FEATURES`` beside ``host`` and ``path``; none of them is null. Suffixes without
    labelled urls get the overall rate."""
    # Names of features are free, since the input's columns do not have them.
    right = rates.select(F.col("s").alias("f_labels"), F.col("rate").alias("f_suffix"))
    urls = urls.join(right, suffix_of(F.col("host")) == F.col("f_labels"), "left")
    full, host, path = text_of(url), F.col("host"), F.col("path")
    size = F.greatest(F.length(full), F.lit(1))
    rest = F.regexp_extract(full, "(?s)^[^?]*\\?([^#]*)", 1)
    columns = {
        "f_length": F.length(full).cast("double"),
        "f_host_length": F.length(host).cast("double"),
        "f_path_length": F.length(path).cast("double"),
        "f_depth": _count(path, "/"),
        "f_labels": _count(host, "."),
        "f_digits": _count(full, "0-9") / size,
        "f_host_digits": _count(host, "0-9"),
        "f_hyphens": _count(host, "-"),
        "f_params": _count(rest, "="),
        "f_entropy": entropy(full),
        "f_host_entropy": entropy(host),
        "f_fragment": F.contains(full, F.lit("#")).cast("double"),
        "f_extension": F.length(F.regexp_extract(path, "\\.([A-Za-z0-9]{1,5})$", 1)).cast("double"),
        "f_suffix": F.coalesce("f_suffix", F.lit(prior)),
    }
    return urls.withColumns({name: columns[name] for name in FEATURES})


def suffix_rates(labelled: DataFrame) -> tuple[DataFrame, float]:
    """Smoothed share of blocked urls for every suffix, as rows (s, rate), and overall. The counts cover all
    labelled urls."""
    total = labelled.agg(F.avg("label").alias("rate")).first()["rate"]
    prior = 0.5 if total is None else float(total)
    counts = labelled.groupBy(suffix_of(F.col("host")).alias("s")).agg(F.count("*").alias("n"), F.sum("label").alias("bad"))
    rate = (F.col("bad") + F.lit(SMOOTHING * prior)) / (F.col("n") + F.lit(SMOOTHING))
    return stored(counts.select("s", rate.alias("rate")), "url-suffixes"), prior


def classify(urls: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """The input with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score`` (0 to 1)."""
    kept = [c for c in urls.columns if c not in {*ADDED, *FEATURES}]
    if url not in kept:
        raise ValueError(f"the url column must not be called {url}")
    by_name = {r.name: r.verdict for r in rules}
    full = text_of(url)
    parts = urls.select(*kept, host_of(full).alias("host"), path_of(full).alias("path"))
    ruled = parts.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.col("rule").isin([n for n, v in by_name.items() if v == "block"])
    labelled = ruled.where(F.col("rule").isNotNull()).select(
        F.col(url), "host", "path", F.when(blocked, 1.0).otherwise(0.0).alias("label")
    )
    counts = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    by_rule = F.when(blocked, "block").otherwise("allow")
    if len(counts) < 2:
        constant = float(next(iter(counts), 0.0))
        scored = ruled.withColumn("block_score", F.lit(constant))
    else:
        rates, prior = suffix_rates(labelled)
        share = min(1.0, MAX_LABELLED / sum(counts.values()))
        chosen = labelled.where(F.pmod(F.xxhash64(url), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="f_vector")
        train = vector.transform(features(chosen, url, rates, prior).orderBy(*FEATURES, "label"))
        train = train.select("f_vector", "label")
        trees = GBTClassifier(
            featuresCol="f_vector", labelCol="label", predictionCol="f_predicted", maxIter=TREES, maxDepth=DEPTH,
            stepSize=STEP, seed=1,
        )
        trees = trees.setRawPredictionCol("f_raw").setProbabilityCol("f_probability")
        fitted = trees.fit(stored(train, "url-training"))
        judged = fitted.transform(vector.transform(features(ruled, url, rates, prior)))
        scored = judged.withColumn("block_score", vector_to_array("f_probability")[1])
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    verdict = F.when(F.col("rule").isNotNull(), by_rule).otherwise(learned)
    return scored.select(*kept, "host", "path", "rule", verdict.alias("verdict"), "block_score")

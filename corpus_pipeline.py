"""A training corpus from raw documents, in stages that are each written and read again.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of ``documents``; the last one
returns the copies of the mixture. A stage decides on all rows that its predecessor kept. Null and empty
texts, ties, repeated rows and further columns are treated as the operators' docstrings say: null
texts count as empty and are rejected as short. An empty table passes through all stages empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hazardmarts.llm import decontam, jaccard, mixing, quality, toxicity
from hazardmarts.llm.common import stored, table
from hazardmarts.llm.queries import MIX_REST, MIX_WEIGHTS, TOXIC_LIMIT, toxicity_model

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.judge(docs).where("q_kept").select(*docs.columns)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity limit; the model is fitted on the labelled raw documents."""
    return toxicity.split_clean(docs, toxicity_model(spark, sf_dir), TOXIC_LIMIT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents whose word 5-grams overlap by 0.8 or more."""
    return jaccard.one_per_class(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: one row per copy, in global random order."""
    return mixing.mix(docs, MIX_WEIGHTS, MIX_REST)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("toxicity", non_toxic),
    ("ngram_jaccard", near_duplicates),
    ("benchmark_decontamination", benchmark_free),
    ("mix_sources", mix_sources),
]
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

``measures`` adds the counts the rules look at. ``plan_cascade`` estimates on a sample how many
rows each rule rejects and what it costs, and orders the rules by rejections per cost; ``cascade``
then evaluates them in that order as one CASE, which stops at the first rule that rejects. The
order changes the cost and the named reason, never the verdict.

Null texts count as empty. An empty text has all counts 0 and is rejected by the length rule. A text
of any length is measured whole; the work per text is n log n of its words. Repeated rows are judged
alike, each on its own. Columns of the input are passed through; the added ones start with ``q_``,
and input columns with such names are replaced. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import SPACE_RUN, SPACES, let, split_words, stored, text_of

# Rows that estimate cost and selectivity; verdicts do not depend on them.
SAMPLE_ROWS = 2000
MEASURES = ("q_words", "q_word_chars", "q_symbols", "q_dup_lines", "q_repeat_words", "q_lines")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a boolean expression over the text column and the measures."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    rejected: float
    seconds: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def _repeat_words(windows: Column) -> Column:
    """Words inside windows of three that occur twice or more.

    Windows are compared by 64-bit hash, with their positions sorted by hash: equal neighbours are
    repeats. A repeated window covers three words, less those that the one before it covers.
    """

    def covered(ordered: Column) -> Column:
        last = F.size(ordered) - 1
        repeats = F.filter(
            ordered,
            lambda x, i: ((i > 0) & (F.get(ordered, i - 1)["h"] == x["h"]))
            | ((i < last) & (F.get(ordered, i + 1)["h"] == x["h"])),
        )
        places = F.sort_array(F.transform(repeats, lambda x: x["i"]))
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("total"))
        return F.aggregate(
            places, start,
            lambda a, p: F.struct(p.alias("last"), (a["total"] + F.least(p - a["last"], F.lit(3))).alias("total")),
            lambda a: a["total"],
        )

    placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    # Most texts repeat nothing; they are told by a hash set, without sorting.
    return F.when(
        F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")
    ).otherwise(let(F.sort_array(placed), covered))


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the columns of ``MEASURES``, all long."""
    kept = [c for c in docs.columns if c not in {*MEASURES, "q_w", "q_h", "q_l"}]
    body = text_of(text)

    def hashed(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 3)
        hashes = F.transform(
            starts, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
        )
        return F.when(F.size(words) < 3, F.array().cast("array<bigint>")).otherwise(hashes)

    with_word = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    words = let(
        split_words(body),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.length(F.array_join(w, "")).alias("chars"),
            let(hashed(w), _repeat_words).alias("repeats"),
        ),
    )
    lines = let(with_word, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    symbols = F.length(F.regexp_replace(body, "[^#*$%&|<>]+", ""))
    staged = docs.select(*kept, words.alias("q_w"), lines.alias("q_l"), symbols.alias("q_h"))
    return staged.select(
        *kept,
        F.col("q_w.n").cast("bigint").alias("q_words"),
        F.col("q_w.chars").cast("bigint").alias("q_word_chars"),
        F.col("q_h").cast("bigint").alias("q_symbols"),
        (F.col("q_l.n") - F.col("q_l.d")).cast("bigint").alias("q_dup_lines"),
        F.col("q_w.repeats").cast("bigint").alias("q_repeat_words"),
        F.col("q_l.n").cast("bigint").alias("q_lines"),
    )


def base_failed() -> Column:
    return (F.col("q_words") < 50) | (100 * F.col("q_repeat_words") > 50 * F.col("q_words"))


def default_rules(text: str = "text") -> list[Rule]:
    """Thresholds in whole numbers, so that no rule depends on floating point."""
    body = text_of(text)
    upper = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    letters = F.length(F.regexp_replace(body, "[^A-Za-z]+", ""))
    return [
        Rule("short", F.col("q_words") < 50),
        Rule("repeats", 100 * F.col("q_repeat_words") > 50 * F.col("q_words")),
        Rule("short_words", F.col("q_word_chars") < 2 * F.col("q_words")),
        Rule("long_words", F.col("q_word_chars") > 15 * F.col("q_words")),
        Rule("symbols", 10 * F.col("q_symbols") > F.col("q_words")),
        Rule("dup_lines", 10 * F.col("q_dup_lines") > 4 * F.col("q_lines")),
        Rule("shouting", 2 * upper > letters),
    ]


def sampled(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """About ``rows`` rows for the estimates, stored. The size of the table is counted, not guessed."""
    total = docs.select(F.lit(1)).count()
    return stored(docs.sample(min(1.0, rows / max(total, 1)), seed=7), "quality-sample")


def plan_cascade(sample: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """The rules with most rejections per second of work first; names settle ties.

    One pass counts what each rule rejects. Each rule is then timed over the sample, and the time of
    a pass that reads the same rows without a rule is taken off.
    """
    counts = sample.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.coalesce(r.rejects, F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)],
    ).first()

    def seconds(column: Column) -> float:
        started = time.perf_counter()
        sample.agg(F.count_if(F.coalesce(column, F.lit(False)))).collect()
        return time.perf_counter() - started

    columns = F.xxhash64(*sample.columns) == 0 if sample.columns else F.lit(False)
    seconds(columns)
    idle = seconds(columns)
    found = [
        Estimate(r, counts[f"r{i}"] / max(counts["n"], 1), max(seconds(r.rejects) - idle, 1e-3))
        for i, r in enumerate(rules)
    ]
    return sorted(found, key=lambda e: (-e.gain, e.rule.name))


def cascade(docs: DataFrame, ordered: Sequence[Rule]) -> DataFrame:
    """Adds ``q_reason``, the first rule that rejects (null: none), and ``q_kept``."""
    reason = F.lit(None).cast("string")
    for rule in reversed(ordered):
        reason = F.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name)).otherwise(reason)
    kept = [c for c in docs.columns if c not in {"q_reason", "q_kept"}]
    return docs.select(*kept, reason.alias("q_reason")).withColumn("q_kept", F.col("q_reason").isNull())


def judge(docs: DataFrame, text: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """Measures and verdict of every row, with the cascade planned on a sample of the rows."""
    chosen = list(rules or default_rules(text))
    sample = measures(sampled(docs.select(F.col(text).alias(text))), text)
    order = [e.rule for e in plan_cascade(sample, chosen)]
    return cascade(measures(docs, text), order)

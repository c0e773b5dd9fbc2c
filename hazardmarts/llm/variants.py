"""Spelling variants: words one edit apart, found by pivotal grams, and the commonest form of each.

1. Words are counted over all texts. Bigrams of words are counted in a table of fixed size, by hash, which orders them from rare to
   common, the same way in every task.
2. The *prefix* of a word is its three rarest bigrams, with every place of the third. Among them a small dynamic programme picks
   the two *pivots*: disjoint bigrams of least total count. One edit spoils at most one of two disjoint bigrams, so of
   two words an edit apart, the one whose prefix ends first has a pivot that the other holds, and holds in its prefix.
3. Pivots are the index, prefixes the queries. Position limits are part of the key: beside a pivot that is left whole, the edit is
   to its right, so the words agree from their start through the pivot, or to its left, so they agree from the pivot to the end. In
   the part that holds the edit, one of two halves agrees too, where the halves follow from the shorter of the two parts. So
   a bucket holds few words, whatever the size of the vocabulary, and hardly grows with it.
4. Words that meet are verified by edit distance. Pairs leave the join only when verified. Tables of words and keys are joined by
   merging and never broadcast: their files are compressed and a word has many keys, so their sizes are estimated far too low.
5. A word's form is its near word of largest count, if that is at least ``times`` its own. Counts grow along forms, so following them
   ends; roots are found by doubling the step, a written table at a time.

Words longer than ``LONG`` have up to as many prefix bigrams, with keys as long as themselves; they meet by equal halves instead, exactly, and words
at that length by both ways.

Null texts have no words, empty ones neither. A null id counts as an empty string. Repeated rows count again. Texts and words of any length are
read whole. Ties of largest count go to the first word in code-point order. Only the id and text columns are read,
so further columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import stored

RUN = "[A-Za-zÀ-ÿ]+"
# Entries of the table of bigram counts: its size does not depend on the alphabet or the vocabulary.
BUCKETS = 1 << 16
LONG = 256
FLUSH_ROWS = 100_000
KEYS = pa.schema([("key", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("last", pa.int64())])
KEYS_DDL = "key string, word string, n bigint, last bigint"


def bucket(gram: str) -> int:
    return (((ord(gram[0]) << 21 | ord(gram[1])) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> 48


def typed_words(docs: DataFrame, typo_every: int) -> DataFrame:
    """Every run of letters in lower case (A-Z only), as ``word``; where ``typo_every`` divides the checksum of id and
    run, without one of its characters."""
    lower = F.translate(F.col("text").cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower, F.lit(RUN.replace("A-Z", "")), F.lit(0))).alias("run"),
    )
    marked = runs.withColumn("mark", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    place = (F.col("mark") % F.length("run")).cast("int")
    spoiled = F.concat(F.col("run").substr(F.lit(1), place), F.col("run").substr(place + 2, F.length("run")))
    return marked.select(F.when(F.col("mark") % typo_every == 0, spoiled).otherwise(F.col("run")).alias("word"))


def count_words(words: DataFrame, min_chars: int, min_count: int) -> DataFrame:
    """(word, n) of the words that are long and frequent enough, stored."""
    counted = words.where(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return stored(counted.where(F.col("n") >= min_count), "variant-words")


def gram_order(words: DataFrame) -> np.ndarray:
    """The place of every bucket of bigrams, from rare to common."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, int] = {}
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for word in batch.column("word").to_pylist():
                for gram in {word[i : i + 2] for i in range(len(word) - 1)}:
                    total[gram] = total.get(gram, 0) + 1
            if len(total) > 4 * BUCKETS:
                _add(counts, total)
        _add(counts, total)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["bucket", "n"])

    parts = words.select("word").mapInArrow(count, "bucket bigint, n bigint")
    counts = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[row["bucket"]] = row["n"]
    order = np.empty(BUCKETS, np.int64)
    order[np.lexsort([np.arange(BUCKETS), counts])] = np.arange(BUCKETS)
    return order


def _add(counts: np.ndarray, total: dict[str, int]) -> None:
    for gram, n in total.items():
        counts[bucket(gram)] += n
    total.clear()


class Grams:
    """Prefixes and pivots of words, under one order of all bigrams."""

    def __init__(self, order: Sequence[int]) -> None:
        self.order, self.known = order, {}

    def rank(self, gram: str) -> int:
        found = self.known.get(gram)
        if found is None:
            if len(self.known) >= 16 * BUCKETS:
                self.known.clear()
            found = self.known[gram] = int(self.order[bucket(gram)]) << 42 | ord(gram[0]) << 21 | ord(gram[1])
        return found

    def prefix(self, word: str) -> tuple[int, list[tuple[int, int]]]:
        """The rank of the third rarest bigram, and (rank, place) of all bigrams up to it."""
        ranked = sorted((self.rank(word[i : i + 2]), i) for i in range(len(word) - 1))
        last = ranked[2][0]
        return last, [g for g in ranked if g[0] <= last]

    def pivots(self, prefix: Sequence[tuple[int, int]]) -> tuple[int, int]:
        """Places of two disjoint bigrams of least total place in the order, by one pass from left to right."""
        placed = sorted((place, rank >> 42) for rank, place in prefix)
        free, behind, best = 0, None, None
        for place, cost in placed:
            while placed[free][0] <= place - 2:
                behind = min(behind or (placed[free][1], placed[free][0]), (placed[free][1], placed[free][0]))
                free += 1
            if behind is not None and (best is None or behind[0] + cost < best[0]):
                best = (behind[0] + cost, behind[1], place)
        return best[1], best[2]


def halves(part: str, side: str) -> Iterator[str]:
    """Keys of a part that holds one edit: with the length of the shorter of both parts, and the half that agrees."""
    for short in {max(len(part) - 1, 0), len(part)}:
        half = short // 2
        yield f"{side}{short}<{part[:half]}"
        if half:
            yield f"{side}{short}>{part[len(part) - (short - half):]}"


def keys_of(word: str, places: Sequence[int]) -> Iterator[str]:
    """Keys under which the word meets others that share one of its bigrams at these places."""
    for place in places:
        for key in halves(word[place + 2 :], "<"):
            yield f"{word[: place + 2]}\n{key}"
        for key in halves(word[:place], ">"):
            yield f"{word[place:]}\n{key}"


def keyed(words: DataFrame, order: np.ndarray, index: bool) -> DataFrame:
    """(key, word, n, last) of all words: their pivots as ``index``, else their prefixes."""
    table = words.sparkSession.sparkContext.broadcast(order.tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(table.value)
        for batch in batches:
            found: list[list[object]] = [[], [], [], []]
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                if len(word) <= LONG + 1:
                    last, prefix = grams.prefix(word)
                    places = grams.pivots(prefix) if index else [place for _, place in prefix]
                    keys = list(keys_of(word, places))
                    _append(found, keys, word, n, last)
                if len(word) >= LONG:
                    _append(found, list(halves(word, "=")), word, n, 0)
                if len(found[0]) >= FLUSH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, KEYS)], schema=KEYS)
                    found = [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(found, KEYS)], schema=KEYS)

    # Words that meet are compared whole, so a clash of key hashes costs a comparison and nothing else.
    return words.mapInArrow(run, KEYS_DDL).select(F.xxhash64("key").alias("key"), "word", "n", "last")


def _append(found: list[list[object]], keys: list[str], word: str, n: int, last: int) -> None:
    for column, values in zip(found, (keys, [word] * len(keys), [n] * len(keys), [last] * len(keys))):
        column.extend(values)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, near_n): both directions of every pair of words that differ by one edit, from (word, n)."""
    order = gram_order(words)
    pivots, prefixes = keyed(words, order, index=True).alias("p"), keyed(words, order, index=False).alias("q")
    meets = (F.col("p.key") == F.col("q.key")) & (F.col("p.last") <= F.col("q.last"))
    near = F.levenshtein(F.col("p.word"), F.col("q.word"), 1) == 1
    pairs = pivots.join(prefixes.hint("merge"), meets & near).select(F.explode(F.array(_pair("p", "q"), _pair("q", "p"))).alias("x"))
    return pairs.select("x.*").distinct()


def _pair(one: str, other: str) -> Column:
    return F.struct(F.col(f"{one}.word").alias("word"), F.col(f"{other}.word").alias("near"), F.col(f"{other}.n").alias("near_n"))


def forms(words: DataFrame, near: DataFrame, times: int) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word, stored."""
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    )
    found = words.join(best.hint("merge"), "word", "left")
    strong = -F.col("best.m") >= times * F.col("n")
    return stored(
        found.select(
            "word", "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(strong, F.col("best.near")).alias("form"),
            F.when(strong, -F.col("best.m")).alias("form_n"),
        ),
        "variant-forms",
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: each round follows twice as many forms as the one before.

    A form has at least twice the count of its word, so 64-bit counts allow 63 steps, which is seven rounds.
    """
    steps = stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = steps.join(onward.hint("merge"), "root", "left")
        steps = stored(
            joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "variant-roots",
        )
        if not steps.where("moved").limit(1).count():
            return steps.drop("moved")
        steps = steps.drop("moved")


def spelling_variants(
    docs: DataFrame, typo_every: int = 97, min_chars: int = 5, min_count: int = 3, times: int = 2
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs`` (doc_id, text); words have five characters at least,
    so that they hold the three bigrams of a prefix."""
    if min_chars < 5 or times < 2:
        raise ValueError("words need five characters, and forms twice the count of their words")
    words = count_words(typed_words(docs, typo_every), min_chars, min_count)
    formed = forms(words, near_words(words), times)
    rooted = formed.join(roots(formed).hint("merge"), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

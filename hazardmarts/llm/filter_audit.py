"""Filter interaction audit: what every filter removes in every order, from one pass over the texts.

A document's failures are one bit mask. Rows are counted by part and mask, so what remains of any
table is at most ``2 ** filters`` cells per part. ``walk`` then visits all subsets of filters in Gray-code
order: each step toggles one filter, which changes the number of active failures of the cells that
fail it; a cell whose counter leaves 0 drops out of the survivors, one that returns to 0 joins them again. The
survivors of all subsets are stored, and every step of every order is a difference of two of them.

A filter may judge a row by itself (``fails``), or be the one that removes repeated texts (``fails`` None): a
row fails it if an equal text has a smaller id anywhere in the table. Equal texts agree in all other
filters, so rows are counted by text, part and id before texts meet; a group of copies of any size comes
together as one row per part and label.

Null texts count as empty, and so equal empty ones; a null part counts as the empty string. A row with a
null id repeats any equal text that has an id, but is never the reason why another one fails. Rows with the same id and
text fail alike: neither is smaller. Several labels of one id are merged: it is good or toxic if any says so;
labels without an id or without a document are ignored. Only the named columns are read, so further ones cannot clash. An empty
table has no parts and gives no rows. Texts of any length are judged whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.common import let, split_words, text_of

# Subsets and orders are enumerated; beyond this the orders of a part alone are too many.
MAX_FILTERS = 6
COUNTS = ("n", "good", "toxic")
STEPS = pa.schema([
    ("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
    *[(c, pa.int64()) for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")],
])
STEPS_DDL = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


@dataclass(frozen=True)
class Filter:
    """A filter named by one letter. ``fails`` is a boolean over ``a_text``, ``a_words`` (the number of words) and
    ``a_distinct`` (of different ones); None: the text repeats that of a smaller id."""

    letter: str
    fails: Column | None


def default_filters() -> list[Filter]:
    """Thresholds in whole numbers, so that no filter depends on floating point."""
    capitals = F.length(F.regexp_replace("a_text", "[^A-Z]+", ""))
    return [
        Filter("A", F.col("a_words") < 50),
        Filter("B", 100 * F.col("a_distinct") < 65 * F.col("a_words")),
        Filter("C", 100 * capitals.cast("bigint") > 5 * F.length("a_text").cast("bigint")),
        Filter("D", F.col("a_text").rlike(r"[#$%&*|]")),
        Filter("E", None),
    ]


def failures(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter]) -> DataFrame:
    """Counts of rows by (part, mask): ``n``, ``good`` and ``toxic``; bit i of the mask is filter i.

    ``docs`` has doc_id, text and source, ``labels`` doc_id, quality and toxic.
    """
    bit = {f.letter: 1 << i for i, f in enumerate(filters)}
    repeats = sum(bit[f.letter] for f in filters if f.fails is None)
    own = sum((F.when(F.coalesce(f.fails, F.lit(False)), bit[f.letter]).otherwise(0) for f in filters if f.fails is not None), F.lit(0))
    words = let(split_words(F.col("a_text")), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    judged = (
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_of().alias("a_text"))
        .withColumn("a_w", words)
        .withColumns({"a_words": F.col("a_w.n").cast("bigint"), "a_distinct": F.col("a_w.d").cast("bigint")})
        .select("doc_id", "part", own.cast("int").alias("own"), F.unhex(F.sha2("a_text", 256)).alias("same"))
    )
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("is_good"),
        F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("is_toxic"),
    )
    seen = judged.join(marks, "doc_id", "left").fillna(False, ["is_good", "is_toxic"])
    kind = ["same", "part", "own", "is_good", "is_toxic"]
    by_id = seen.groupBy(*kind, "doc_id").agg(F.count("*").alias("n"))
    # Rows that hold the smallest id of their kind, and all rows of the kind; nulls come last.
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    by_kind = by_id.groupBy(*kind).agg(first.alias("first"), F.sum("n").alias("n"))
    least = by_kind.groupBy(F.col("same")).agg(F.min("first.doc_id").alias("least"))
    joined = by_kind.join(least, "same")
    held = F.coalesce(F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")), F.lit(0))
    # Where no copy has an id, none is smaller.
    clean = F.when(F.col("least").isNull(), F.col("n")).otherwise(held)
    split = joined.select(
        "part", "is_good", "is_toxic",
        F.explode(F.array(
            F.struct(F.col("own").alias("mask"), clean.alias("n")),
            F.struct(F.col("own").bitwiseOR(F.lit(repeats)).alias("mask"), (F.col("n") - clean).alias("n")),
        )).alias("cell"),
    )
    return split.groupBy("part", F.col("cell.mask").alias("mask")).agg(
        F.sum("cell.n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("cell.n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("cell.n")).otherwise(0)).alias("toxic"),
    )


def walk(cells: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters, from the counts of every mask; the last axis is the mask.

    Gray-code order: subset number i is i ^ (i >> 1), so neighbours differ in one filter.
    """
    states = 1 << filters
    masks = np.arange(states)
    active = np.zeros(states, np.int8)
    alive = cells.sum(axis=-1)
    survivors = np.empty_like(cells)
    survivors[..., 0] = alive
    subset = 0
    for i in range(1, states):
        gray = i ^ (i >> 1)
        toggled = gray ^ subset
        hit = masks[masks & toggled != 0]
        if gray & toggled:
            alive = alive - cells[..., hit[active[hit] == 0]].sum(axis=-1)
            active[hit] += 1
        else:
            active[hit] -= 1
            alive = alive + cells[..., hit[active[hit] == 0]].sum(axis=-1)
        subset = gray
        survivors[..., subset] = alive
    return survivors


def steps(cells: np.ndarray, letters: Sequence[str]) -> dict[str, np.ndarray]:
    """All counts of all orders and steps, each of shape (parts, orders x steps); cells: (parts, counts, masks)."""
    k = len(letters)
    survivors = walk(cells, k)
    orders = np.array(list(permutations(range(k))))
    after = np.cumsum(1 << orders, axis=1)
    before = after - (1 << orders)
    lost = survivors[:, :, before] - survivors[:, :, after]
    masks = np.arange(1 << k)
    failing = np.stack([cells[:, 0, masks >> f & 1 == 1].sum(axis=1) for f in range(k)], axis=1)
    removed = lost[:, 0]
    shapley = np.stack([removed[:, orders == f].sum(axis=1) for f in range(k)], axis=1)
    found = {
        "kept": survivors[:, 0][:, after],
        "removed": removed,
        "redundant": failing[:, orders] - removed,
        "unique_fails": cells[:, 0][:, 1 << orders],
        "good_lost": lost[:, 1],
        "toxic_lost": lost[:, 2],
        "shapley": shapley[:, orders],
    }
    return {name: values.reshape(len(cells), -1) for name, values in found.items()}


def audit(docs: DataFrame, labels: DataFrame, filters: Sequence[Filter] | None = None) -> DataFrame:
    """One row per part, order of all filters and step; see the module's text for the counts."""
    chosen = list(default_filters() if filters is None else filters)
    letters = [f.letter for f in chosen]
    if not 1 <= len(chosen) <= MAX_FILTERS or len(set(letters)) != len(letters):
        raise ValueError(f"give 1 to {MAX_FILTERS} filters with different letters")
    states, k = 1 << len(chosen), len(chosen)
    names = ["".join(letters[f] for f in order) for order in permutations(range(k))]
    per_part = len(names) * k

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = pa.array(np.repeat(names, k).tolist(), pa.string())
        places = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(names)))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                piece = batch.slice(at, 64)
                cells = np.zeros((piece.num_rows, len(COUNTS), states), np.int64)
                for row, found in enumerate(piece.column("cells").to_pylist()):
                    for c in found:
                        cells[row, :, c["mask"]] = [c[name] for name in COUNTS]
                counted = steps(cells, letters)
                for row, part in enumerate(piece.column("part").to_pylist()):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part] * per_part, pa.string()), orders, places,
                         *[pa.array(counted[c.name][row]) for c in list(STEPS)[3:]]], schema=STEPS,
                    )

    # At most 2 ** filters cells per part come together.
    gathered = failures(docs, labels, chosen).groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("cells"))
    return gathered.mapInArrow(expand, STEPS_DDL)

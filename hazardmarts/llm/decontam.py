"""Benchmark decontamination: word pairs find passages, Smith-Waterman alignment scores them.

The test items are taken in shards of bounded text, each broadcast to all tasks; the documents are scanned once
per shard. A seed is a pair of words at most two places apart, in the item and in the document. Where a local
alignment steps from one equal word to the next at the cost of at most one edit, both hold such a pair, and an
alignment that reaches the threshold has at least threshold x words - 1 such steps, since every other step costs
two. So a document is aligned with an item where that many of its places, within the longest passage that can
reach the threshold, begin a pair of the item. No case that a full alignment would find is lost. Pairs that many
items share are not looked up, rarest kept first, as long as an item can spare them: each one left out lowers
the number of hits that the item needs by one. A hit stands for all of the document that an alignment through it
can reach; what overlaps is aligned together with the item, word by word, allowing replaced, inserted and
dropped words. The score is the best local alignment over that of the whole item with itself.

Words are lower-cased runs of ASCII letters and digits and non-ASCII characters. Items of fewer than
``SHORT`` words are matched whole only; any other needs one seed at least, also below a threshold of 1 / SHORT.
Null and empty texts and items match nothing. Texts are scanned whole. Repeated rows are judged
alike; items with equal texts are all reported. Rows with a null id are reported with that null id.
Only the named columns are read, so further columns cannot clash. Empty tables give an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardmarts.llm.arrays import LOWER, WordHashes, mix64, rolling
from hazardmarts.llm.common import Carried, text_of

SHORT = 4
THRESHOLD = 0.5
# Items that may share a pair before it is left out where it can be spared, and hits held at once.
SHARED = 32
HELD = 1 << 20
# Characters of items per shard: the bound of what is collected and broadcast at once.
SHARD_CHARS = 8 << 20
# Alignment scores per word: equal, replaced, inserted or dropped. ``Items`` counts seeds by them.
MATCH, MISMATCH, GAP = 2, -1, -1

_FIRST = np.uint64(0x9E3779B97F4A7C15)
# ASCII but letters and digits lies between words.
_APART = np.array([b < 128 and not (chr(b).isalnum()) for b in range(256)])
# Least and greatest size of the table that tells most pairs of the corpus from those of the items, as powers of two.
TABLE_BITS = 20, 24

HIT = pa.schema([
    ("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()),
])
HIT_DDL = "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint"


def lowered(text: Column) -> Column:
    return F.lower(text).cast("binary")


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two id arrays: its score, and the first and one past the last window word.

    Rows are computed at once: a gap within a row is a running maximum, since gaps cost the same per word.
    """
    n = len(window)
    steps = np.arange(n + 1) * -GAP
    score = np.zeros(n + 1, dtype=np.int64)
    start = np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        through = score[:-1] + np.where(window == word, MATCH, MISMATCH)
        drop = score[1:] + GAP
        row = np.maximum(np.maximum(through, drop), 0)
        origin = np.where(row == 0, np.arange(1, n + 1), np.where(through >= drop, start[:-1], start[1:]))
        lifted = np.concatenate([[0], row]) + steps
        top = np.maximum.accumulate(lifted)
        from_left = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        score = top - steps
        start = np.concatenate([[0], origin])[from_left]
        at = int(score.argmax())
        if score[at] > best[0]:
            best = (int(score[at]), int(start[at]), at)
    return best


def apart(words: np.ndarray, distance: int) -> np.ndarray:
    """Hashes of all pairs of words ``distance`` places apart, alike for all distances."""
    return mix64(words[:-distance] * _FIRST + words[distance:])


def whole(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, other than those of pairs."""
    return mix64(rolling(words, width) + np.uint64(width))


class Items:
    """The distinct items of one shard as arrays of word hashes, and the seeds that stand for them."""

    def __init__(self, rows: list[tuple[int | None, bytes]], threshold: float) -> None:
        with np.errstate(over="ignore"):
            hashes, number = WordHashes(LOWER, _APART).of(pa.array([r[1] for r in rows], pa.binary()))
            ids: dict[bytes, list[int | None]] = defaultdict(list)
            if rows:
                for (i, _), words in zip(rows, np.split(hashes, np.searchsorted(number, np.arange(1, len(rows)))), strict=True):
                    ids[words.tobytes()].append(i)
            ids.pop(b"", None)
            self.ids = list(ids.values())
            self.words = [np.frombuffer(w, np.uint64) for w in ids]
            sizes = np.array([len(w) for w in self.words], np.int64)
            # An alignment at the threshold has so many steps with a seed, and at most so many words.
            self.need = np.maximum(np.ceil(threshold * sizes - 1 - 1e-9), 1).astype(np.int64)
            self.reach = np.ceil((3 - 2 * min(threshold, 1.0)) * sizes).astype(np.int64)
            self.need[sizes < SHORT] = 1
            self.widths = sorted({int(n) for n in sizes if n < SHORT})
            self._index(sizes)

    def _index(self, sizes: np.ndarray) -> None:
        keys, owner, start = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for item, words in enumerate(self.words):
            found = [apart(words, 1), apart(words, 2)] if sizes[item] >= SHORT else [whole(words, len(words))]
            keys += found
            owner += [np.full(len(k), item) for k in found]
            start += [np.arange(len(k)) for k in found]
        keys, owner, start = np.concatenate(keys), np.concatenate(owner), np.concatenate(start)
        _, number = np.unique(keys, return_inverse=True)
        each = np.unique(number * max(len(sizes), 1) + owner)
        sharing = np.bincount(each // max(len(sizes), 1))[number]
        # A place begins two pairs; the one that more items share decides. The most shared places come first.
        places = np.concatenate([[0], np.cumsum(sizes)])
        at = places[owner] + start
        most = np.zeros(places[-1], np.int64)
        np.maximum.at(most, at, sharing)
        of_place = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((-most, of_place))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order)) - places[of_place[order]]
        spared = (most > SHARED) & (rank < self.need[of_place] - 1)
        self.need -= np.bincount(of_place[spared], minlength=len(sizes))
        kept = ~spared[at]
        pairs = np.unique(np.stack([keys[kept], owner[kept].astype(np.uint64)]), axis=1)
        self.known, first = np.unique(pairs[0], return_index=True)
        self.owners = pairs[1].astype(np.int64)
        self.offsets = np.append(first, len(self.owners))
        self.bits = np.uint64(64 - min(max(TABLE_BITS[0], len(self.known).bit_length() + 3), TABLE_BITS[1]))
        self.table = np.zeros(1 << (64 - int(self.bits)), dtype=bool)
        self.table[self.known >> self.bits] = True

    def scan(self, words: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a row of documents, in order, and numbers among ``known``, of all seeds."""
        places, numbers = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        looked = [(d + 1, lambda d=d: apart(words, d)) for d in (1, 2)]
        looked += [(n, lambda n=n: whole(words, n)) for n in self.widths]
        for width, hashes in looked:
            if len(words) < width:
                continue
            keys = hashes()
            maybe = np.flatnonzero(self.table[keys >> self.bits])
            # A seed must be known and lie within one document.
            maybe = maybe[number[maybe] == number[maybe + width - 1]]
            at = np.minimum(np.searchsorted(self.known, keys[maybe]), len(self.known) - 1)
            hit = self.known[at] == keys[maybe]
            places.append(maybe[hit])
            numbers.append(at[hit])
        places, numbers = np.concatenate(places), np.concatenate(numbers)
        order = np.argsort(places, kind="stable")
        return places[order], numbers[order]

    def hits(self, row: np.ndarray, places: np.ndarray, numbers: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """(row, item, place) of the hits in parts of about ``HELD``; all hits of a row and item are in one part."""
        fans = self.offsets[numbers + 1] - self.offsets[numbers]
        before = np.cumsum(fans) - fans
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]][: len(row)])
        part = before[starts] // HELD
        cuts = np.append(starts[np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])], len(row))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            pieces = int(fans[low:high].sum()) // (2 * HELD) + 1
            # One row may hold more: then its items are taken in turns, a slice of the hits at a time.
            for turn in range(pieces):
                found = []
                slices = np.searchsorted(before[low:high] - before[low], np.arange(0, pieces + 1) * 2 * HELD) + low
                slices[-1] = high
                for a, b in zip(slices[:-1], slices[1:], strict=True):
                    fan = fans[a:b]
                    within = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
                    item = self.owners[np.repeat(self.offsets[numbers[a:b]], fan) + within]
                    mine = item % pieces == turn
                    found.append((np.repeat(row[a:b], fan)[mine], item[mine], np.repeat(places[a:b], fan)[mine]))
                yield tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def windows(self, row: np.ndarray, item: np.ndarray, place: np.ndarray) -> Iterator[tuple[int, int, list[list[int]]]]:
        """(row, item, ranges of places) wherever the hits suffice for the threshold; ranges that touch are one."""
        order = np.lexsort((place, item, row))
        row, item, place = row[order], item[order], place[order]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (place[1:] != place[:-1])
        row, item, place = row[new], item[new], place[new]
        last = np.arange(len(row)) + self.need[item] - 1
        end = np.minimum(last, len(row) - 1)
        enough = (last < len(row)) & (row[end] == row) & (item[end] == item) & (place[end] - place < self.reach[item])
        at = np.flatnonzero(enough)
        low, high = place[end[at]] - self.reach[item[at]], place[at] + self.reach[item[at]] + 1
        ranges: list[list[int]] = []
        mine = None
        for r, i, a, b in zip(row[at].tolist(), item[at].tolist(), low.tolist(), high.tolist(), strict=True):
            if (r, i) != mine:
                if mine:
                    yield *mine, ranges
                mine, ranges = (r, i), [[a, b]]
            elif a <= ranges[-1][1]:
                ranges[-1][1] = max(ranges[-1][1], b)
            else:
                ranges.append([a, b])
        if mine:
            yield *mine, ranges


def _matches(batch: pa.RecordBatch, items: Items, hashes: WordHashes, threshold: float):
    """(row, item, score, first word, last word) of every item that a document of a batch holds."""
    for first, _, words, number in hashes.parts(batch.column("text")):
        places, numbers = items.scan(words, number)
        for hits in items.hits(number[places], places, numbers):
            for row, item, ranges in items.windows(*hits):
                start, end = np.searchsorted(number, [row, row + 1])
                target, found = items.words[item], []
                for low, high in ranges:
                    low = max(low, start)
                    score, begin, stop = align(target, words[low : min(high, end)])
                    found.append((score / (MATCH * len(target)), int(low - start) + begin, int(low - start) + stop - 1))
                best = max(found, key=lambda x: (x[0], -x[1]))
                # A short item counts only as a whole.
                if best[0] >= (threshold if len(target) >= SHORT else max(threshold, 1.0)):
                    yield first + row, item, *best


def shards(items: DataFrame, item_id: str, text: str, shard_chars: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in parts of about ``shard_chars`` characters, each collected on its own."""
    rows = items.select(F.col(item_id).cast("bigint").alias("i"), lowered(text_of(text)).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = -(-total // shard_chars)
    for part in range(parts):
        held = rows if parts == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part)
        yield [(r["i"], bytes(r["t"])) for r in held.collect()]


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", threshold: float = THRESHOLD, shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """One row per input row and item that it holds: doc_id, item_id, ``score`` (threshold to 1), and the
    passage as ``first_word`` and ``last_word``, counted from 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), lowered(text_of(text)).alias("text"))
    out = spark.createDataFrame([], HIT_DDL)
    for number, shard in enumerate(shards(items, item_id, item_text, shard_chars)):
        known = Items(shard, threshold)
        if not len(known.known):
            continue
        shared = Carried(spark, known)
        found = rows.mapInArrow(_finder(shared, threshold), HIT_DDL)
        out = found if number == 0 else out.unionByName(found)
    return out


def _finder(shared, threshold: float):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = shared.value, WordHashes(LOWER, _APART)
        held: list[tuple] = []
        with np.errstate(over="ignore"):
            for batch in batches:
                for row, item, *match in _matches(batch, known, hashes, threshold):
                    held += [(batch.column("doc_id")[row].as_py(), i, *match) for i in known.ids[item]]
                if len(held) >= 10_000:
                    yield _packed(held)
                    held = []
        if held:
            yield _packed(held)

    return find


def _cleaner(shared, threshold: float):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = shared.value, WordHashes(LOWER, _APART)
        with np.errstate(over="ignore"):
            for batch in batches:
                good = np.ones(batch.num_rows, dtype=bool)
                for row, *_ in _matches(batch, known, hashes, threshold):
                    good[row] = False
                yield batch.drop_columns("text").filter(pa.array(good))

    return clean


def clean_rows(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """The input rows that hold no item, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    out = docs.toDF(*names)
    for shard in shards(items, item_id, item_text, shard_chars):
        known = Items(shard, threshold)
        if not len(known.known):
            continue
        body = lowered(text_of(names[docs.columns.index(text)]))
        shared = Carried(docs.sparkSession, known)
        out = out.withColumn("text", body).mapInArrow(_cleaner(shared, threshold), out.schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, HIT.types, strict=True)], schema=HIT)

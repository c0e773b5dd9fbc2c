"""Helpers for Arrow batches inside tasks: words to hashes, and runs of equal keys across batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def rolling(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` ids; a shorter array gives one hash of the whole, an empty one none."""
    if not len(ids):
        return ids
    width = min(n, len(ids))
    out = ids[: len(ids) - width + 1].copy()
    with np.errstate(over="ignore"):
        for k in range(1, width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - width + 1 + k]
        return mix64(out)


# Base of the words' polynomial hash and its inverse modulo 2^64; the base is 5 modulo 8, so its powers differ.
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
PART_BYTES = 1 << 20
# Bytes hashed at a time, whose sums and powers stay in a core's cache.
PIECE_BYTES = 1 << 16
# ASCII capitals to lower case, and ASCII white space.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHashes:
    """64-bit hashes of the words of many texts at once, without a Python object per word.

    ``fold`` maps bytes to bytes and ``apart`` marks the bytes between words. A word's hash comes from running
    sums of byte x power of the base, with the powers of its start divided out.
    """

    def __init__(self, fold: np.ndarray, apart: np.ndarray) -> None:
        # As tables of 256 bytes: translating bytes is many times faster than indexing by them.
        self.fold, self.apart = fold.astype(np.uint8).tobytes(), apart.astype(np.uint8).tobytes()
        self.up, self.down = _powers(_BASE, 1 << 10), _powers(_INVERSE, 1 << 10)

    def finished(self, value: np.ndarray, folded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64(value)

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and places of the first bytes of the words of some bytes."""
        while len(self.up) <= len(data):
            self.up, self.down = _powers(_BASE, 2 * len(self.up)), _powers(_INVERSE, 2 * len(self.down))
        folded = np.frombuffer(data.translate(self.fold), np.uint8)
        between = np.flatnonzero(np.frombuffer(data.translate(self.apart), np.bool_))
        starts, ends = np.r_[0, between + 1], np.r_[between, len(data)]
        some = starts < ends
        starts, ends = starts[some], ends[some]
        terms = folded.astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.up[: len(data)]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        value = (sums[ends] - sums[starts]) * self.down[starts]
        return self.finished(value, folded, starts, ends), starts

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words of a binary array in a row, and the number of the text of each."""
        held = [text or b"" for text in texts.to_pylist()]
        sizes = np.fromiter(map(len, held), np.int64, len(held)) + 1
        piece = (np.cumsum(sizes) - sizes) // PIECE_BYTES
        cuts = np.r_[0, np.flatnonzero(piece[1:] != piece[:-1]) + 1, len(held)].tolist()
        values, words = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            # A space after each text keeps the words of neighbours apart.
            value, starts = self.words(b" ".join([*held[low:high], b""]))
            values.append(value)
            words.append(np.diff(np.searchsorted(starts, np.cumsum(sizes[low:high])), prepend=0))
        return np.concatenate(values), np.repeat(np.arange(len(held)), np.concatenate(words))

    def parts(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first text, texts, hashes, number of the text within) for runs of texts of about ``PART_BYTES``."""
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1])
        part = (np.cumsum(sizes, dtype=np.int64) - sizes) // PART_BYTES
        for at in np.unique(part):
            low, high = np.searchsorted(part, [at, at + 1])
            yield int(low), int(high - low), *self.of(texts.slice(low, high - low))


    def each(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The hashes of the words of every text, one array per text."""
        for _, count, values, number in self.parts(texts):
            yield from np.split(values, np.searchsorted(number, np.arange(1, count)))


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by the keys. A run may cross batches;
    only one run is held beside the batch."""
    waiting: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(n, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        change[0] = last is not None and last != tuple(c[0] for c in columns)
        starts = np.flatnonzero(change)
        at = 0
        for s in starts:
            if s > at or waiting:
                waiting.append(batch.slice(at, s - at))
                yield pa.Table.from_batches(waiting)
                waiting = []
            at = s
        waiting.append(batch.slice(at))
        last = tuple(c[-1] for c in columns)
    if waiting:
        yield pa.Table.from_batches(waiting)

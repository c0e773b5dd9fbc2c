"""Encoding with a SentencePiece BPE model by prefix tables, and decoding.

Merging the best pair of neighbours again and again gives every prefix of a text one encoding, and so one *last
token*. Two facts make the last tokens easy to find from left to right:

- a sequence of tokens is an encoding if and only if each two neighbours are: the first merge across a boundary
  would already happen with the two tokens alone;
- without its last token, an encoding is the encoding of a shorter prefix.

So the last token of a prefix is the one token that ends there (an Aho-Corasick automaton over the pieces lists them) and
is compatible with the last token of the prefix before it. The table of last tokens then gives the ids backwards.
The work is linear in the length of the text. Whether two tokens are compatible is found by replaying the merges of both
beside the pairs across their boundary, and remembered.

Models mostly have no piece that goes on with a space after something else, so no merge crosses such a place and a text
falls into independent spans of spaces and what follows; spans met before are remembered. Other models' texts are one
span each.

Texts are normalised as the model says. Null texts count as empty; an empty text has no ids. Characters without a piece become
their bytes, or the unknown id (one for a run of them) where the model has no pieces for bytes. Texts of any length are encoded whole; a task
holds one text's ids and table beside its batch. Rows keep their other columns, except that one with the name of an added
column is replaced. Repeated rows are encoded each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, IntegerType, StringType, StructType

SPACE = "▁"
# Spans and pairs remembered by a task, and characters of a span that is worth remembering.
KEYS, PAIRS, KEY_CHARS = 500_000, 1_000_000, 64
# Texts handled together within a batch.
SLICE_ROWS = 256


class Tables(NamedTuple):
    """What the encoder needs, as plain data that any Python process can read.

    ``symbols`` are the pieces by id, and after them the characters that only occur within pieces. ``merges`` has for each symbol
    the (score, last symbol, first symbol) after each merge that makes it, in order; None where merging does not make it.
    """

    proto: bytes
    symbols: list[str]
    scores: list[float]
    pieces: int
    merges: list[list[tuple[float, int, int]] | None]
    spaced: bool
    byte_ids: list[int] | None
    unknown: int


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def merged(text: str, ids: dict[str, int], scores: Sequence[float]) -> tuple[list[str], list[tuple[float, int, int]]]:
    """Pieces of a short text by plain merging, best score first and leftmost among equal ones, and all merges."""
    parts, done = list(text), []
    while len(parts) > 1:
        best = None
        for i in range(len(parts) - 1):
            found = ids.get(parts[i] + parts[i + 1])
            if found is not None and (best is None or scores[found] > best[0]):
                best = (scores[found], i)
        if best is None:
            break
        score, i = best
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        done.append((score, ids[parts[-1]], ids[parts[0]]))
    return parts, done


def prepare(proto: bytes) -> Tables:
    """The tables of a model; refuses one that is not plain BPE."""
    model = sentencepiece.SentencePieceProcessor(model_proto=proto)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = {i for i in range(size) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
    if any(model.is_unused(i) for i in range(size)):
        raise ValueError("models with unused pieces are not supported")
    ids = {p: i for i, p in enumerate(pieces) if i not in special}
    inner = sorted({c for p in ids for c in p} - ids.keys())
    symbols = pieces + inner
    ids |= {c: size + i for i, c in enumerate(inner)}
    scores = [model.get_score(i) for i in range(size)] + [0.0] * len(inner)
    merges: list[list[tuple[float, int, int]] | None] = [None] * len(symbols)
    for piece, i in ids.items():
        # A symbol of one character exists from the start.
        parts, done = ([piece], []) if len(piece) == 1 else merged(piece, ids, scores)
        merges[i] = done if parts == [piece] else None
    found = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    byte_ids = found if all(model.is_byte(i) for i in found) else None
    spaced = any(SPACE in p.lstrip(SPACE) for p in ids)
    tables = Tables(proto, symbols, scores, size, merges, spaced, byte_ids, model.unk_id())
    _require_plain(model, tables)
    return tables


def _require_plain(model: sentencepiece.SentencePieceProcessor, tables: Tables) -> None:
    """Pieces defined by the user stand outside the merges; so do models of other kinds. Both show on their own pieces."""
    encoder = Encoder(tables)
    texts = [p.replace(SPACE, " ") for p in tables.symbols[: tables.pieces : max(1, tables.pieces // 2000)]]
    if [i.tolist() for i in encoder.ids(texts)] != model.encode(texts):
        raise ValueError("not a plain BPE model")


class Encoder:
    def __init__(self, tables: Tables) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_proto=tables.proto)
        self.tables = tables
        self.lengths = [len(s) for s in tables.symbols]
        self.numbers = {s: i for i, s in enumerate(tables.symbols)}
        self.scored = {s: tables.scores[i] for i, s in enumerate(tables.symbols) if len(s) > 1 and tables.merges[i] is not None}
        # A pair may also join to a piece that merging never makes alone.
        kinds = (self.model.is_byte, self.model.is_control, self.model.is_unknown)
        for i, s in enumerate(tables.symbols[: tables.pieces]):
            if len(s) > 1 and tables.merges[i] is None and not any(kind(i) for kind in kinds):
                self.scored[s] = tables.scores[i]
        self.automaton = ahocorasick.Automaton()
        # Symbols of one character need no automaton: such a token is the last one where no longer one is.
        self.single = {s: i for i, s in enumerate(tables.symbols) if len(s) == 1}
        for s in self.scored:
            if tables.merges[i := self.numbers[s]] is not None:
                self.automaton.add_word(s, i)
        self.automaton.make_automaton()
        # A character of no piece keeps spans apart.
        used = set("".join(tables.symbols))
        self.apart = next(c for c in map(chr, range(0xD800)) if c not in used)
        self.after: list[dict[int, bool]] = [{} for _ in tables.symbols]
        self.pairs = 0
        self.known: dict[str, bytes] = {}
        self.spans = (lambda s: [s] if s else []) if tables.spaced else re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+").findall

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side stay as they are.

        Both tokens' merges are replayed, the better of the next ones first. A pair across the boundary that is better
        than both joins them; of equal scores the leftmost goes first, so it yields to the left token's merges only.
        """
        symbols, scored = self.tables.symbols, self.scored
        ahead, behind = self.tables.merges[left], self.tables.merges[right]
        i = j = 0
        last = symbols[left][-1] if ahead else symbols[left]
        first = symbols[right][0] if behind else symbols[right]
        none = -np.inf
        while True:
            a = ahead[i][0] if i < len(ahead) else none
            b = behind[j][0] if j < len(behind) else none
            across = scored.get(last + first)
            if across is not None and (i == len(ahead) or across > a) and (j == len(behind) or across >= b):
                return False
            if i < len(ahead) and (j == len(behind) or a >= b):
                last = symbols[ahead[i][1]]
                i += 1
            elif j < len(behind):
                first = symbols[behind[j][2]]
                j += 1
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """:meth:`compatible`, remembered by the right token."""
        if self.pairs >= PAIRS:
            for known in self.after:
                known.clear()
            self.pairs = 0
        self.pairs += 1
        found = self.after[right][left] = self.compatible(left, right)
        return found

    def last_tokens(self, text: str) -> list[int]:
        """The last token of every prefix but the empty one; -1 where a character without a piece ends it."""
        single, lengths, after = self.single, self.lengths, self.after
        last, settled = [single.get(c, -1) for c in text], -1
        for end, token in self.automaton.iter(text):
            if end == settled:
                continue
            start = end - lengths[token]
            before = last[start] if start >= 0 else -1
            if before >= 0:
                fits = after[token].get(before)
                if fits is None:
                    fits = self.fits(before, token)
                if not fits:
                    continue
            last[end] = token
            settled = end
        return last

    def encode_spans(self, spans: Sequence[str]) -> Iterator[bytes]:
        """The ids of every span, as bytes, last span first: recovered from the last tokens backwards."""
        tables, lengths, size = self.tables, self.lengths, self.tables.pieces
        joined = self.apart.join(spans)
        last, at = self.last_tokens(joined), len(joined) - 1
        for span in reversed(spans):
            before, found = at - len(span), array("i")
            while at > before:
                token = last[at]
                if 0 <= token < size:
                    found.append(token)
                    at -= lengths[token]
                    continue
                if tables.byte_ids is not None:
                    found.extend(tables.byte_ids[b] for b in reversed(joined[at].encode()))
                else:
                    found.append(tables.unknown)
                at -= 1
            found.reverse()
            yield found.tobytes()
            at -= 1

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of every text."""
        known = self.known
        if len(known) >= KEYS:
            known.clear()
        cut = [self.spans(self.model.normalize(t)) for t in texts]
        # In order, so that neighbours lead through the same states of the automaton.
        new = sorted(set(chain.from_iterable(cut)).difference(known))
        known.update(zip(reversed(new), self.encode_spans(new)))
        found = [np.frombuffer(b"".join(map(known.__getitem__, spans)), np.int32) for spans in cut]
        for span in new:
            if len(span) > KEY_CHARS:
                del known[span]
        return found if self.tables.byte_ids is not None else [self.joined_unknown(f) for f in found]

    def joined_unknown(self, ids: np.ndarray) -> np.ndarray:
        """A run of unknown characters has one id, where the model has no pieces for bytes."""
        unknown = ids == self.tables.unknown
        return ids[~unknown | (np.diff(unknown, prepend=False))]


def _added(df: DataFrame, name: str, kind: DataType, column: Column) -> tuple[DataFrame, StructType]:
    """The frame with a working column last, beside those kept, and the schema of the result."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()]
    return df.select(*kept, column.alias(name)), df.select(*kept).schema.add(name, kind)


def encode(docs: DataFrame, proto: bytes, text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """Adds the ids of every text, an array of int."""
    tables = docs.sparkSession.sparkContext.broadcast(tuple(prepare(proto)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Tables(*tables.value))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                found = encoder.ids([t or "" for t in piece.column(ids).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], lists], names=piece.schema.names)

    frame, schema = _added(docs, ids, ArrayType(IntegerType()), F.col(text).cast("string"))
    return frame.mapInArrow(run, schema)


def decode(docs: DataFrame, proto: bytes, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """Adds the text of every array of ids; a null array counts as empty."""
    model = docs.sparkSession.sparkContext.broadcast(proto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                piece = batch.slice(at, SLICE_ROWS)
                lists = piece.column(text)
                values, bounds = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                # A null array has no values.
                texts = [processor.decode(values[a:b].tolist()) if b > a else "" for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(texts, pa.string())], names=piece.schema.names)

    frame, schema = _added(docs, text, StringType(), F.col(ids))
    return frame.mapInArrow(run, schema)

"""Toxicity by a support vector machine on a gapped subsequence kernel with Nyström landmarks.

Two words are compared by their common character subsequences of three, with up to two other
characters between; each gap costs a factor ``DECAY``. So a word with inserted characters still resembles the
plain one. The normalised kernel is raised to a power, which leaves a sum over the words of two sentences a
kernel. Landmarks are words of the labelled sample: those that stand for most words of toxic documents only,
the clean words that resemble these most, and frequent clean words. Sentences are mapped by the Nyström
method, a linear SVM with squared hinge loss is fitted, and its weights are folded back into one value per
word. As labels belong to documents, the most suspicious sentence stands for its document; it is chosen
anew with the fitted weights, and the fit repeated. A document's score is the calibrated value of its most
suspicious sentence.

Words are runs between white space, lower-cased, without punctuation; runs of three or more
single letters also count joined. Sentences end at ``.``, ``!``, ``?`` or a line break. The fit uses at most
``MAX_LABELLED`` documents of each label. Null texts count as empty; an empty text has one sentence
without words. Texts are read whole. Repeated rows are scored alike; labels that disagree on a document count as
toxic, null labels are ignored. Without labels of both kinds every score is 0. The result has the
named columns only, so further columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hazardmarts.llm.common import Carried, stored, text_of

# Bound of the labelled documents of each label that the classifier is fitted on, chosen by hash of the id.
MAX_LABELLED = 3000
TOXIC_LANDMARKS, NEAR_LANDMARKS, FREQUENT_LANDMARKS = 128, 32, 8
# Bounds of the words that landmarks are chosen from.
CANDIDATES, CLEAN_WORDS = 1000, 10_000
DECAY, POWER = 0.5, 3
SPACE_BITS = 14
# Places of the second and third character after the first, and the characters skipped.
OFFSETS = tuple((a, b, b - 2) for b in range(2, 5) for a in range(1, b))
# Weights by characters skipped, and how many words are worked on together.
_WEIGHTS = np.array([1.0, DECAY, DECAY**2, 0.0], dtype=np.float32)
CHUNK = 4096
ROUNDS = 2
PENALTY = 1e-3
# What toxic documents weigh in the fit, all together; near what they are among all documents, so that 0.7 is sure.
TOXIC_SHARE = 0.2
_PUNCTUATION = re.compile(r"[\W_]+")


def plain(token: str) -> str:
    return _PUNCTUATION.sub("", token)


def feature_rows(words: list[str]) -> np.ndarray:
    """Every gapped triple of characters of at most ``CHUNK`` words, packed into one number as word, feature and
    characters skipped; words of similar length are worked on together, with marks at both ends."""
    packed = []
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    classes = np.where(sizes <= 32, -(-sizes // 4) * 4, 2 ** np.ceil(np.log2(np.maximum(sizes, 1))).astype(np.int64))
    for width in np.unique(classes):
        if width == 0:
            continue
        members = np.flatnonzero(classes == width)
        step = max(1, (1 << 19) // int(width))
        for at in range(0, len(members), step):
            some = members[at : at + step]
            codes = np.array([words[i] for i in some], dtype=f"U{width}").view(np.uint32).reshape(len(some), width)
            marked = np.zeros((len(some), width + 2), dtype=np.uint32)
            marked[:, 0] = 1
            marked[:, 1:-1] = codes
            marked[np.arange(len(some)), sizes[some] + 1] = 2
            for a, b, skipped in OFFSETS:
                if b >= marked.shape[1]:
                    continue
                first, second, third = marked[:, :-b], marked[:, a : a - b], marked[:, b:]
                mixed = (first * np.uint32(0x9E3779B1) ^ second) * np.uint32(0x85EBCA77) ^ third
                mixed = mixed * np.uint32(0xC2B2AE3D)
                row, column = np.nonzero(third)
                feature = (mixed >> np.uint32(32 - SPACE_BITS))[row, column]
                key = (some[row].astype(np.uint32) << np.uint32(SPACE_BITS)) | feature
                packed.append((key << np.uint32(2)) | np.uint32(skipped))
    return np.concatenate(packed) if packed else np.zeros(0, np.uint32)


def embedded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same with one row per word and feature, scaled to length 1 per word and sorted by word."""
    packed = np.sort(feature_rows(words))
    if not len(packed):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)
    weight = _WEIGHTS[packed & np.uint32(3)]
    key = (packed >> np.uint32(2)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    weight, key = np.add.reduceat(weight, starts), key[starts]
    owner = key >> SPACE_BITS
    length = np.sqrt(np.bincount(owner, weights=weight.astype(np.float64) ** 2, minlength=len(words)))
    return owner, key & ((1 << SPACE_BITS) - 1), (weight / length[owner]).astype(np.float32)


class Landmarks:
    """The landmark words by feature: which landmarks have it, with what weight."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        owner, feature, weight = embedded(words)
        order = np.argsort(feature, kind="stable")
        self.first = np.searchsorted(feature[order], np.arange((1 << SPACE_BITS) + 1))
        self.landmark, self.weight = owner[order], weight[order]

    def kernel(self, words: list[str]) -> np.ndarray:
        """One row per word: its kernel with each landmark."""
        out = np.zeros((len(words), len(self.words)), dtype=np.float32)
        step = max(64, min(CHUNK, (1 << 18) // max(len(self.words), 1)))
        for at in range(0, len(words), step):
            part = out[at : at + step]
            owner, feature, weight = embedded(words[at : at + step])
            first = self.first[feature]
            count = self.first[feature + 1] - first
            # One entry for each feature of a word and each landmark that has it.
            entry = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            cell = np.repeat(owner * part.shape[1], count) + self.landmark[entry]
            value = np.repeat(weight, count) * self.weight[entry]
            part += np.bincount(cell, weights=value, minlength=part.size).reshape(part.shape)
        np.minimum(out, 1.0, out=out)
        return np.power(out, POWER, out=out)

    def whitening(self) -> np.ndarray:
        """The inverse square root of the landmarks' own kernel."""
        values, vectors = np.linalg.eigh(self.kernel(self.words).astype(np.float64))
        scale = np.where(values > 1e-3, 1 / np.sqrt(np.maximum(values, 1e-3)), 0.0)
        return (vectors * scale) @ vectors.T


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray  # per landmark, with the whitening folded in
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def word_values(self, words: list[str]) -> np.ndarray:
        return self.landmarks.kernel(words) @ self.weights.astype(np.float32)

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (value + self.bias) + self.shift, -500, 500)))


class Tokens(dict):
    """A number per raw token, with its plain form; new ones are valued together."""

    limit = 150_000

    def __init__(self, value) -> None:
        super().__init__()
        self.value = value
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.fresh, self.plains = [], {}
        self.values, self.word = np.zeros(0, np.float32), np.zeros(0, np.int64)
        self.ends, self.letters = np.zeros(0, bool), np.zeros(0, bool)

    def __missing__(self, token: str) -> int:
        number = self[token] = len(self)
        self.fresh.append(token)
        return number

    def of(self, tokens: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.int64, count=len(tokens))

    def settle(self) -> None:
        """Values for the tokens that are new."""
        if not self.fresh:
            return
        words = [plain(t) for t in self.fresh]
        self.word = np.concatenate([self.word, [self.plains.setdefault(w, len(self.plains)) for w in words]])
        self.values = np.concatenate([self.values, self.value(words)])
        self.ends = np.concatenate([self.ends, np.array([t.rstrip("\"')]").endswith((".", "!", "?")) for t in self.fresh])])
        self.letters = np.concatenate([self.letters, np.array([len(w) == 1 and w.isalpha() for w in words])])
        self.fresh = []

    def trim(self) -> None:
        if len(self) > self.limit:
            self.forget()


def tokens_of(text: str) -> list[str]:
    return text.lower().replace("\n", " . ").split()


def _spelled(tokens: Tokens, raw: list[str], ids: np.ndarray) -> list[tuple[int, str]]:
    """(place, word) of the runs of three or more single letters."""
    single = np.r_[False, tokens.letters[ids], False].astype(np.int8)
    edge = np.diff(single)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return [(s, "".join(plain(t) for t in raw[s:e])) for s, e in zip(starts, ends, strict=True) if e - s >= 3]


def worst_sentences(tokens: Tokens, texts: list[str]) -> Iterator[tuple[float, list[str]]]:
    """For each text the value of its most suspicious sentence, and the words of that sentence."""
    raws = [tokens_of(t) for t in texts]
    numbered = [tokens.of(r) for r in raws]
    tokens.settle()
    spelled = [_spelled(tokens, r, i) if len(i) > 2 else [] for r, i in zip(raws, numbered, strict=True)]
    extra = sorted({w for s in spelled for _, w in s})
    value_of = dict(zip(extra, tokens.value(extra).tolist(), strict=True)) if extra else {}
    for raw, ids, runs in zip(raws, numbered, spelled, strict=True):
        if not len(ids):
            yield 0.0, []
            continue
        values = tokens.values[ids].astype(np.float64)
        sentence = np.r_[0, np.cumsum(tokens.ends[ids][:-1])]
        # Each distinct word of a sentence counts once.
        order = np.argsort(sentence * (len(tokens.plains) + 1) + tokens.word[ids], kind="stable")
        same = (sentence[order][1:] == sentence[order][:-1]) & (tokens.word[ids][order][1:] == tokens.word[ids][order][:-1])
        values[order[1:][same]] = 0.0
        for place, word in runs:
            values[place] += value_of[word]
        starts = np.flatnonzero(np.r_[True, sentence[1:] != sentence[:-1]])
        sums = np.add.reduceat(values, starts)
        at = int(sums.argmax())
        low, high = starts[at], starts[at + 1] if at + 1 < len(starts) else len(raw)
        words = dict.fromkeys([plain(t) for t in raw[low:high]] + [w for place, w in runs if low <= place < high])
        yield float(sums[at]), list(words)
    tokens.trim()


def _texts(batch: pa.RecordBatch, size: int = 128) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        yield part, part.column("text").to_pylist()


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, label_id: str, train) -> DataFrame:
    """(text, toxic) of at most ``MAX_LABELLED`` documents of each label, stored. Equal texts count once."""
    known = (
        labels.where(train(label_id) & F.col(label).isNotNull() & F.col(label_id).isNotNull())
        .groupBy(F.col(label_id).alias("l_id"))
        .agg((F.max(F.col(label).cast("int")) > 0).cast("int").alias("toxic"))
    )
    ids = None
    for kind in (0, 1):
        some = known.where(F.col("toxic") == kind).orderBy(F.xxhash64("l_id"), "l_id").limit(MAX_LABELLED)
        ids = some if ids is None else ids.unionByName(some)
    # The sample has a fixed bound of rows of two numbers, so it may be sent to all tasks.
    rows = docs.select(F.col(doc_id).alias("d"), text_of(text).alias("text"))
    joined = rows.join(F.broadcast(ids), F.col("d") == F.col("l_id")).select("text", "toxic")
    return stored(joined.groupBy("text").agg(F.max("toxic").alias("toxic")).repartition("text"), "toxicity-sample")


def word_counts(sample: DataFrame) -> DataFrame:
    """(word, pos, neg): in how many documents of each label a word occurs."""
    schema = pa.schema([("word", pa.string()), ("pos", pa.int64()), ("neg", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                seen[toxic].update({w for t in set(tokens_of(text)) if len(w := plain(t)) > 2})
        words = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()),
             pa.array([seen[0][w] for w in words], pa.int64())], schema=schema,
        )

    parts = sample.mapInArrow(count, "word string, pos bigint, neg bigint")
    return stored(parts.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")), "toxicity-words")


def choose_landmarks(counts: DataFrame, n_pos: int, n_neg: int) -> tuple[list[str], list[str]]:
    """Toxic and clean landmark words; a fixed number of rows is collected.

    Candidates are the words with the most certain log odds of toxic documents. Their counts are smoothed by
    the kernel, over candidates and clean words alike, as forms of one insult support each other while words that
    only share a copied text resemble clean ones. Of what is left, words are taken in turn that
    cover most toxic occurrences not yet covered by a similar one.
    """
    rate_pos = (F.col("pos") + 0.5) / (n_pos + 1.0)
    rate_neg = (F.col("neg") + 0.5) / (n_neg + 1.0)
    odds = F.log(rate_pos / rate_neg)
    spread = F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    found = counts.where((F.col("pos") >= 2) & (odds > 1)).orderBy(F.desc(odds / spread), "word").limit(CANDIDATES).collect()
    clean = counts.where((F.col("neg") >= 1) & (odds < 0.3)).orderBy(F.desc("neg"), "word").limit(CLEAN_WORDS).collect()
    frequent = [r["word"] for r in clean[:FREQUENT_LANDMARKS]]
    if not found:
        return [], frequent
    words, other = [r["word"] for r in found], [r["word"] for r in clean]
    basis = Landmarks(words)
    alike = basis.kernel(words)
    pos, neg = (np.array([r[c] for r in found], dtype=np.float64) for c in ("pos", "neg"))
    toxic_mass = (alike.T @ pos + 1) / (n_pos + 1)
    clean_mass = alike.T @ neg + 1
    for at in range(0, len(clean), 500):  # in parts, since the whole table of kernels is not needed at once
        part = clean[at : at + 500]
        clean_mass += basis.kernel([r["word"] for r in part]).T @ np.array([r["neg"] for r in part], dtype=np.float64)
    clean_mass /= n_neg + 1
    sure = np.flatnonzero(toxic_mass > clean_mass)
    left, chosen = np.ones(len(sure)), []
    for _ in range(min(TOXIC_LANDMARKS, len(sure))):
        gain = (np.maximum(alike[np.ix_(sure, sure)] - (1 - left)[:, None], 0) * pos[sure][:, None]).sum(axis=0)
        best = int(gain.argmax())
        if gain[best] <= 0:
            break
        chosen.append(int(sure[best]))
        left = np.minimum(left, 1 - alike[sure, sure[best]])
    toxic = [words[i] for i in chosen]
    near = Landmarks(toxic).kernel(other).max(axis=1) if toxic and other else np.zeros(0)
    order = np.argsort(-near, kind="stable")[:NEAR_LANDMARKS]
    return toxic, list(dict.fromkeys([other[i] for i in order] + frequent))


def spoilt(words: list[str]) -> list[str]:
    """The words with a letter inserted in the middle, as toxic sentences are also learned."""
    return [w[: len(w) // 2] + "x" + w[len(w) // 2 :] for w in words]


def sentence_vectors(sample: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Kernel sums with the landmarks of each sampled document's most suspicious sentence, and the labels. Toxic
    sentences are also given with a character inserted in every word, and some without words are added as clean."""
    shared = Carried(sample.sparkSession, model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        tokens = Tokens(held.word_values)
        for batch in batches:
            for part, texts in _texts(batch):
                rows, labels = [], []
                for (_, words), toxic in zip(worst_sentences(tokens, texts), part.column("toxic").to_pylist(), strict=True):
                    for spelling in [words, spoilt(words)] if toxic else [words]:
                        rows.append(held.landmarks.kernel(spelling).sum(axis=0).tolist())
                        labels.append(toxic)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels, pa.int32()), pa.array(rows, pa.list_(pa.float32()))], names=["toxic", "vector"]
                )

    rows = sample.mapInArrow(work, "toxic int, vector array<float>").collect()
    found = sorted((r["toxic"], r["vector"]) for r in rows)
    # A sentence of words that resemble no landmark is clean.
    found += [(0, [0.0] * len(model.landmarks.words))] * (1 + len(found) // 20)
    return np.array([v for _, v in found], dtype=np.float64), np.array([t for t, _ in found], dtype=np.float64)


def _shares(y: np.ndarray) -> np.ndarray:
    return np.where(y > 0, TOXIC_SHARE / max(y.sum(), 1), (1 - TOXIC_SHARE) / max((1 - y).sum(), 1))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY, steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss, by Newton steps."""
    sign = 2 * y - 1
    share = _shares(y)
    z = np.c_[x, np.ones(len(x))]
    ridge = np.r_[np.full(x.shape[1], penalty), 1e-9]

    def loss(w):
        slack = np.maximum(0, 1 - sign * (z @ w))
        return (share * slack**2).sum() + (ridge * w * w).sum() / 2, slack

    w = np.zeros(z.shape[1])
    best, slack = loss(w)
    for _ in range(steps):
        slope = -2 * z.T @ (share * sign * slack) + ridge * w
        bend = 2 * (z * (share * (slack > 0))[:, None]).T @ z + np.diag(ridge)
        move, length = np.linalg.solve(bend, slope), 1.0
        while length > 1e-6:
            new, new_slack = loss(w - length * move)
            if new <= best:
                break
            length /= 2
        if length <= 1e-6 or best - new < 1e-10:
            break
        w, best, slack = w - length * move, new, new_slack
    return w[:-1], float(w[-1])


def calibrate(values: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the values, by Newton steps; targets are smoothed."""
    pos, neg = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    share = _shares(y)
    z = np.c_[values, np.ones(len(values))]
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (share * (p - target)) + 1e-4 * w
        bend = (z * (share * p * (1 - p))[:, None]).T @ z + 1e-4 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        w = w - move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
    return float(max(w[0], 1e-3)), float(w[1])


def fit(sample: DataFrame) -> Model | None:
    """The model, or None without documents of both labels."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    toxic, clean = choose_landmarks(word_counts(sample), sizes[1], sizes[0])
    if not toxic:
        return None
    landmarks = Landmarks(toxic + clean)
    start = np.r_[np.ones(len(toxic)), -np.ones(len(clean))]
    model, white = Model(landmarks, start), landmarks.whitening()
    for _ in range(ROUNDS):
        x, y = sentence_vectors(sample, model)
        w, bias = fit_svm(x @ white, y)
        model = Model(landmarks, white @ w, bias)
    x, y = sentence_vectors(sample, model)
    model.slope, model.shift = calibrate(x @ model.weights + model.bias, y)
    return model


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, toxicity) for every row."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("toxicity"))
    return with_scores(rows, model, ("doc_id",))


def with_scores(rows: DataFrame, model: Model, kept: tuple[str, ...] | None = None) -> DataFrame:
    """The rows, which have a column ``text`` without nulls, and ``toxicity``; with ``kept``, only these of their columns,
    so that texts need not come back from the tasks' Python."""
    shared, names = Carried(rows.sparkSession, model), list(kept or rows.columns)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        tokens = Tokens(held.word_values)
        for batch in batches:
            for part, texts in _texts(batch):
                values = np.array([v for v, _ in worst_sentences(tokens, texts)])
                columns = [*map(part.column, names), pa.array(held.probability(values), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "toxicity"])

    schema = StructType([*[rows.schema[n] for n in names], StructField("toxicity", DoubleType())])
    return rows.mapInArrow(work, schema)


def train(
    docs: DataFrame, labels: DataFrame, use=lambda c: F.lit(True), doc_id: str = "doc_id", text: str = "text",
    label: str = "toxic", label_id: str = "doc_id",
) -> Model | None:
    """Fits on the labelled documents whose id ``use`` accepts."""
    return fit(labelled_sample(docs, labels, doc_id, text, label, label_id, use))


def split_clean(docs: DataFrame, model: Model | None, limit: float = 0.7, text: str = "text") -> DataFrame:
    """The input rows whose score is below the limit."""
    if model is None:
        return docs
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("text", text_of(names[docs.columns.index(text)]))
    judged = with_scores(rows, model).where(F.col("toxicity") < limit)
    return judged.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])

"""The string kernel against its definition, and the classifier on held-out and disguised rows."""

import math
import random
import zlib
from itertools import combinations

import numpy as np
import pytest

from hazardmarts.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def plain_kernel(a, b):
    """The normalised kernel of two words by enumerating all triples of characters."""

    def features(word):
        marked, out = f"\x01{word}\x02", {}
        for i, j, k in combinations(range(len(marked)), 3):
            if k - i <= 4:
                triple = (marked[i], marked[j], marked[k])
                out[triple] = out.get(triple, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    fa, fb = features(a), features(b)
    dot = sum(w * fb.get(t, 0) for t, w in fa.items())
    length = lambda f: math.sqrt(sum(w * w for w in f.values()))
    return (dot / (length(fa) * length(fb))) ** toxicity.POWER


def test_kernel_equals_its_definition():
    words = ["idiot", "idxiot", "x", "ab", "closer", "loser", "é" * 40, "thth" * 20, "zzz"]
    got = toxicity.Landmarks(words).kernel(words)
    want = [[plain_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want, atol=0.02)  # features share 2^14 places, so some meet


def test_gaps_resemble_more_than_other_words():
    near, far = toxicity.Landmarks(["worthless"]).kernel(["worthxless", "thimbleful"])[:, 0]
    assert near > 5 * far


def test_letters_spelled_out_are_joined():
    tokens = toxicity.Tokens(lambda words: np.array([float(w == "idiot") for w in words], dtype=np.float32))
    values = [v for v, _ in toxicity.worst_sentences(tokens, ["you i d i o t here", "an i-d.i/o*t!", "fine. words", ""])]
    assert values == [1.0, 1.0, 0.0, 0.0]


def test_a_word_counts_once_per_sentence():
    tokens = toxicity.Tokens(lambda words: np.array([float(w == "bad") for w in words], dtype=np.float32))
    values = [v for v, _ in toxicity.worst_sentences(tokens, ["bad bad, BAD fine", "bad. bad.", "fine\nbad bad"])]
    assert values == [1.0, 1.0, 1.0]


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in queries.op2_toxicity_svm(spark, SF).collect()}


def auc(pairs):
    ordered = sorted(pairs)
    rank, total, n = 0, 0.0, sum(y for _, y in pairs)
    for rank, (_, y) in enumerate(ordered, 1):
        total += rank * y
    return (total - n * (n + 1) / 2) / (n * (len(pairs) - n))


def test_held_out_documents(spark, scored):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(scored[r.doc_id].score, r.toxic) for r in labels if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(scored[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in labels)
    assert auc(held) > 0.93
    assert sum(s >= 0.7 for s, y in held if y) > 0.8 * sum(y for _, y in held)
    assert sum(s >= 0.7 for s, y in held if not y) < 0.02 * sum(1 - y for _, y in held)


def test_every_document_is_scored(spark, scored):
    rows = list(scored.values())
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_disguised_insults_are_found(spark):
    model = queries.toxicity_model(spark, SF)
    clean = "The and attion to thanedble the, anea. "
    texts = ["you are an idiot and stupid", "you are an i.d.i.o.t and s-t-u-p-i-d", "you are an idxiot and stuxpid",
             "i d i o t and s t u p i d you are"]
    rows = [(i, clean * 30 + t + ". " + clean * 30) for i, t in enumerate([*texts, "of the"])]
    got = {r.doc_id: r.toxicity for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(got[i] >= 0.7 for i in range(4)) and got[4] < 0.3


def test_edge_cases(spark):
    draw = random.Random(1)
    word = lambda: f"{draw.choice('bcdfg')}{draw.choice('aeiou')}{draw.choice('lmnrs')}{draw.choice('aeiou')}"
    rows = [(i, " ".join([*(word() for _ in range(30)), *(["nasty"] if i % 4 == 0 else [])]), 0.5) for i in range(80)]
    odd = [(100, None, 0.0), (101, "", 0.0), (None, "nasty", 0.0), (102, "x" * 300_000, 0.0), (0, rows[0][1], 0.0)]
    docs = spark.createDataFrame([*rows, *odd], "doc_id long, text string, toxicity double")
    marks = [(i, int(i % 4 == 0)) for i in range(80)] + [(5, None), (None, 1), (3, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 85 and all(r.toxicity is not None for r in got)
    kept = toxicity.split_clean(docs, model)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {100, 101} <= ids and None not in ids and 0 not in ids
    assert toxicity.train(docs, labels.where("toxic = 0")) is None
    assert {r.toxicity for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.train(docs.limit(0), labels) is None

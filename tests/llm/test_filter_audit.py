"""The audit against filters applied one after another, row by row."""

import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from hazardmarts.llm import filter_audit

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def own_failures(rows):
    """The set of letters that each row fails."""
    out = []
    for doc_id, text, _ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        ids = [i for i, other, _ in rows if (other or "") == t and i is not None]
        if ids and (doc_id is None or min(ids) < doc_id):
            fails.add("E")
        out.append(fails)
    return out


def expected(rows, labels, letters="ABCDE"):
    fails = own_failures(rows)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    want = {}
    for part in {s or "" for *_, s in rows}:
        mine = [(r[0], f & set(letters)) for r, f in zip(rows, fails) if (r[2] or "") == part]
        total = dict.fromkeys(letters, 0)
        for order in permutations(letters):
            alive = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in alive if f in x[1]]
                alive = [x for x in alive if f not in x[1]]
                total[f] += len(gone)
                want[part, "".join(order), step] = [
                    len(alive), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                    sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone),
                ]
        for (p, order, step), values in want.items():
            if p == part:
                values.append(total[order[step - 1]])
    return want


def found(df):
    return {(r.part, r.filter_order, r.step): list(r)[3:] for r in df.collect()}


def made(seed, n):
    """Texts that fail each mix of filters, copies among them, with and without ids."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n // 2):
        vocabulary = [f"w{i}" for i in range(rng.choice([5, 200]))]
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 10, 60]))]
        text = " ".join(words).title() if rng.random() < 0.3 else "\n".join(words)
        texts.append(text + rng.choice(["", "", "#", " é|"]))
    rows = [(rng.choice([None, rng.randrange(n)]), rng.choice([*texts, None]), rng.choice(["a", "b", None])) for _ in range(n)]
    return rows + rows[:3], [(rng.choice([None, rng.randrange(2 * n)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_equals_filters_in_turn(spark, seed):
    rows, labels = made(seed, 60)
    got = filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    assert found(got) == expected(rows, labels)


def test_walk_counts_survivors_of_every_subset():
    cells = np.random.default_rng(1).integers(0, 9, (3, 2, 32))
    survivors = filter_audit.walk(cells, 5)
    for subset in range(32):
        alive = [m for m in range(32) if not m & subset]
        assert (survivors[..., subset] == cells[..., alive].sum(axis=-1)).all()


def test_copies_across_parts_and_ids(spark):
    """Of equal texts all but those of the smallest id fail, wherever they are; a null id repeats any other."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "a"), (5, text, "a"), (7, text, "a"), (9, text, "b"), (None, text, None)]
    got = found(filter_audit.audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)))
    assert [got[p, "EABCD", 1][:2] for p in ("a", "b", "")] == [[2, 1], [0, 1], [0, 1]]
    only = spark.createDataFrame([(None, text, "a"), (None, text, "a")], DOCS)
    assert found(filter_audit.audit(only, spark.createDataFrame([], LABELS)))["a", "EABCD", 1][:2] == [2, 0]


def test_edges(spark):
    rows = [(1, "", "a", "x"), (2, None, "a", "y"), (3, "W " * 400_000, "b", "z")]
    docs = spark.createDataFrame(rows, DOCS + ", part string")
    labels = spark.createDataFrame([(1, 1, 0, "p"), (1, 0, 1, "q")], LABELS + ", text string")
    got = found(filter_audit.audit(docs, labels))
    assert got["a", "AEBCD", 1][:6] == [0, 2, 0, 1, 1, 1]
    assert got["b", "BACDE", 1][:2] == [0, 1] and len(got) == 2 * 600
    assert filter_audit.audit(docs.limit(0), labels).count() == 0


def test_other_filters(spark):
    docs = spark.createDataFrame([(1, "a b", "s"), (2, "a b c", "s"), (3, "a b", "s")], DOCS)
    filters = [filter_audit.Filter("X", F.col("a_words") < 3), filter_audit.Filter("R", None)]
    got = found(filter_audit.audit(docs, spark.createDataFrame([], LABELS), filters))
    assert got["s", "XR", 1][:2] == [1, 2] and got["s", "RX", 1][:3] == [2, 1, 0] and got["s", "XR", 2][2] == 1
    with pytest.raises(ValueError):
        filter_audit.audit(docs, docs, filters[:1] * 2)

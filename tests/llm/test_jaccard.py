"""The Jaccard join against all pairs compared by brute force."""

import random
from collections import defaultdict

import pytest

from hazardmarts.llm import jaccard, queries

SCHEMA = "doc_id bigint, text string, text_id string, root int"


def brute(rows, n=5, threshold=0.8):
    """(class_id, n_links, copies) per row, from every pair."""
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        width = min(n, len(words))
        sets.append(frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else frozenset())
    links, where = defaultdict(set), defaultdict(list)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in where[g]:
                common[j] += 1
            where[g].append(i)
        for j, c in common.items():
            if c >= threshold * (len(s) + len(sets[j]) - c) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            part[i] = part[part[i]]
            i = part[i]
        return i

    for i, others in links.items():
        for j in others:
            part[root(i)] = root(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)].append(doc)
    return [
        (doc, min(least[root(i)], default=None), len(links[i]), sum(t == sets[i] for t in sets) if sets[i] else 1)
        for i, (doc, _) in enumerate(rows)
    ]


def key(row):
    return tuple((v is None, v) for v in row)


def found(df, **options):
    rows = jaccard.link_classes(df, **options).collect()
    return sorted(((r.doc_id, r.class_id, r.n_links, r.copies) for r in rows), key=key)


def variants(seed, count, words=120, edits=2):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_banding_reaches_its_recall():
    chosen = jaccard.choose_banding(0.8, 0.999)
    assert chosen.recall(0.8) >= 0.999 and chosen.hashes <= jaccard.MAX_HASHES
    with pytest.raises(ValueError):
        jaccard.choose_banding(0.1, 0.999, max_hashes=4)


def test_edge_cases(spark):
    rows = [
        (1, None), (2, ""), (3, "  \n "), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"),
        (7, "long " * 30_000), (8, "a b c d e f g"), (8, "a b c d e f g"), (9, "a b c d e f g"),
    ]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    assert found(df) == sorted(brute(rows), key=key)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jaccard.link_classes(df).count() == 0
    assert jaccard.one_per_class(df).count() == 0


def test_tiles_of_a_large_group_equal_brute_force(spark):
    texts = variants(1, 90) + variants(2, 5) + [" ".join(f"u{i}_{k}" for k in range(40)) for i in range(20)]
    rows = list(enumerate(texts + texts[:7]))
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert found(df, tile=16) == sorted(brute(rows), key=key)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op8_ngram_jaccard(spark, sf).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.copies) for r in got), key=key) == sorted(brute(rows), key=key)


def test_one_of_each_class_stays(spark):
    rows = [(i, t, None, None) for i, t in enumerate([*variants(3, 6, edits=1), "alone in the world of words", "", None])]
    df = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    kept = jaccard.one_per_class(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 6, 7, 8]

"""Decontamination against a plain alignment of every document with every item."""

import random
import re

import numpy as np

from hazardmarts.llm import decontam, queries


def plain_align(item, text):
    """Best local alignment score of two word lists, cell by cell."""
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            hit = decontam.MATCH if a == b else decontam.MISMATCH
            row.append(max(0, above[j] + hit, above[j + 1] + decontam.GAP, row[j] + decontam.GAP))
        best, above = max(best, max(row)), row
    return best


def test_alignment_equals_the_plain_one():
    draw = random.Random(5)
    for _ in range(200):
        a = [draw.randrange(6) for _ in range(draw.randrange(1, 12))]
        b = [draw.randrange(6) for _ in range(draw.randrange(0, 25))]
        score, first, last = decontam.align(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
        assert score == plain_align(a, b)
        if score:
            assert plain_align(a, b[first:last]) == score


def spoiled(words, draw, share):
    out = []
    for w in words:
        kind = draw.random()
        if kind < share / 2:
            out.append(f"changed{draw.randrange(999)}")
        elif kind < share * 0.75:
            out += [w, "added"]
        elif kind >= share:
            out.append(w)
    return out


def corpus(seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [[draw.choice(vocabulary) for _ in range(draw.randrange(15, 60))] for _ in range(12)]
    docs = []
    for i in range(60):
        around = lambda n: [draw.choice(vocabulary) for _ in range(n)]
        middle = spoiled(items[i % 12], draw, 0.1) if i % 3 else []
        docs.append((i, " ".join(around(draw.randrange(200)) + middle + around(50))))
    return docs, [(k, " ".join(w)) for k, w in enumerate(items)]


def test_edited_passages_are_found_as_by_full_alignment(spark):
    docs, items = corpus()
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    pairs = {(r.doc_id, r.item_id): r.score for r in got.collect()}
    for d, text in docs:
        for k, item in items:
            words, target = text.split(), item.split()
            share = plain_align(target, words) / (decontam.MATCH * len(target))
            if share >= decontam.THRESHOLD + 0.1:
                assert abs(pairs[d, k] - share) < 1e-9
            elif share < decontam.THRESHOLD:
                assert (d, k) not in pairs


def test_sharding_does_not_change_the_result(spark):
    docs, items = corpus(4)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, decontam.contaminated(d, b).collect()))
    assert whole and whole == sorted(map(tuple, decontam.contaminated(d, b, shard_chars=500).collect()))


def test_edge_cases(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(0, passage), (1, passage), (2, None), (3, ""), (4, "two words"), (None, "null item words here now"), (5, ",.;")]
    docs = [(1, None, 0), (2, "", 0), (3, passage.upper(), 0), (3, passage.upper(), 0), (None, f"x {passage}", 0),
            (4, "Two, words!", 0), (5, "filler " * 50_000 + passage, 0), (6, "null item words here now", 0)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in decontam.contaminated(d, b).collect()), key=str)
    want = [(3, 0), (3, 1)] * 2 + [(None, 0), (None, 1), (4, 4), (5, 0), (5, 1), (6, None)]
    assert got == sorted(want, key=str)
    assert sorted(r.doc_id for r in decontam.clean_rows(d, b).collect()) == [1, 2]
    none = spark.createDataFrame([], b.schema)
    assert decontam.contaminated(d, none).count() == 0 and decontam.clean_rows(d, none).count() == len(docs)
    assert decontam.contaminated(d.limit(0), b).count() == 0


def plain_words(text):
    return f" {' '.join(re.findall(r'[0-9a-z\u0080-\U0010ffff]+', text.lower()))} "


def test_query_finds_every_whole_item(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    whole = {
        (d.doc_id, i.item_id)
        for d in docs for i in items
        if plain_words(i.text) in plain_words(d.text)
    }
    got = {(r.doc_id, r.item_id): r.score for r in queries.op5_benchmark_decontamination(spark, sf).collect()}
    assert whole and whole <= got.keys()
    assert all(got[p] == 1.0 for p in whole)


def every_nth_replaced(words, n):
    return [f"other{i}" if i % n == n - 1 else w for i, w in enumerate(words)]


def check_against_full_alignment(spark, docs, items):
    """The very pairs that a full alignment finds, and their scores."""
    found = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.score for r in found.collect()}
    want = {}
    for d, text in docs:
        for k, item in items:
            share = plain_align(item.split(), text.split()) / (decontam.MATCH * len(item.split()))
            if share >= decontam.THRESHOLD:
                want[d, k] = share
    assert want and got.keys() == want.keys()
    assert all(abs(got[p] - want[p]) < 1e-9 for p in want)
    return want


def test_regularly_edited_copies_are_found_beside_clean_ones_and_alone(spark):
    draw = random.Random(11)
    items = [[f"w{draw.randrange(5000)}" for _ in range(n)] for n in (16, 24, 37, 48, 59)]
    for clean in (0, 3):
        docs = [(n, " ".join(every_nth_replaced(items[k], n // 10))) for k in range(5) for n in (50 + k, 60 + k)]
        docs = [(i, "before " * 30 + t + " after" * 30) for i, t in docs]
        docs += [(1000 + 10 * c + k, " ".join(w)) for c in range(clean) for k, w in enumerate(items)]
        want = check_against_full_alignment(spark, docs, [(k, " ".join(w)) for k, w in enumerate(items)])
        assert {(n + k, k) for k in range(5) for n in (50, 60)} <= want.keys()


def test_random_edits_are_found_down_to_the_threshold(spark):
    """A tenth to almost a third of the words edited, and every 4th or 3rd replaced: no common 4-gram, or 3-gram."""
    draw = random.Random(17)
    items = [[f"w{draw.randrange(5000)}" for _ in range(n)] for n in (4, 5, 16, 23, 32, 41, 50, 59)]
    copies = [spoiled(w, draw, share) for share in (0.1, 0.15, 0.2, 0.25, 0.3, 0.45, 0.6) for w in items for _ in range(3)]
    regular = [every_nth_replaced(w, n) for w in items for n in (4, 3)]
    # The lowest scores: a word put in after every two words, or every word.
    regular += [[x for i, v in enumerate(w) for x in ([v, "put", "in"][: 1 + (i % n == n - 1)])] for w in items for n in (1, 2)]
    docs = [(i, " ".join(["before"] * 9 + w + ["after"] * 9)) for i, w in enumerate(copies + regular)]
    want = check_against_full_alignment(spark, docs, [(k, " ".join(w)) for k, w in enumerate(items)])
    at_every = {(len(copies) + 2 * k + n, k) for k in range(8) for n in (0, 1) if len(items[k]) % 3 == 2}
    assert at_every <= want.keys() and min(want.values()) < 0.52


def test_pairs_shared_by_many_items_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SHARED", 2)
    monkeypatch.setattr(decontam, "HELD", 50)
    draw = random.Random(23)
    common = [f"c{i}" for i in range(20)]
    items = [common[: draw.randrange(8, 20)] + [f"w{draw.randrange(500)}" for _ in range(12)] for _ in range(8)]
    docs = [(i, " ".join(spoiled(items[i % 8], draw, 0.3) + ["then"] + spoiled(items[i % 5], draw, 0.1))) for i in range(24)]
    check_against_full_alignment(spark, docs, [(k, " ".join(w)) for k, w in enumerate(items)])


def test_a_long_insertion_does_not_split_an_item(spark):
    item = [f"p{i}" for i in range(40)]
    copy = [*item[:10], "x", *item[11:20], *[f"put{i}" for i in range(30)], *item[20:30], "y", *item[31:]]
    [score] = check_against_full_alignment(spark, [(1, " ".join(copy))], [(7, " ".join(item))]).values()
    assert 0.5 <= score < 0.6

"""Spelling variants against all pairs of words."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from hazardmarts.llm import variants


def edits_one(a, b):
    """One inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def brute(counts, times=2):
    near = {w: [x for x in counts if edits_one(w, x)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * n else None
    out = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), counts.get(form[w]))
    return out


def found(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    formed = variants.forms(words, variants.near_words(words), 2)
    rooted = {r.word: r.root for r in variants.roots(formed).collect()}
    return {r.word: (r.form, rooted.get(r.word, r.word), r.n, r.n_near, r.form_n) for r in formed.collect()}


@pytest.mark.parametrize("alphabet,chars", [("ab", (5, 9)), ("abcé", (5, 7)), ("abcdefghiÀ", (5, 6))])
def test_equals_all_pairs(spark, alphabet, chars):
    """Small alphabets: words full of repeated bigrams, with very many near words."""
    rng = random.Random(len(alphabet))
    counts = {"".join(rng.choice(alphabet) for _ in range(rng.randint(*chars))): rng.randint(3, 400) for _ in range(900)}
    assert found(spark, counts) == brute(counts)


def test_long_words_meet_by_halves(spark):
    rng = random.Random(3)
    counts = {}
    for length in (255, 256, 257, 258, 300, 2000):
        for base in ("a" * length, "".join(rng.choice("abcdef") for _ in range(length))):
            for at in (0, 1, length // 2, length - 1):
                counts |= {base: 100, base[:at] + base[at + 1 :]: 9, base[:at] + "z" + base[at:]: 8, base[:at] + "y" + base[at + 1 :]: 40}
    assert found(spark, counts) == brute(counts)


def test_pivots_are_disjoint_and_least():
    rng = random.Random(4)
    order = list(range(variants.BUCKETS))
    rng.shuffle(order)
    grams = variants.Grams(order)
    for _ in range(500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 12)))
        _, prefix = grams.prefix(word)
        a, b = grams.pivots(prefix)
        cost = {place: rank >> 42 for rank, place in prefix}
        assert b - a >= 2
        assert cost[a] + cost[b] == min(cost[x] + cost[y] for x in cost for y in cost if y - x >= 2)


def test_chains_end_at_the_commonest(spark):
    """A chain of many steps: each word twice as frequent as the one before."""
    counts, word = {}, "aaaaaaaaaaaaaaaaaaaa"
    for i in range(20):
        counts[word] = 3 * 2**i
        word = word[:i] + "b" + word[i + 1 :]
    got = found(spark, counts)
    assert got == brute(counts) and len({r[1] for r in got.values()}) == 1


def test_no_table_of_words_is_broadcast(spark, monkeypatch):
    """Their estimated sizes are within the broadcast limit here, as they are for large vocabularies; the rows in memory are not."""
    plans, store = [], variants.stored

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, label)

    monkeypatch.setattr(variants, "stored", planned)
    words = spark.createDataFrame([("abcdefgh", 9), ("abcdefgx", 4), ("abcdefyx", 1)], "word string, n long")
    docs = words.select(F.monotonically_increasing_id().alias("doc_id"), F.array_join(F.array_repeat("word", F.col("n").cast("int") * 3), " ").alias("text"))
    result = variants.spelling_variants(docs, typo_every=1 << 40)
    assert {r.word: r.root for r in result.collect()} == dict.fromkeys(("abcdefgh", "abcdefgx", "abcdefyx"), "abcdefgh")
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert sum(plan.count("SortMergeJoin") for plan in plans) >= 4 and not any("Broadcast" in plan for plan in plans)


def test_words_and_edges(spark):
    rows = [(i, "Hello, hello GRÜSSE Été abc déjà-vu", i) for i in range(200)] + [(None, "hello", 0), (1, "", 0), (2, None, 0)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, word int")
    counts = {}
    for i, text, _ in rows + rows[:5]:
        for run in variants_runs(text or ""):
            mark = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if mark % 97 == 0:
                run = run[: mark % len(run)] + run[mark % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    want = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    assert {"hello", "grÜsse"} <= want.keys() and sum(counts.values()) > sum(want.values())
    got = variants.spelling_variants(docs)
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()} == brute(want)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants.spelling_variants(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.spelling_variants(docs, min_chars=4)


def variants_runs(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out, run = [], ""
    for c in lower + " ":
        if "a" <= c <= "z" or "À" <= c <= "ÿ":
            run += c
        elif run:
            out, run = [*out, run], ""
    return out

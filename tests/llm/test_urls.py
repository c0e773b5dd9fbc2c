"""URL rules against plain Python; features and trees on urls whose labels follow them."""

import math
from collections import Counter

from pyspark.sql import functions as F

from hazardmarts.llm import queries, urls

RULES = queries.URL_RULES
ODD = [
    None, "", "no scheme", "http://", "http://NET/", "https://a.net", "https://a.net/", "x://A.b.Example.NET/en/1?x#y", "http://example.net/en",
    "http://notexample.net/en/", "http://badexample.com/de/", "http://example.com/de/x", "http://sub.example.com/de", "http://a.org/fr/?q",
    "http://a.org?/fr/", "http://a.org#/fr/", "http://a.net://b.org/fr/", "http://a.net:80/", "ftp://ÉXAMPLE.org/fr/\n", "http://a.com/" + "x" * 100_000,
]


def plain(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = lambda s, marks: min([s.index(m) for m in marks if m in s], default=len(s))
    host, tail = rest[: cut(rest, "/?#")], rest[cut(rest, "/?#") :]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: cut(tail, "?#")]
    fits = [r for r in RULES if (host == r.host or host.endswith(f".{r.host}")) and path.startswith(r.path)]
    return host, path, max((r.name for r in fits), key=len, default=None)


def test_rules_equal_plain_python(spark):
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(ODD)], "page_id int, url string, rule string")
    got = urls.classify(df, RULES).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == {i: plain(u) for i, u in enumerate(ODD)}
    verdicts = {r.name: r.verdict for r in RULES}
    assert all(r.verdict == verdicts[r.rule] if r.rule else r.verdict in ("allow", "block") for r in got)


def test_query_equals_plain_python(spark):
    sf = "/root/testdata/sf0.01"
    given = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op7_url_filter(spark, sf).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in got} == {i: plain(u) for i, u in given.items()}
    assert all((r.verdict == "block") == (r.block_score >= 0.5) for r in got if r.rule is None)


def test_entropy(spark):
    texts = ["", "a", "abab", "http://é.com/?a=1"]
    want = [-sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) for t in texts]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", urls.entropy(F.col("t")).alias("e")).collect()
    assert all(abs(r.e - want[r.i]) < 1e-9 for r in got)


def test_trees_learn_lexical_features(spark):
    """Rule-labelled urls whose blocked ones have long paths of digits; the unlabelled ones follow suit."""
    rows = [(i, f"http://s{i % 7}.good/{'page' if i % 2 else '9' * 30}") for i in range(400)]
    rows += [(1000 + i, f"http://s{i % 7}.other/{'page' if i % 2 else '9' * 30}") for i in range(100)]
    rules = [urls.Rule("block", "good", "/9"), urls.Rule("allow", "good", "/p")]
    got = urls.classify(spark.createDataFrame(rows, "page_id int, url string"), rules).where("rule is null").collect()
    assert all(r.verdict == ("allow" if r.page_id % 2 else "block") for r in got)


def test_without_labels_of_both_kinds(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, "http://b.net/")], "page_id int, url string")
    assert {r.verdict for r in urls.classify(df, [urls.Rule("block", "nowhere")]).collect()} == {"allow"}
    assert {r.verdict for r in urls.classify(df, [urls.Rule("block", "net")]).collect()} == {"block"}
    assert urls.classify(df.limit(0), RULES).count() == 0


def test_every_suffix_has_its_own_rate(spark):
    rows = [(f"http://h.s{k}/a", float(k % 2)) for k in range(400) for _ in range(30 if k < 300 else 20)]
    labelled = spark.createDataFrame(rows, "url string, label double").withColumn("host", urls.host_of(F.col("url"))).withColumn("path", F.lit("/a"))
    rates, prior = urls.suffix_rates(labelled)
    seen = labelled.unionByName(labelled.limit(1).withColumn("host", F.lit("h.other")))
    got = {r.host: r.f_suffix for r in urls.features(seen, "url", rates, prior).select("host", "f_suffix").collect()}
    assert len(got) == 401 and got["h.other"] == prior == 0.5
    n = lambda k: 30 if k < 300 else 20
    assert all(abs(got[f"h.s{k}"] - (n(k) * (k % 2) + 10) / (n(k) + 20)) < 1e-12 for k in range(400))

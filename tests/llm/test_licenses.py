"""Licence scans against plain search in word lists."""

import re

from hazardmarts.llm import licenses
from hazardmarts.llm.licenses import BASE, TEMPLATES, template

MIT = " ".join(TEMPLATES[0].words)
TEXTS = [
    None, "", "...", "Released under the MIT License.", "UNDER THE MIT LICENSE under the mit license", "the mit license",
    "Licensed under the Apache License, Version 2.0", "CC-BY-NC 4.0 and cc by sa", "unK der the mit license", "under thé mit license",
    f"x {MIT} y", MIT.replace("dealing", "x").replace("obtaining", "getting"), MIT.replace("granted", "refused"),
    "cc by cc by nc cc by nc", "all rights\nreserved", "gnu general public license version 3", "word " * 40_000 + "under the mit license",
    "permission permission is hereby granted free of charge", "\u0130 mit \u212a",
]


def plain(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(table))

    def places(templates):
        out = []
        for t in templates:
            for s in range(len(words)):
                at = lambda i, s=s: words[s + i] if s + i < len(words) else None
                if all(at(i) == t.words[i] for i in t.key_places):
                    out.append((t.label, s, sum(at(i) == w for i, w in enumerate(t.words)) / len(t.words)))
        return sorted(out)

    return len(words), places(BASE), places(TEMPLATES)


def test_scan_equals_plain_search(spark):
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id int, text string, lic_words string")
    shape = lambda xs: sorted((x.label, x.start, round(x.score, 12)) for x in xs)
    got = {r.doc_id: (r.lic_words, shape(r.lic_base), shape(r.lic_found)) for r in licenses.scan(df).collect()}
    rounded = lambda p: (p[0], *[[(a, b, round(c, 12)) for a, b, c in x] for x in p[1:]])
    assert got == {i: rounded(plain(t)) for i, t in enumerate(TEXTS)}


def test_rarest_words_are_looked_up():
    t = template("t", "the common rare word rare here", "common rare word rare")
    assert [t.words[i] for i in licenses.anchors(t, {"common": 9, "rare": 1, "word": 5})] == ["rare", "word", "common"]


def test_frequencies_count_texts(spark):
    df = spark.createDataFrame([("mit mit license",), ("MIT",), (None,), ("x",)], "text string")
    counts, total = licenses.frequencies(df, BASE)
    assert (counts["mit"], counts["license"], total) == (2, 1, 4)


def test_empty(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id int, text string")).count() == 0

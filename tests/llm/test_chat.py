"""Chat formatting: exact round trips, escapes, spans and examples."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardmarts.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] ok [/INST]"), (1, 2, "user", "\\<s>\\"), (1, 3, "assistant", ""),
    (2, 0, "system", None), (2, 1, "assistant", "<t>x<t></s>"), (3, 0, "user", "no reply"), (None, None, None, "lost"),
    (4, 0, "assistant", "twice"), (4, 0, "assistant", "twice"), (5, 0, "assistant", "long " * 50_000), (6, 1, "a<s>b", "role"),
]


def built(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA))


def grouped(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def test_round_trip(spark):
    got = built(spark, ROWS).select("conv_id", chat.parse(F.col("formatted")).alias("t")).collect()
    assert {r.conv_id: [tuple(t) for t in r.t] for r in got} == grouped(ROWS)


def test_no_control_string_comes_from_data(spark):
    for row in built(spark, ROWS).collect():
        turns = len(grouped(ROWS)[row.conv_id])
        assert all(row.formatted.count(c) == turns for c in ("<s>", "<t>", "</s>"))
        assert "[INST]" not in row.formatted and "[/INST]" not in row.formatted


def test_examples_are_prefixes_and_replies(spark):
    conversations = built(spark, ROWS)
    rendered = chat.render(chat.expand(conversations), conversations).collect()
    whole = {r.conv_id: r.formatted for r in conversations.collect()}
    assert len(rendered) == sum(r == "assistant" for t in grouped(ROWS).values() for r, _ in t)
    for r in rendered:
        assert whole[r.conv_id].startswith(r.context + r.target + "</s>") and r.context.endswith("<s>assistant<t>")
        assert r.loss_end - r.loss_start == len(r.target)


def test_digests(spark):
    conversations = built(spark, ROWS)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in chat.digests(conversations, chat.expand(conversations)).collect():
        turns = grouped(ROWS)[r.conv_id]
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), sha(loss))
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))


def test_empty(spark):
    conversations = built(spark, [])
    assert chat.digests(conversations, chat.expand(conversations)).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<>[]/\\stINS é\n", max_size=30), min_size=1, max_size=20))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = df.select("i", chat.unescape(chat.escape(F.col("t"))).alias("t")).collect()
    assert {r.i: r.t for r in got} == dict(enumerate(texts))

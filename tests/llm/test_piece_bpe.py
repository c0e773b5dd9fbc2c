"""Prefix tables against the library's own encoder, and the round trip."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardmarts.llm import piece_bpe
from hazardmarts.llm.queries import op13_piece_bpe
from tests.llm.foreign import run_elsewhere

PROTO = piece_bpe.read_model(public_tokenizers.path("piece_bpe_32k.model"))
TABLES = piece_bpe.prepare(PROTO)
ENCODER = piece_bpe.Encoder(TABLES)
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=PROTO)
ODD = ["", " ", "  ", "\n", "\0", "\0\0a", "<s>", "</s><unk>", "a▁b", "▁", "▁▁ ▁", "ａ<0x0A>", "🙂🙂", "a" * 5000, " " * 5000, "é́世界 "]


def same(texts):
    assert [i.tolist() for i in ENCODER.ids(texts)] == LIBRARY.encode(texts)


def test_odd_texts():
    same(ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("abdehinorst  ▁\n\té世\0<0x>19."), st.characters(codec="utf-8")), max_size=40), max_size=4))
def test_any_text(texts):
    same(texts)


def test_pieces_side_by_side():
    """Texts made of pieces, where most pairs of neighbours merge across."""
    rng, pieces = random.Random(1), TABLES.symbols[259 : TABLES.pieces]
    same(["".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))).replace("▁", " ") for _ in range(20_000)])


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(piece_bpe, "KEYS", 5)
    monkeypatch.setattr(piece_bpe, "PAIRS", 3)
    encoder = piece_bpe.Encoder(TABLES)
    texts = ["the quick brown fox", "jumps over the lazy dog", "the quick brown fox"] * 3
    assert [i.tolist() for t in texts for i in encoder.ids([t])] == LIBRARY.encode(texts)


def test_compatible_is_what_plain_merging_keeps():
    rng = random.Random(2)
    ids = {s: i for i, s in enumerate(TABLES.symbols) if TABLES.merges[i] is not None}
    tokens = [i for i in ids.values() if len(TABLES.symbols[i]) < 8]
    for _ in range(5000):
        a, b = rng.choice(tokens), rng.choice(tokens)
        parts, _ = piece_bpe.merged(TABLES.symbols[a] + TABLES.symbols[b], ids, TABLES.scores)
        assert ENCODER.compatible(a, b) == (parts == [TABLES.symbols[a], TABLES.symbols[b]])


def test_every_document(spark):
    """All rows of a table: ids as the library gives them, and the text that it decodes."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = piece_bpe.decode(piece_bpe.encode(docs, PROTO), PROTO).collect()
    assert len(got) == docs.count()
    for row in got:
        assert row.piece_ids == LIBRARY.encode(row.text or "") and row.decoded == LIBRARY.decode(row.piece_ids)


def test_digests(spark):
    import hashlib

    for row in op13_piece_bpe(spark, "/root/testdata/sf0.001").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id"
    ).collect():
        ids = LIBRARY.encode(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()


def test_edges(spark):
    rows = [(None, None, 1, "x"), (1, "", 2, "y"), (2, "ab", 3, "z"), (2, "ab", 3, "z"), (3, "word " * 200_000, 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Piece_Ids int, decoded string")
    told = piece_bpe.decode(piece_bpe.encode(docs, PROTO), PROTO)
    assert told.columns == ["doc_id", "text", "piece_ids", "decoded"]
    got = told.select("doc_id", F.size("piece_ids").alias("n"), "decoded", "text").collect()
    assert sorted(r.n for r in got) == sorted(len(LIBRARY.encode(t or "")) for _, t, *_ in rows)
    assert all(r.decoded == (r.text or "") for r in got)
    assert piece_bpe.encode(docs.limit(0), PROTO).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id long, piece_ids array<int>")
    assert piece_bpe.decode(none, PROTO).first().decoded == ""


def test_other_models_are_refused():
    with pytest.raises(Exception):
        piece_bpe.prepare(b"not a model")


def test_executors_without_the_package():
    run_elsewhere("""
import public_tokenizers
from hazardmarts.llm import piece_bpe
proto = piece_bpe.read_model(public_tokenizers.path("piece_bpe_32k.model"))
docs = spark.createDataFrame([(1, "hello there")], "doc_id long, text string")
assert piece_bpe.decode(piece_bpe.encode(docs, proto), proto).first().decoded == "hello there"
""")

"""Ids and texts have to be exactly those of the sentencepiece library."""

import random

import pytest
import sentencepiece
from pyspark.sql import functions as F

from claimgauge.llm import sentence_pieces as pieces
from claimgauge.llm.registered import piece_model_path, sentence_piece_digests

PATH = piece_model_path()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def made_up(n):
    rng = random.Random(3)
    alphabet = "ab  ▁\n\te ethn  ée日本語🙂́\0⁇ñ<s>�"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    return [*texts, *(" " * k for k in range(40)), *("a" * k for k in range(100)), "=-" * 5000, " " * 20000, "", "x" * 3000]


def test_ids_and_texts_are_those_of_the_library(library):
    encoder = pieces._Encoder(pieces.PieceModel(PATH), 300)
    texts = made_up(2000)
    for at in range(0, len(texts), 64):
        part = texts[at : at + 64]
        for text, raw in zip(part, encoder.ids(part), strict=True):
            want = library.encode(text)
            assert memoryview(raw).cast("i").tolist() == want
            assert encoder.model.decode(want) == library.decode(want)


def test_any_ids_decode_as_the_library_does(library):
    model, rng = pieces.PieceModel(PATH), random.Random(5)
    for _ in range(2000):
        some = [rng.choice([rng.randrange(32000), rng.randrange(3, 259), rng.randrange(4), 259]) for _ in range(rng.randint(0, 8))]
        assert model.decode(some) == library.decode(some)


def test_documents(spark, documents, library):
    encoded = pieces.encode(documents, PATH)
    assert encoded.columns == [*documents.columns, "ids"]
    for row in pieces.decode(encoded, PATH).collect():
        assert row.ids == library.encode(row.text)
        assert row.decoded == library.decode(row.ids)


def test_edge_rows(spark, library):
    import hashlib

    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a  b"), (4, "a"), (4, "a")], "doc_id long, text string")
    docs = docs.withColumns({"ids": F.lit("x"), "decoded": F.lit(1), "__text": F.lit("y")})
    out = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in out), key=str) == sorted(
        [(1, [], ""), (2, [], ""), (None, library.encode("a  b"), "a  b"), (4, [264], "a"), (4, [264], "a")], key=str
    )
    digests = {r.doc_id: r for r in sentence_piece_digests(docs, PATH).collect()}
    assert digests[1].n_tokens == 0 and digests[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert digests[4].ids_sha256 == hashlib.sha256(b"264").hexdigest()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sentence_piece_digests(docs, PATH).count() == 0

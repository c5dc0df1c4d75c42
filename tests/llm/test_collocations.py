"""Phrases against plain counting of strings."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import collocations as C

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def plain(rows, longest=3, least=10, top=2000):
    """The contract over (lang, text) rows."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + n])] += 1
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in good.items():
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = any(
                len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in good.items()
            )
            if not inside:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def listed(frame):
    assert frame.columns == COLUMNS
    return sorted(tuple(r) for r in frame.collect())


@pytest.fixture(scope="module")
def some(documents):
    return documents.where(F.length("text") < 6000).select("lang", "text")


def test_phrases_of_documents(some):
    rows = [tuple(r) for r in some.collect()]
    want = plain(rows)
    assert len(want) > 100
    assert listed(C.collocations(some)) == want


@pytest.mark.parametrize("sizes", [{"bits": 12}, {"bits": 40, "flush": 500, "batch_bytes": 1000, "bucket_bytes": 2000}])
def test_shared_fingerprints_and_small_parts_change_nothing(some, sizes):
    """With 12 bits thousands of n-grams share each fingerprint."""
    rows = [tuple(r) for r in some.collect()]
    assert listed(C.collocations(some.repartition(5), **sizes)) == plain(rows)


def test_longer_phrases_and_short_lists(some):
    rows = [tuple(r) for r in some.collect()]
    assert listed(C.collocations(some, longest=4, least=4, top=50)) == plain(rows, longest=4, least=4, top=50)


def test_blocks_of_words_change_nothing():
    words = C.Words([b"one two three. four five one two three", b"one two", b"", b"x\ty  Z"])
    whole = {(n, k, int(h)) for n, first, fp, _ in words.hashed((1, 2, 3)) for k, h in zip(first, fp, strict=True)}
    parts = {(n, k, int(h)) for n, first, fp, _ in words.hashed((1, 2, 3), block=2) for k, h in zip(first, fp, strict=True)}
    assert whole == parts
    by_phrase = {}
    for n, k, h in whole:
        by_phrase.setdefault(words.phrase(k, n), set()).add(h)
    assert all(len(h) == 1 for h in by_phrase.values()) and len({min(h) for h in by_phrase.values()}) == len(by_phrase)
    assert by_phrase.keys() >= {"one two three", "x y z", "four five one"} and "three four" not in by_phrase


def test_the_filter_passes_all_frequent_parts(spark):
    import numpy as np

    fps = np.random.default_rng(5).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    found = spark.createDataFrame([(2, int(x)) for x in fps.view(np.int64)], "n int, fp long")
    bits = C._frequent_parts(found, 2, 64)
    place = C._filter_place(fps, 64)
    assert ((bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).all()
    assert int(np.unpackbits(bits).sum()) == len(np.unique(place)) and bits.nbytes == 16 << 20


def test_edge_rows(spark):
    texts = [(None, "a b a b a b"), ("en", None), ("en", ""), ("en", "..."), ("en", "A b"), (None, "a b ab\x0bc d")]
    rows = texts * 6 + [("de", "wort " * 5000), ("de", "é é")] * 12 + [("fr", "x" * 200_000 + " y")] * 10
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"phrase": F.lit(1), "fp": F.lit("x"), "doc_id": F.lit(None)})
    want = plain(rows)
    assert {r[0] for r in want} == {"und", "de", "fr"}
    assert listed(C.collocations(docs)) == want


def test_large_counts_are_exact(spark):
    known = spark.createDataFrame([(3 * 10**12,)], "a long")
    score = "(cast(1000000 as decimal(7, 0)) * cast(cast(a as decimal(19, 0)) * a as decimal(31, 0))) div (cast(a as decimal(19, 0)) * cast(a + 1 as decimal(19, 0)))"
    assert known.select(F.expr(score)).first()[0] == 10**6 * (3 * 10**12) ** 2 // (3 * 10**12 * (3 * 10**12 + 1))


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "lang string, text string")).collect() == []

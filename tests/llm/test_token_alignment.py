"""Alignments against a plain walk over all byte ranges with the libraries' tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimgauge.llm import registered
from claimgauge.llm import token_alignment as T

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
ZEROS = (0, 0, 0, 0, 0, 0, "")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def decoder():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    table = {chr(b): b for b in visible}
    table.update({chr(256 + n): b for n, b in enumerate(hidden)})
    return table


def tokens(libraries, text):
    """(id, bytes) of both sides, or None where they do not spell the text."""
    a, b = libraries
    table, raw = decoder(), (" " + text).encode()
    left = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(table[c] for c in t)) for i, t in zip(left.ids, left.tokens, strict=True)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        spelled = bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
        right.append((i, spelled))
    if b"".join(x for _, x in left) != raw or b"".join(x for _, x in right) != raw:
        return None
    return left, right


def ranges(side):
    at, out = 0, []
    for i, spelled in side:
        out.append((i, at, at + len(spelled)))
        at += len(spelled)
    return out


def plain(libraries, texts):
    """The contract, by comparing neighbouring byte ranges one by one."""
    links, shown = [], []
    for text in texts:
        both = tokens(libraries, text) if text else None
        if not both:
            links.append(None)
            shown.append(None)
            continue
        left, right = ranges(both[0]), ranges(both[1])
        links.append([(a, b) for a, s, e in left for b, x, y in right if s < y and x < e])
        cuts = sorted({e for _, _, e in left} & {e for _, _, e in right})
        groups, low = [], 0
        for cut in cuts:
            part = ["|".join([",".join(str(i) for i, _, e in side if low < e <= cut)]) for side in (left, right)]
            groups.append("|".join(part))
            low = cut
        shown.append((len(left), len(right), groups))
    count = Counter(pair for some in links if some for pair in some)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for some, what in zip(links, shown, strict=True):
        if some is None:
            out.append(ZEROS)
            continue
        n_a, n_b, groups = what
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        top = sum(count[p] == best[p[1]] for p in some)
        out.append((n_a, n_b, len(groups), len(some), top, sum(count[p] for p in some), digest))
    return out


def results(frame):
    return sorted(
        ((r.doc_id, (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)) for r in frame.collect()), key=str
    )


def made_up(n):
    rng = random.Random(11)
    alphabet = ["the ", "ing", " of", "ation", "\n", "  ", "é", "日本", "🙂", "a", "Q", "1", "<|endoftext|>", "<s>", "=-", "\t"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_rows_are_those_of_the_plain_version(spark, libraries):
    texts = [*made_up(120), None, "", " ", "same text", "same text", "▁", "a▁b", "\0", "x" * 3000, "<|endoftext|>", "ﬁ ½ ①"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = sorted(((i, row) for i, row in enumerate(plain(libraries, texts))), key=str)
    for sizes in ({}, {"chunk_bytes": 400, "stretch_bytes": 7}):
        assert results(T.align(docs, A_PATH, B_PATH, **sizes)) == want


def test_words_of_a_are_those_of_its_tokenizer(libraries):
    """Stable characters are split here, and all others by the tokenizer itself."""
    rng, both = random.Random(6), T.Tokenizers(A_PATH, B_PATH, cache_words=3000)
    plain = [chr(c) for c in range(0x370)] + [chr(c) for c in range(0x2010, 0x2028)] + list("   \t\n\r'stredvml  aA1") * 30
    other = [*plain, "\u2028", "\u3000", "日", "🙂", "א", "\u0600", "٣", "\ufeff", "\u200b"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 30))) for some in (plain, other) for _ in range(4000)]
    for at in range(0, len(texts), 100):
        part = [" " + t for t in texts[at : at + 100]]
        for text, ids in zip(part, both.encode_a(part), strict=True):
            assert ids.tolist() == libraries[0].encode(text, add_special_tokens=False).ids, repr(text)


def test_query_over_whole_documents(spark, sf_dir, documents, libraries):
    rows = documents.select("doc_id", "text").collect()
    short = [r for r in rows if len(r.text or "") < 4000]  # the plain version is quadratic in a text
    got = {r.doc_id: r for r in registered.queries()["op13_token_alignment"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for row, want in zip(short, plain(libraries, [r.text for r in short]), strict=True):
        r = got[row.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256) == (*want[:4], want[6])


def test_lockstep_equals_a_loop_for_any_stretch():
    rng = np.random.default_rng(2)
    for _ in range(60):
        ends, a, b = [], [], []
        for _ in range(rng.integers(1, 6)):
            low = ends[-1] if ends else 0
            high = low + int(rng.integers(1, 60))
            ends.append(high)
            for side in (a, b):
                cuts = np.flatnonzero(rng.random(high - low - 1) < 0.4) + low + 1
                side.extend([*cuts.tolist(), high])
        want, i, j = [], 0, 0
        while i < len(a):
            want.append((i, j, a[i] == b[j]))
            x, y = a[i], b[j]
            i += x <= y
            j += y <= x
        for stretch in (1, 3, 16, 1000):
            got = T.merge_lockstep(np.array(a), np.array(b), np.array(ends), stretch)
            assert list(zip(*(x.tolist() for x in got), strict=True)) == want


def test_groups_can_be_kept_and_clashing_columns_are_replaced(spark, libraries):
    docs = spark.createDataFrame([(1, "tokens align", "x", 7)], "doc_id long, text string, n_a string, al_chunk long")
    row = T.align(docs, A_PATH, B_PATH, keep_groups=True).collect()[0]
    assert row.al_chunk == 7 and row.n_a == len(tokens(libraries, "tokens align")[0])
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256


def test_null_and_repeated_ids(spark, libraries):
    docs = spark.createDataFrame([(None, "one two"), (None, "one two"), (3, None)], "doc_id long, text string")
    want = plain(libraries, ["one two", "one two", None])
    assert results(T.align(docs, A_PATH, B_PATH)) == sorted([(None, want[0]), (None, want[1]), (3, ZEROS)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string").withColumn("text", F.col("text"))
    assert T.align(docs, A_PATH, B_PATH).count() == 0

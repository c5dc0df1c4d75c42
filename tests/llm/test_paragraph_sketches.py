"""Recovered paragraphs against sets, and edited texts against plain slicing."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import paragraph_sketches as P

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def paragraphs(text):
    return {p for p in re.split(r"[.,;:!?][ \t]+|\n+", text) if p}


def alike(one, other):
    a, b = paragraphs(one), paragraphs(other)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows, tie):
    """(id, length, digest of the edited text, both likenesses) of each row; ``tie`` gives a text's hash."""
    known = sorted({(i is None, i or 0, tie[t or ""], t or "") for i, t in rows})
    after = {k: known[(n + 1) % len(known)][3] for n, k in enumerate(known)}
    out = []
    for i, t in rows:
        text = t or ""
        following = after[(i is None, i or 0, tie[text], text)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, alike(text, edited), alike(text, following)))
    return sorted(out, key=str)


def checked(spark, docs, frame=None):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    tie = {r.t: r.h for r in docs.select(F.coalesce("text", F.lit("")).alias("t")).select("t", F.xxhash64("t").alias("h")).distinct().collect()}
    frame = P.version_report(docs) if frame is None else frame
    assert frame.columns == COLUMNS
    got = frame.collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=str) == plain(rows, tie)
    return got


def test_query_over_whole_documents(spark, sf_dir, documents):
    from claimgauge.llm import registered

    got = checked(spark, documents, registered.queries()["op11_paragraph_sketches"](spark, sf_dir))
    prints = {}
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in got:
        assert prints.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint


def test_recovered_digests_are_the_set_differences(spark):
    rng = random.Random(4)
    rows = []
    for size in [0, 1, 3, 8, 12, 20, 60, 300, 2500]:
        for shared in (0.0, 0.5, 0.95, 1.0):
            common = [f"w{rng.random()}" for _ in range(int(size * shared))]
            one, two = ([f"w{rng.random()}" for _ in range(size - len(common))] for _ in range(2))
            rows.append(("\n".join(common + one), "\n".join(common + two)))
    frame = spark.createDataFrame(rows, "x string, y string").select(P.digests(F.col("x")).alias("a"), P.digests(F.col("y")).alias("b"))
    frame = frame.select("*", *(F.expr(P.sketch(c)).alias(f"cells_{c}") for c in "ab"))
    frame = frame.select("*", P.differences("a", "b", "cells_a", "cells_b").alias("d"))
    for row in frame.collect():
        assert sorted(row.d.l) == sorted(set(row.a) - set(row.b))
        assert sorted(row.d.r) == sorted(set(row.b) - set(row.a))


def test_small_differences_need_no_larger_sketch(spark):
    """Texts of any length, some paragraphs apart: the 24 cells are enough."""
    lines = [f"line {i}" for i in range(3000)]
    row = spark.createDataFrame([("\n".join(lines), "\n".join(["new", *lines[2:]]))], "x string, y string")
    row = row.select(P.digests(F.col("x")).alias("a"), P.digests(F.col("y")).alias("b"))
    row = row.select(*(F.expr(P.sketch(c)).alias(c) for c in "ab")).select(F.expr(P._peeled(P._subtracted("a", "b"), P.BITS)).alias("d")).first().d
    assert row.ok and len(row.l) == 2 and len(row.r) == 1


@pytest.mark.parametrize("partitions", [1, 7])
def test_edge_rows(spark, partitions):
    rows = [(5, "A b. C d."), (5, "A b. C d."), (5, "other, text"), (2, None), (3, ""), (None, "last\n\nlast"), (None, "é🙂" * 40), (9, "no end")]
    rows += [(20 + i, f"word{i}, and. " * 3 + "tail " * i) for i in range(40)] + [(7, "x. " * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    docs = docs.withColumns({"kn": F.lit("x"), "copies": F.lit("y"), "tie": F.lit(1), "n_chars": F.lit(0)})
    got = checked(spark, docs)
    empty = [r.fingerprint for r in got if r.doc_id in (2, 3)]
    assert empty[0] == empty[1]


def test_one_document_and_none(spark):
    one = spark.createDataFrame([(1, "a. b. c. d. e. f.")], "doc_id long, text string")
    checked(spark, one)
    assert P.version_report(one.limit(0)).collect() == []


def test_only_column_functions(spark, documents):
    plan = P.version_report(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

"""Forward-backward against a sum over all paths, held-out quality, edge cases."""

from itertools import product

import numpy as np
from pyspark.sql import functions as F

from claimgauge.llm import line_quality as lines
from claimgauge.llm.registered import op3_line_quality

SMALL = lines.CrfPlan(sample_docs=200, steps=40)


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(2)
    model = lines.LineField(SMALL, follow=rng.normal(size=(2, 2)))
    sizes = [1, 4, 2, 5]
    doc = np.repeat(np.arange(4), sizes)
    emission = rng.normal(size=len(doc))
    bad, pairs, total = model.marginals(emission, doc)
    want, want_pairs, want_total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in sizes:
        e = emission[at : at + n]
        at += n
        paths = list(product((0, 1), repeat=n))
        weight = np.array([np.exp(sum(e[i] * p[i] for i in range(n)) + sum(model.follow[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        want_total += np.log(weight.sum())
        weight /= weight.sum()
        want += [sum(w for w, p in zip(weight, paths) if p[i]) for i in range(n)]
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += w
    assert np.allclose(bad, want) and np.allclose(pairs, want_pairs) and np.isclose(total, want_total)


def test_features_of_a_small_text():
    own, size, doc = lines.own_features(["A b\n\nDUP 1\nDUP 1", "", "x x x"])
    assert size.tolist() == [3, 5, 5, 5] and doc.tolist() == [0, 0, 0, 2]
    assert own[:, 8].tolist() == [0, 0, 1, 0]  # equal to an earlier line
    assert np.allclose(own[3, 6:8], [2 / 3, 2 / 3])
    assert lines.with_neighbours(own, doc)[3, lines.N_OWN :].tolist() == [0.0] * (2 * lines.N_OWN)


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = op3_line_quality(spark, sf).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert len(good) > 50 and len(bad) > 5
    assert np.mean([[g > b for g in good] for b in bad]) > 0.95
    assert np.mean([g >= 0.5 for g in good]) > 0.97


def test_edge_rows(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = lines.train(documents, labels, SMALL)
    rows = [(1, None), (2, ""), (3, " \n\t\n"), (4, "ok"), (4, "ok"), (None, "the cat\n" * 30_000), (6, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("q"), "predicted": F.lit(3)})
    out = lines.score(docs, model).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.score for r in out if r.doc_id in (1, 2, 3)} == {SMALL.empty_score}
    untrained = lines.train(documents, labels.where("quality = 1"), SMALL)
    assert {r.score for r in lines.score(docs, untrained).collect()} == {SMALL.empty_score}
    assert lines.score(docs.limit(0), model).count() == 0

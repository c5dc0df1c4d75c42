"""Held-out accuracy of the network, its gradient, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from claimgauge.llm import languages
from claimgauge.llm.registered import held_out, op2_languages

SMALL = languages.NetPlan(sample_docs=60, windows_per_doc=3, epochs=4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = op2_languages(spark, sf).join(lang, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_gradient_is_that_of_the_loss():
    plan = languages.NetPlan(window=12, filters=3, embedding=2, widths=(2, 3))
    net = languages.ByteNet(plan, ["a", "b"])
    net.start()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    rng = np.random.default_rng(0)
    x, y, share = rng.integers(60, 70, (4, 12)), np.array([0, 1, 1, 0]), np.ones(4)

    def loss():
        p = languages._softmax(net._forward(x)[0])
        return -np.log(p[np.arange(4), y]).mean()

    grad = net._gradient(x, y, share)
    for name, at in (("conv3", (1, 0, 2)), ("conv2", (0, 1, 1)), ("out", (2, 1)), ("emb", (65, 1)), ("bias3", (1,))):
        kept = net.weights[name][at]
        net.weights[name][at] = kept + 1e-5
        up = loss()
        net.weights[name][at] = kept - 1e-5
        down = loss()
        net.weights[name][at] = kept
        assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-5


def test_lookup_tables_give_the_network():
    net = languages.ByteNet(languages.NetPlan(widths=(2, 3, 4)), ["a", "b", "c"])
    net.start()
    x, _ = languages.windows_of(["hällo wörld " * 40, "", "x"], net.plan.window)
    want = languages._softmax(net._forward(x.astype(np.int64))[0])
    assert np.allclose(net.probabilities(x, net.tables()), want, atol=1e-4)


def test_edge_rows(spark, documents):
    net = languages.train(documents, SMALL)
    rows = [(1, None), (2, ""), (3, "12 34 !?\n"), (4, "ok"), (4, "ok"), (None, "the " * 60_000), (6, "日本語")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang_pred": F.lit("zz"), "score": F.lit("q")})
    out = languages.predict(docs, net).collect()
    assert sorted((r.doc_id or 0) for r in out) == [0, 1, 2, 3, 4, 4, 6]
    by_id = {r.doc_id: r for r in out}
    assert {by_id[i].lang_pred for i in (1, 2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in out) and by_id[4].lang_pred in net.classes
    docs = docs.withColumn("lang", F.lit(None).cast("string"))
    none = languages.train(docs)
    assert {r.lang_pred for r in languages.predict(docs, none).collect()} == {"und"}
    assert languages.predict(docs.limit(0), net).count() == 0


def test_folds(spark):
    import zlib

    ids = [*range(50), -3, 10**12]
    out = spark.createDataFrame([(i,) for i in ids] + [(None,)], "doc_id long").select("doc_id", held_out().alias("h"))
    for r in out.collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)

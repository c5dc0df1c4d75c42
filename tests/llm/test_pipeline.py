"""Every stage of the pipeline against its plain version, each on its own input."""

import sentencepiece
from pyspark.sql import functions as F
from test_fuzzy_lines import brute as brute_lines
from test_near_documents import brute as brute_near
from test_quality_rules import brute as brute_measures
from test_quality_rules import failed

import corpus_pipeline as pipeline
from claimgauge.llm.registered import piece_model_path
from claimgauge.sources.scratch import stage


def small(documents):
    return documents.where("length(text) < 1500").orderBy("doc_id").limit(90)


def rows(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages(spark, documents, sf_dir):
    docs = stage(small(documents), "pipeline-test")
    steps = dict(pipeline.STAGES)
    assert list(steps) == ["quality_rules", "line_dedup", "near_dedup", "mixing", "sentence_pieces"]

    good = stage(steps["quality_rules"](spark, docs, sf_dir), "pipeline-test")
    assert good.columns == docs.columns
    assert rows(good) == {i: t for i, t in rows(docs).items() if not failed(brute_measures(t))}

    clean = stage(steps["line_dedup"](spark, good, sf_dir), "pipeline-test")
    assert clean.columns == docs.columns
    lost = brute_lines(list(rows(good).items()))
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in lost[i]) for i, t in rows(good).items()}
    assert rows(clean) == {i: t for i, t in want.items() if t.split()}

    single = stage(steps["near_dedup"](spark, clean, sf_dir), "pipeline-test")
    assert single.columns == docs.columns
    found = brute_near(list(rows(clean).items()))
    assert rows(single) == {i: t for i, t in rows(clean).items() if found[i][1] == i}

    mix = stage(steps["mixing"](spark, single, sf_dir), "pipeline-test")
    assert mix.columns == docs.columns and mix.count() > 0
    total = sum(len(t.split()) for t in rows(single).values())
    assert abs(sum(len(r.text.split()) for r in mix.collect()) - total) <= 64 * 25

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    out = steps["sentence_pieces"](spark, mix, sf_dir)
    want = sorted((r.doc_id, len(library.encode(r.text))) for r in mix.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == want


def test_odd_rows_pass_through_every_stage(spark, documents, sf_dir):
    odd = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "a " * 50, None, "s", 1), (1, "a " * 50, None, "s", 1)]
    odd += [(None, " ".join(f"w{i}" for i in range(40)), "en", "s", 1), (7, " ".join(f"v{i}" for i in range(20_000)), None, None, None)]
    docs = spark.createDataFrame(odd, documents.schema).withColumns({"row": F.lit("r"), "size": F.lit(1), "kept": F.lit(True)})
    for part in (docs, docs.limit(0)):
        frame = part
        for name, step in pipeline.STAGES:
            frame = stage(step(spark, frame, sf_dir), f"odd-{name}")
            if name != "sentence_pieces":
                assert frame.columns == docs.columns
        assert frame.count() >= 0


def test_texts_of_one_id_are_judged_apart(spark, documents, sf_dir):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    texts = [(7, a), (7, b), (8, b + " more"), (9, a + " more"), (3, c), (3, c), (3, c + " end"), (4, ""), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], documents.schema)
    out = dict(pipeline.STAGES)["near_dedup"](spark, docs, sf_dir).collect()
    kept = sorted(((r.doc_id, r.text) for r in out), key=str)
    assert [i for i, _ in kept].count(7) == 2 and {t for i, t in kept if i == 7} == {a, b}
    assert len([1 for i, _ in kept if i == 3]) == 1 and {i for i, _ in kept} == {3, 4, 7}

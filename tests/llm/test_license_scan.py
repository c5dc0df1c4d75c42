"""Families on unseen wordings, features against plain Python, edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import license_scan as scan
from claimgauge.llm.license_texts import LOOKALIKES, NOTICES


@pytest.fixture(scope="module")
def model(spark, documents):
    return scan.train(documents)


def families(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in scan.scan(docs, model).collect()}


def test_notices_and_lookalikes(spark, model):
    known = [(f, t) for f, texts in NOTICES.items() for t in texts]
    out = families(spark, model, [t for _, t in known])
    assert sum(out[i].family == f for i, (f, _) in enumerate(known)) >= len(known) - 1
    out = families(spark, model, LOOKALIKES)
    assert not [LOOKALIKES[i] for i, r in out.items() if r.n_confirmed]


def test_unseen_wordings(spark, model):
    texts = {
        "Apache-2.0": "This repository is made available and licensed under the Apache License, Version 2.0, see below",
        "MIT": "All code here is released under the MIT License",
        "GPL": "you may copy it, as it is licensed under the GNU General Public License, version 3 or later",
        "CC-BY-NC": "Images: licensed under CC BY-NC 4.0 unless noted",
    }
    out = families(spark, model, ["first line\n" + t + "\nlast line" for t in texts.values()])
    assert [out[i].family for i in range(len(texts))] == list(texts)
    assert all([p.paragraph for p in r.paragraphs if p.confirmed] == [1] for r in out.values())


def test_documents_against_a_plain_search(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
        "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    }
    want = {}
    for r in docs.select("doc_id", "text").collect():
        found = [lines[x] for x in re.split("\n", r.text) if x in lines]
        want[r.doc_id] = found[0] if found else None
    got = {r.doc_id: r.family for r in scan.scan(docs, model).collect()}
    assert got == want and any(want.values())


def test_edge_rows(spark, model):
    mit = "Released under the MIT License."
    rows = [(1, None), (2, ""), (3, mit), (3, mit), (None, mit), (4, "\n\n" + mit), (5, "license " * 40_000), (3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"family": F.lit(1), "gram": F.lit("g"), "version": F.lit(2)})
    out = scan.scan(docs, model).collect()
    assert len(out) == len(rows)
    assert sorted((r.doc_id or 0, r.family, r.n_confirmed) for r in out if r.family) == [(0, "MIT", 1), (3, "MIT", 1), (3, "MIT", 1), (4, "MIT", 1)]
    assert scan.scan(docs.limit(0), model).count() == 0
    assert scan.train(docs.limit(0)).weights


#: notices as they are published, wrapped at 70 to 80 columns
WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
}


def test_wrapped_notices(spark, model):
    out = families(spark, model, ["Title of it\n\n" + t + "\n\nmore words" for t in WRAPPED.values()])
    assert [out[i].family for i in range(len(WRAPPED))] == list(WRAPPED)
    for i, t in enumerate(WRAPPED.values()):
        assert [(p.paragraph, p.lines) for p in out[i].paragraphs if p.confirmed] == [(2, len(t.split("\n")))]
    # comment marks alone break paragraphs
    out = families(spark, model, ["/*\n" + "\n".join(" * " + x for x in t.split("\n")) + "\n */\nint main() {\n}" for t in WRAPPED.values()])
    assert [out[i].family for i in range(len(WRAPPED))] == list(WRAPPED)


def test_notices_beyond_the_first_line(spark, model):
    """Parts of licence texts as they are published, in other line lengths, and short forms."""
    texts = {
        "MIT": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
        "MPL": "Mozilla Public License Version 2.0",
        "EPL": "Eclipse Public License - v 2.0",
        "Zlib": """  This software is provided 'as-is', without any express or implied
  warranty. In no event will the authors be held liable for any damages
  arising from the use of this software.""",
        "BSD": "@license BSD-3-Clause",
    }
    out = families(spark, model, list(texts.values()))
    assert [out[i].family for i in range(len(texts))] == list(texts)
    out = families(spark, model, ["Released under the MIT Licence", "the warranty of the software is provided by the holders of the copyright"])
    assert out[0].family == "MIT" and out[1].n_confirmed == 0


def test_features_and_coverage_against_plain_python(spark, model):
    """Scores, templates and coverage of paragraphs of one line, computed without Spark."""
    import math

    texts = [t for part in NOTICES.values() for t in part][::3] + LOOKALIKES[::4] + ["Licensed, said the fox, under the MIT license of old", "GNU GNU public"]
    weight = {row[0]: row[1:] for row in model.weights}
    templates = {}
    for r in scan.templates(spark).collect():
        templates.setdefault((r.family, r.template), set()).add(r.gram)
    want = {}
    for i, text in enumerate(texts):
        words = re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", text.lower())
        grams = {" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)}
        hit = [weight[g] for g in grams if g in weight]
        if not hit or not set(words) & set(model.telling):
            continue
        logits = [b + sum(h[j] for h in hit) for j, b in enumerate(model.intercepts)]
        best, family = max((x, f) for x, f in zip(logits[:-1], model.families, strict=False))
        score = 1 / (1 + math.exp(-(model.known[0] + model.known[1] * (best - logits[-1]))))
        if score >= model.plan.least_known:
            cover = max(len(grams & g) / len(g) for (f, _), g in templates.items() if f == family)
            want[i] = (family, round(score, 6), round(cover, 6))
    out = families(spark, model, texts)
    got = {i: (r.paragraphs[0].family, round(r.paragraphs[0].score, 6), round(r.paragraphs[0].coverage, 6)) for i, r in out.items() if r.paragraphs}
    assert got == want and len(want) > 15


def test_only_runs_with_a_wanted_word_at_each_place_become_rows(spark):
    from claimgauge.llm import license_scan

    wanted = spark.createDataFrame([("mit",), ("mit license",), ("of this software",), (None,)], "gram string")
    places = license_scan._words_by_place(wanted)
    assert places == {1: [["mit"]], 2: [["mit"], ["license"]], 3: [["of"], ["this"], ["software"]]}
    # mit and of open runs here that nothing wants
    words = "of the mit house of this software of this mit license".split()
    rows = spark.createDataFrame([(words, [0] * 5 + [1] * 6, [i for i, w in enumerate(words) if w in ("mit", "of")])], "words array<string>, line_of array<int>, opened array<int>")
    (found,) = rows.select(license_scan._placed_grams(places).alias("runs")).collect()
    assert sorted(tuple(r) for r in found.runs) == [("mit", 0, 0), ("mit", 1, 1), ("mit license", 1, 1), ("of this software", 0, 1)]

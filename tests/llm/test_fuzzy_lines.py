"""Dropped lines against brute force over all pairs of lines."""

import random
from itertools import combinations

from pyspark.sql import functions as F
from test_near_documents import groups

from claimgauge.llm import fuzzy_lines

SCHEMA = "doc_id long, text string, n_chars long"
BLANKS = " \t\n\x0b\x0c\r"


def shingles(line, width=8):
    line = line.strip(BLANKS).lower()
    return frozenset(line[i : i + width] for i in range(max(1, len(line) - width + 1)))


def brute(rows):
    spots = [(d, k, line) for d, text in rows for k, line in enumerate((text or "").split("\n")) if line.strip(BLANKS)]
    sets = {s: shingles(s[2]) for s in spots}
    pairs = [
        (a, b) for a, b in combinations(spots, 2)
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = groups(sorted(spots), pairs)
    return {d: sorted(k for e, k, line in spots if e == d and found[(e, k, line)] != (e, k, line)) for d, _ in rows}


def test_groups_of_lines(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9)))
    bases = [[word() for _ in range(rng.randint(6, 40))] for _ in range(12)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(6)):
            line = list(rng.choice(bases)) if rng.random() < 0.6 else [word() for _ in range(rng.randint(1, 30))]
            if rng.random() < 0.5:
                line[rng.randrange(len(line))] = word()
            lines.append(" ".join(line).upper() if rng.random() < 0.2 else " ".join(line) + "  ")
        rows.append((d, "\n".join(lines)))
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in fuzzy_lines.line_report(docs).collect()}
    want = brute(rows)
    assert sum(map(len, want.values())) > 40
    missed = sum(got[d].dropped != want[d] for d in want)
    assert missed <= 1  # the bands find a pair at the threshold with probability 0.995
    assert all(got[d].n_lines == len(t.split("\n")) for d, t in rows)


def test_edge_rows(spark):
    rows = [
        (5, "same line here\nown five"), (3, "Same line here \n\n \nown three\nsame line here"), (3, "Same line here \n\n \nown three\nsame line here"),
        (None, "same line here\nx"), (7, None), (8, ""), (9, "\n\n"), (10, "x"), (11, "long " * 30_000), (12, "é" * 9 + "\nÉ" + "é" * 8),
        (3, "other text of three"),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA).withColumns({"doc": F.lit(1), "places": F.lit("p"), "id": F.lit(2)})
    out = sorted(((r.doc_id, r.n_lines, r.dropped) for r in fuzzy_lines.line_report(docs).collect()), key=str)
    assert out == sorted(
        [(5, 2, [0]), (3, 5, [4]), (3, 5, [4]), (None, 2, [0, 1]), (7, 0, []), (8, 1, []), (9, 3, []), (10, 1, []), (11, 1, []), (12, 2, [1]), (3, 1, [])],
        key=str,
    )
    kept = fuzzy_lines.dedup_lines(docs, length="n_chars")
    assert kept.columns == docs.columns
    texts = {(r.doc_id, r.text, r.n_chars) for r in kept.collect()}
    assert {(5, "own five", 8), (3, "Same line here \n\n \nown three", 28), (7, None, None), (None, "", 0), (9, "\n\n", 2)} <= texts
    assert kept.count() == len(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert fuzzy_lines.line_report(docs).count() == 0 and fuzzy_lines.dedup_lines(docs).count() == 0


def edited_pairs(rng, words, joint, least, most, n):
    """Pairs of lines that one to three edits part, with an exact similarity from ``least`` to under ``most``."""
    out = []
    while len(out) < n:
        line = joint.join(rng.choice(words) for _ in range(rng.randint(5, 14)))
        other = list(line)
        for _ in range(rng.randint(1, 3)):
            other[rng.randrange(len(other))] = rng.choice("bcdfgh")
        a, b = shingles(line), shingles("".join(other))
        if a != b and least <= len(a & b) / len(a | b) < most:
            out.append((line, "".join(other)))
    return out


def recall(spark, pairs):
    """Share of pairs, each in two documents of its own, whose second line is dropped."""
    rows = [(2 * i + k, line, 0) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    lost = {r.doc_id for r in fuzzy_lines.line_report(spark.createDataFrame(rows, SCHEMA)).where("n_dropped > 0").collect()}
    return sum(2 * i + 1 in lost for i in range(len(pairs))) / len(pairs)


def test_recall_on_lines_without_blanks_e_or_digits(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdfghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9))) for _ in range(4000)]
    for joint in ",|":
        assert recall(spark, edited_pairs(rng, words, joint, 0.75, 1.0, 400)) >= 0.985


def test_sketches_keep_pairs_of_short_lines():
    rng = random.Random(13)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    plan, one = fuzzy_lines.LinePlan(), [word(rng.choice([10, 13])) for _ in range(3000)]
    two = [line + word(1) for line in one]  # 3 or 6 shingles and one more: Jaccard 0.75 and 0.86
    (a, x), (b, y) = fuzzy_lines.signatures(one, plan), fuzzy_lines.signatures(two, plan)
    met = (fuzzy_lines.buckets(a, plan) == fuzzy_lines.buckets(b, plan)).any(1)
    assert met.sum() > 2900 and fuzzy_lines.may_link(x, y, plan)[met].all()


def test_hashes_are_those_of_distinct_shingles():
    rng = random.Random(3)
    lines = ["".join(rng.choice("abé🙂 ") for _ in range(rng.randint(1, 40))) for _ in range(500)]
    owner, hashes = fuzzy_lines.shingle_hashes(lines, 8)
    seen = {}
    for k, line in enumerate(lines):
        want = [line[i : i + 8] for i in range(max(1, len(line) - 7))]
        got = hashes[owner == k].tolist()
        assert len(got) == len(want)
        for text, h in zip(want, got, strict=True):
            assert seen.setdefault(text, h) == h
    assert len(set(seen.values())) == len(seen)


def test_exact_similarity(spark):
    rng = random.Random(5)
    pairs = []
    for _ in range(600):
        line = [rng.choice("abcd") for _ in range(rng.randint(1, 60))]
        other = list(line)
        for _ in range(rng.randrange(4)):
            other[rng.randrange(len(other))] = rng.choice("abcdx")
        pairs.append(("".join(line), "".join(other)))
    got = fuzzy_lines._linked([a for a, _ in pairs], [b for _, b in pairs], fuzzy_lines.LinePlan())
    want = [100 * len(shingles(a) & shingles(b)) >= 75 * len(shingles(a) | shingles(b)) for a, b in pairs]
    assert got.tolist() == want and 100 < sum(want) < 590


def test_large_buckets_are_split(spark):
    """Lines with a long common beginning share bands without being alike; near copies among them are found."""
    rng = random.Random(2)
    head = "https://www.example.com/a/common/path/"
    pairs = [(head + "".join(rng.choice("abcdefgh") for _ in range(60)),) for _ in range(150)]
    pairs = [(x, x[:-2] + "zz") for (x,) in pairs]
    rows = [(2 * i + k, line, 0) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute([r[:2] for r in rows])
    for large in (4096, 8):
        got = {r.doc_id: r.dropped for r in fuzzy_lines.line_report(docs, fuzzy_lines.LinePlan(large=large)).collect()}
        assert sum(got[d] != want[d] for d in want) <= 3


def test_many_copies_give_few_candidates():
    import numpy as np

    rng = random.Random(8)
    base = "".join(rng.choice("abcdefghijklmnop ") for _ in range(300))
    lines = [base + str(i) for i in range(2000)]
    plan = fuzzy_lines.LinePlan()
    _, sketch = fuzzy_lines.signatures(lines, plan)
    a, b = fuzzy_lines._bucket_pairs(np.arange(2000), sketch, plan)
    assert sum(map(len, b)) < 20 * 2000


def linked_rows(rng, n=40):
    """Documents of one line: edited copies of a few lines, with similarities on both sides of the threshold."""
    bases = ["".join(rng.choice("abcdefghijklmnop ") for _ in range(rng.randint(100, 300))) for _ in range(4)]
    rows = []
    for d in range(n):
        line = list(rng.choice(bases))
        for _ in range(rng.randint(1, 4)):
            line[rng.randrange(5, len(line) - 5)] = rng.choice("qrstuvwxyz")
        rows.append((d, "".join(line)))
    return rows


def test_sketches_leave_no_pair_of_a_bucket_out(spark):
    """Whatever sketches say of the lines of a bucket, all that reach the similarity are linked."""
    rows = linked_rows(random.Random(17))
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    want = brute(rows)
    assert 0 < sum(map(len, want.values())) < 39
    # one entry a band: lines that reach the similarity share a bucket; no sketch fits, or any counts as done
    plan = fuzzy_lines.LinePlan(rows=1, bands=30, least_agreement=31, sure_agreement=0, least_values=0)
    assert {r.doc_id: r.dropped for r in fuzzy_lines.line_report(docs, plan).collect()} == want


def test_lines_of_large_buckets_need_one_band_alone(spark):
    """Blocks of a large bucket meet each other: the result is that of a bucket in one piece."""
    rows = linked_rows(random.Random(19))
    docs = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found = [
        {r.doc_id: r.dropped for r in fuzzy_lines.line_report(docs, fuzzy_lines.LinePlan(rows=1, bands=1, large=large)).collect()}
        for large in (3, 10**6)
    ]
    assert found[0] == found[1] and sum(map(len, found[0].values())) > 0


def test_bound_on_sets_passes_every_linked_pair():
    import numpy as np

    rng = random.Random(23)
    lines = [line for _, line in linked_rows(rng, 150)] + ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(50)]
    sets = fuzzy_lines._Sets(lines, fuzzy_lines.LinePlan())
    x, y = np.triu_indices(len(lines), 1)
    want = [100 * len(shingles(lines[i]) & shingles(lines[j])) >= 75 * len(shingles(lines[i]) | shingles(lines[j])) for i, j in zip(x, y, strict=True)]
    assert sets.linked(x, y).tolist() == want and sum(want) > 100
    assert set(np.flatnonzero(want)) <= set(sets.may_link(x, y).tolist()) and len(sets.may_link(x, y)) < len(x) / 2

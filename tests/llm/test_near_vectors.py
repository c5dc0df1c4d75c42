"""Links and components against all pairs."""

import math

import numpy as np
from pyspark.sql import functions as F

from claimgauge.llm import near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.9):
    known = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    x = np.stack([v / np.sqrt(v @ v) for _, v in known])
    linked = x @ x.T >= least
    np.fill_diagonal(linked, False)
    out = {i: (0, i) for i, _ in rows}
    label = np.array([i for i, _ in known])
    while True:
        new = np.array([min([label[k], *label[linked[k]]]) for k in range(len(label))])
        if (new == label).all():
            break
        label = new
    return out | {i: (int(linked[k].sum()), int(label[k])) for k, (i, _) in enumerate(known)}


def check(spark, rows, **settings):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors.near_vectors(frame, near_vectors.HashPlan(**settings)).collect()}
    assert got == brute(rows)


def test_groups(spark):
    rng = np.random.default_rng(1)
    rows = [rng.normal(size=32) for _ in range(300)]
    for base, n, noise in ((0, 40, 0.03), (1, 30, 0.12), (2, 25, 0.25), (3, 20, 0.0)):
        rows += [rows[base] + rng.normal(size=32) * noise for _ in range(n)]
    rows += [rows[5] * 7, rows[5] * 1e-3]
    order = rng.permutation(len(rows))
    check(spark, [(int(i) * 3 - 50, rows[k].tolist()) for i, k in enumerate(order)], block=16)


def test_edge_rows(spark):
    nan, inf = math.nan, math.inf
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 3.0]), (5, [nan, 1.0, 1.0]), (6, [inf, 1.0, 1.0]),
        (9, one), (7, one), (8, [2.0, 4.0, 6.0]), (10, [-1.0, -2.0, -3.0]), (11, [1.0, 2.0]), (None, one), (9, one),
    ]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).withColumns({"vector": F.lit(1), "member": F.lit("m")})
    out = near_vectors.near_vectors(frame).collect()
    assert len(out) == len(rows)
    got = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in out}
    alone = {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 11)}
    assert got == alone | {(None, 0, None, True), (7, 3, 7, True), (8, 3, 7, False), (9, 3, 7, False)}
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0


def test_tables_follow_from_the_recall():
    plan = near_vectors.HashPlan()
    k, tables = plan.shape(50_000)
    near = plan.together(math.sqrt(2 - 2 * plan.least_cosine)) ** k
    assert 1 - (1 - near) ** tables >= plan.recall
    assert 50_000 * plan.together(math.sqrt(2)) ** k <= 1


def test_recall_in_one_projection():
    plan, rng = near_vectors.HashPlan(), np.random.default_rng(0)
    a = rng.normal(size=200_000)
    d = math.sqrt(0.2)
    b = a * 0 + rng.normal(size=200_000) * d
    shift = rng.uniform(0, plan.cell, 200_000)
    same = np.floor((a + shift) / plan.cell) == np.floor((a + b + shift) / plan.cell)
    assert abs(same.mean() - plan.together(d)) < 0.01


def test_an_id_of_several_vectors_does_not_tie_their_groups(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [1.0, 0.1, 0.0, 0.0], [0.1, 1.0, 0.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (2, near_a, 0), (3, near_b, 0), (4, near_b, 0)]
    out = near_vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in out) == [
        (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False), (4, 2, 1, False),
    ]
    apart = near_vectors.near_vectors(spark.createDataFrame([(5, a, 0), (5, b, 0), (2, near_a, 0), (3, near_b, 0)], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component_id) for r in apart) == [(2, 2), (3, 3), (5, 2), (5, 3)]


def test_links_near_the_threshold_are_found(spark):
    """Cosines from 0.90 to 0.92, measured on the operator."""
    rng = np.random.default_rng(8)
    rows = [rng.normal(size=48) for _ in range(2000)]
    pairs = 0
    for k in range(400):
        base = rows[k] / np.sqrt(rows[k] @ rows[k])
        other = rng.normal(size=48)
        other -= (other @ base) * base
        other /= np.sqrt(other @ other)
        cosine = rng.uniform(0.9001, 0.92)
        rows.append(cosine * base + math.sqrt(1 - cosine**2) * other)
        pairs += 1
    frame = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in near_vectors.near_vectors(frame).collect()) / 2
    assert found >= 0.985 * pairs

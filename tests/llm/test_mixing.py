"""Apportionment against its definition, mixes against their targets."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from claimgauge.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long"


def by_quotients(votes, seats, most):
    got = [0] * len(votes)
    for _ in range(seats):
        free = [i for i, v in enumerate(votes) if v and got[i] < most[i]]
        if not free:
            break
        got[max(free, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


@pytest.mark.parametrize("seed", range(20))
def test_seats_are_those_of_the_highest_quotients(seed):
    rng = random.Random(seed)
    votes = [rng.choice([0, 1, rng.randrange(50), rng.randrange(5000)]) for _ in range(rng.randint(1, 12))]
    seats = rng.randrange(200)
    most = [rng.choice([1000, rng.randrange(60)]) for _ in votes]
    assert mixing.sainte_lague(votes, seats, most) == by_quotients(votes, seats, most)


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([100, 10, 10], [1, 2, 3], 3) == [60.0, 30.0, 30.0]
    assert mixing.targets([10, 10], [1, 3], 3) == [5.0, 15.0]
    assert mixing.targets([0, 0], [1, 2], 3) == [0.0, 0.0]


def number(seed, part, *keys):
    text = ":".join([f"{seed}:{part}", *("null" if k is None else str(k) for k in keys)])
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain(rows, plan):
    """The whole mix of (id, text, source) rows, word by word: sorted (id, text, taken)."""
    docs = [(i, t, s, len(re.findall("[^\x20\x09-\x0d]+", t or ""))) for i, t, s in rows]
    names = sorted({s for _, _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    sizes = [sum(n for _, _, s, n in docs if s == name) for name in names]
    goals = mixing.targets(sizes, [(1, 2, 3)[i % 3] for i in range(len(names))], 3)
    block = max(1, min(plan.block_words, int(min([g for g in goals if g > 0], default=1024) / 16)))
    seats = by_quotients([round(g) for g in goals], max(1, round(sum(goals) / block)), [10**9] * len(names))
    out = []
    for name, size, blocks in zip(names, sizes, seats, strict=True):
        shards = {}
        for i, t, s, n in docs:
            if s == name:
                tie = None if t is None else hashlib.md5(t.encode()).hexdigest()
                nr = number(plan.seed, 0, i, tie) % max(1, -(-size // plan.shard_words))
                shards.setdefault(nr, []).append((number(plan.seed, 1, i, tie), i is not None, i or 0, tie or "", i, t, n))
        full = [nr for nr in sorted(shards) if sum(d[-1] for d in shards[nr])]
        words = {nr: [k for k, d in enumerate(sorted(shards[nr], key=lambda d: d[:4])) for _ in range(d[-1])] for nr in shards}
        n_blocks = {nr: max(1, int(len(words[nr]) / block + 0.5)) for nr in full}
        quotas = by_quotients([len(words[nr]) for nr in full], blocks, [3 * n_blocks[nr] for nr in full])
        for nr in shards:
            taken = [0] * len(shards[nr])
            if nr in full:
                n, quota, total = n_blocks[nr], quotas[full.index(nr)], len(words[nr])
                first = number(plan.seed, 2, name, nr) % n
                for k in words[nr]:
                    taken[k] += quota // n
                for b in range(first, first + quota % n):
                    for k in words[nr][b % n * total // n : (b % n + 1) * total // n]:
                        taken[k] += 1
            out += [(d[4], d[5], x) for d, x in zip(sorted(shards[nr], key=lambda d: d[:4]), taken, strict=True)]
    return sorted(out, key=str)


def mix_of(docs, plan):
    rows = mixing.taken_words(docs, plan, carry=True)
    return sorted(((r.row.doc_id, r.row.text, r.taken) for r in rows.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_the_whole_mix_is_that_of_the_plain_version(spark, seed):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, k, k]), rng.choice([None, "", "w " * rng.randrange(400), "a b"]) and "x" * rng.randrange(3) + " w" * rng.randrange(400), s, 0)
        for k, s in enumerate(rng.choices(["a", "b", None, "c", "d"], [30, 5, 3, 1, 1], k=150))
    ]
    plan = mixing.MixPlan(shard_words=3000)
    want = plain([r[:3] for r in rows], plan)
    assert mix_of(spark.createDataFrame(rows, SCHEMA).repartition(5), plan) == want


def test_small_sources_come_near_their_target(spark):
    rows = [(1, "w " * 10, "a", 0), (2, "v " * 100, "b", 0), (3, "x " * 50_000, "c", 0), (4, "one", "d", 0)]
    out = {r.source: (r.taken, r.target) for r in mixing.taken_words(spark.createDataFrame(rows, SCHEMA)).collect()}
    for taken, target in out.values():
        assert abs(taken - target) <= max(1, 0.02 * target)
    assert out["a"] == (30, 30.0) and out["d"][0] == 3


def test_many_texts_under_one_id_are_spread(spark):
    rows = [(None, f"text {k} " + "w " * 50, "a", 0) for k in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plan = mixing.MixPlan(shard_words=1000)
    assert mix_of(docs, plan) == plain([r[:3] for r in rows], plan)
    shards = {mixing.MixPlan().shards(0), plan.shards(400 * 52)}
    assert shards == {1, 21}


def test_documents(spark, documents):
    plan = mixing.MixPlan(shard_words=2000)
    out = mixing.taken_words(documents, plan).toPandas()
    assert len(out) == documents.count()
    assert (out["taken"] <= 3 * out["size"]).all() and (out["taken"] >= 0).all()
    for _, group in out.groupby("source", dropna=False):
        assert abs(group["taken"].sum() - group["target"].iloc[0]) <= 64 + 0.02 * group["target"].iloc[0]
    again = mixing.taken_words(documents.repartition(7), plan).toPandas()
    assert out.sort_values("doc_id")["taken"].tolist() == again.sort_values("doc_id")["taken"].tolist()


def test_rows_of_the_mix_hold_the_taken_words(spark, documents):
    taken = {r.doc_id: r.taken for r in mixing.taken_words(documents).collect()}
    rows = mixing.mixed(documents, length="n_chars")
    assert rows.columns == documents.columns
    words = {}
    for r in rows.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in taken.items() if v} == words


def test_edge_rows(spark):
    rows = [(1, None, "a", 0), (2, "", None, 0), (3, "x " * 500, None, 0), (3, "x " * 500, None, 0), (None, "y z", "a", 1), (5, "w " * 90000, "b", 9)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit("s"), "key": F.lit(1), "end": F.lit(2)})
    out = mixing.taken_words(docs).collect()
    assert len(out) == len(rows)
    assert {r.doc_id: r["size"] for r in out} == {1: 0, 2: 0, 3: 500, None: 2, 5: 90000}
    assert all(r.taken <= 3 * r["size"] for r in out)
    assert {r.target for r in out if r.source is None} == {3000.0}
    assert mixing.mixed(docs, length="n_chars").columns == docs.columns
    mixing.mixed(docs, length="n_chars").collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.taken_words(docs).count() == 0 and mixing.mixed(docs).count() == 0

"""Mixing sources to target weights, in blocks of equal size that Sainte-Lague apportions.

Sizes are words. A source's target is its share of all words by weight, at most
``max_repeats`` times its own size; what that cuts off goes to the others by
weight until none is above. Documents of a source are dealt into shards by a
seeded hash, and put in a seeded order within their shard. A shard is cut into
blocks of equal size. Blocks are apportioned by highest quotients, first to
sources with their targets as votes, then to the shards of a source with their
sizes as votes, which gives each shard an integer quota. A shard takes all its
blocks as often as its quota allows, and the rest as a run of blocks that
starts at a seeded place of its order and goes round at the end: a random set
of documents, of which only those at the run's ends are taken in part.

Blocks have ``block_words`` words, or fewer where a source's target is small: no
more than a sixteenth of the smallest target, down to single words.

Everything grows with documents only as far as Spark deals them out: a hot source has many shards, a shard has
``shard_words`` words unless there would be more than ``max_shards`` of them, and what is gathered per source is one row per
shard. Equal input and seed give the same mix, whatever the partitioning.

Defined results: a null text has size 0 and is not taken. A null source is a
source of its own, the last one. Documents are dealt by id and text, so that many
texts under one id, or without an id, are spread. Repeated rows are documents of
their own in one shard. Empty table, empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgauge.llm.text_columns import word_count
from claimgauge.sources.scratch import stage


@dataclass(frozen=True)
class MixPlan:
    #: weights of the sources in order of their names, repeated as often as needed
    weights: Sequence[float] = (1, 2, 3)
    max_repeats: int = 3
    block_words: int = 64
    shard_words: int = 1 << 20
    max_shards: int = 1 << 16
    #: more sources than these are joined by a shuffle
    broadcast_sources: int = 100_000
    seed: int = 17

    def block(self, goals: Sequence[float]) -> int:
        """Words of a block, so that the smallest target has sixteen of them."""
        smallest = min((g for g in goals if g > 0), default=float(self.block_words))
        return max(1, min(self.block_words, int(smallest / 16)))

    def shards(self, size: int) -> int:
        return min(self.max_shards, max(1, -(-size // self.shard_words)))


def sainte_lague(votes: Sequence[int], seats: int, most: Sequence[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 seats + 1); on ties the earlier party is first.

    ``most`` bounds the seats of each party. The common divisor gives nearly
    all seats at once; the few left over are settled one by one.
    """
    votes = [int(v) for v in votes]
    most = [seats if v else 0 for v in votes] if most is None else [min(m, seats) if v else 0 for m, v in zip(most, votes, strict=True)]
    seats = min(seats, sum(most))
    if not seats:
        return [0] * len(votes)

    def at(divisor: Fraction) -> list[int]:
        return [min(m, int(v / divisor + Fraction(1, 2))) for v, m in zip(votes, most, strict=True)]

    low, high = Fraction(0), Fraction(2 * max(votes) + 1)
    divisor = Fraction(max(1, sum(votes)), seats)
    for _ in range(60):  # bounds force the divisor down when they hold parties back
        got = at(divisor)
        if abs(sum(got) - seats) <= len(votes):
            break
        low, high = (divisor, high) if sum(got) > seats else (low, divisor)
        divisor = ((low + high) / 2).limit_denominator(1 << 40) if low else divisor / 2
    quotient = lambda i, n: Fraction(votes[i], 2 * n + 1)
    more = [(-quotient(i, n), i) for i, n in enumerate(got) if n < most[i]]
    less = [(quotient(i, n - 1), -i) for i, n in enumerate(got) if n]
    if sum(got) < seats:
        heapify(more)
        for _ in range(seats - sum(got)):
            _, i = heappop(more)
            got[i] += 1
            if got[i] < most[i]:
                heappush(more, (-quotient(i, got[i]), i))
    else:
        heapify(less)
        for _ in range(sum(got) - seats):
            _, i = heappop(less)
            i = -i
            got[i] -= 1
            if got[i]:
                heappush(less, (quotient(i, got[i] - 1), -i))
    return got


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeats: int) -> list[float]:
    """Shares of all words by weight, none above ``max_repeats`` times its size."""
    total, left, out = float(sum(sizes)), float(sum(sizes)), [0.0] * len(sizes)
    open_ = set(range(len(sizes)))
    while open_ and left > 0:
        weight = sum(weights[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if left * weights[i] / weight >= max_repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(max_repeats * sizes[i])
            left -= out[i]
            open_.discard(i)
    assert sum(out) <= total * (1 + 1e-9)
    return out


def _hash(seed: int, part: int, *keys: Column) -> Column:
    """A seeded number of 60 bits per key, the same in every SQL engine."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{part}"), *(F.coalesce(key.cast("string"), F.lit("null")) for key in keys)))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _quotas(shards: pd.DataFrame, plan: MixPlan) -> pd.DataFrame:
    """Adds the quota in blocks to the shards of one source."""
    shards = shards.sort_values("shard", kind="stable").reset_index(drop=True)
    blocks = shards["n_blocks"].astype(np.int64)
    seats = int(shards["source_blocks"].iloc[0])
    shards["quota"] = sainte_lague(shards["shard_size"].tolist(), seats, (plan.max_repeats * blocks).tolist())
    return shards


def taken_words(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", source: str = "source", key: str = "doc_id", carry: bool = False) -> DataFrame:
    """Per document: key, source, size, source_size, target, taken, and where the extra part begins and ends.

    ``from_word`` and ``to_word`` bound the words of the document that are taken
    once more than ``passes`` times; a second stretch, where the run goes round
    within one document, is ``head_words`` from the start. With ``carry`` the
    whole rows come along as the struct ``row``.
    """
    extra = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if carry else []
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), word_count(F.col(f"`{text}`")).alias("size"), F.md5(F.col(f"`{text}`")).alias("tie"), *extra)
    if not carry:  # the texts are read once
        rows = stage(rows, "mix-sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last()).collect()
    names = sorted((r.source for r in sources if r.source is not None)) + [None] * any(r.source is None for r in sources)
    size_of = {r.source: int(r.source_size) for r in sources}
    sizes = [size_of[n] for n in names]
    goal = targets(sizes, [plan.weights[i % len(plan.weights)] for i in range(len(names))], plan.max_repeats)
    block = plan.block(goal)
    seats = sainte_lague([round(g) for g in goal], max(1, round(sum(goal) / block)) if sum(goal) else 0)
    spark = docs.sparkSession
    table = spark.createDataFrame(
        [(n, n is None, s, g, b, plan.shards(s)) for n, s, g, b in zip(names, sizes, goal, seats, strict=True)],
        "name string, unnamed boolean, source_size long, target double, source_blocks long, n_shards long",
    )
    # one row per source: this is what a mix is configured with
    at_source = rows["source"].eqNullSafe(table["name"])
    rows = rows.join(F.broadcast(table) if len(names) <= plan.broadcast_sources else table, at_source).drop("name", "unnamed")
    rows = rows.withColumn("shard", _hash(plan.seed, 0, F.col("key"), F.col("tie")) % F.col("n_shards"))
    rows = rows.withColumn("place", _hash(plan.seed, 1, F.col("key"), F.col("tie")))
    order = Window.partitionBy("source", "shard").orderBy("place", "key", "tie")
    rows = rows.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = F.greatest(F.lit(1), F.round(F.col("shard_size") / block).cast("long"))
    shards = (
        rows.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_blocks").alias("source_blocks"))
        .where("shard_size > 0").withColumn("n_blocks", blocks)
    )
    quotas = shards.groupBy("source").applyInPandas(
        lambda group: _quotas(group, plan),
        "source string, shard long, shard_size long, source_blocks long, n_blocks long, quota long",
    )
    quotas = stage(quotas.drop("source_blocks"), "mix-quotas").withColumnRenamed("source", "of").withColumnRenamed("shard", "nr")
    rows = rows.join(quotas, rows["source"].eqNullSafe(quotas["of"]) & (rows["shard"] == quotas["nr"]), "left")
    n, size, quota = F.col("n_blocks"), F.col("shard_size"), F.coalesce(F.col("quota"), F.lit(0))
    first = F.pmod(_hash(plan.seed, 2, F.col("source"), F.col("shard")), n)
    rows = rows.withColumn("passes", F.coalesce(F.floor(quota / n), F.lit(0)).cast("long"))
    rows = rows.withColumn("first", first).withColumn("last", F.col("first") + F.pmod(quota, n))
    start = F.col("end") - F.col("size")

    def inside(a: Column, b: Column) -> Column:
        """Bounds of the document's words from word a to word b of the shard."""
        low, high = F.greatest(start, a), F.least(F.col("end"), b)
        return F.struct((low - start).alias("a"), F.greatest(high - start, low - start).alias("b"))

    def edge(block: Column) -> Column:
        return F.floor(block * size / n).cast("long")

    rows = rows.withColumn("run", inside(edge(F.col("first")), edge(F.least(F.col("last"), n))))
    rows = rows.withColumn("wrap", inside(F.lit(0).cast("long"), edge(F.greatest(F.col("last") - n, F.lit(0)))))
    run = F.coalesce(F.col("run.b") - F.col("run.a"), F.lit(0))
    wrap = F.coalesce(F.col("wrap.b") - F.col("wrap.a"), F.lit(0))
    return rows.select(
        F.col("key").alias(key), F.col("source").alias(source), *(["row"] if carry else []), "size", "source_size", "target",
        (F.col("passes") * F.col("size") + run + wrap).cast("long").alias("taken"), "passes",
        F.col("run.a").alias("from_word"), F.col("run.b").alias("to_word"), F.col("wrap.b").alias("head_words"),
    )


def mixed(docs: DataFrame, plan: MixPlan = MixPlan(), text: str = "text", source: str = "source", key: str = "doc_id", length: str | None = None) -> DataFrame:
    """``docs`` as the mix has them: a row for each time that a document is taken.

    Documents at the ends of a run are cut to the words taken, joined by single
    blanks; ``length`` names a column that then holds their characters.
    """
    rows = taken_words(docs, plan, text, source, key, carry=True)
    whole = F.col("row").getField(text)
    words = F.split(F.btrim(whole, F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")

    def cut(a: Column, b: Column) -> Column:
        full = (a <= 0) & (b >= F.col("size"))
        part = F.array_join(F.slice(words, (a + 1).cast("int"), (b - a).cast("int")), " ")
        return F.when(full, whole).when(b > a, part)

    extra = F.array(cut(F.col("from_word"), F.col("to_word")), cut(F.lit(0), F.col("head_words")))
    copies = F.concat(F.array_repeat(whole, F.when(F.col("size") > 0, F.col("passes")).otherwise(0).cast("int")), extra)
    rows = rows.select("row", F.explode(F.filter(copies, lambda c: c.isNotNull() & (c != ""))).alias("copy"))
    out = {c: F.col("row").getField(c) for c in docs.columns} | {text: F.col("copy")}
    if length is not None:
        out[length] = F.length("copy").cast(docs.schema[length].dataType)
    return rows.select(*(v.alias(c) for c, v in out.items()))

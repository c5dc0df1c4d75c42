"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosine checks.

Vectors are normalised, so that a cosine is a distance. In each of several
tables a vector's bucket is the tuple of its quantised projections on random
directions. How many projections a tuple has follows from the number of
vectors, and how many tables from ``recall`` at the threshold; both by the
collision probabilities of p-stable hashing.

Equal vectors are one member. A bucket's members are compared with one of them,
its centre; members that this leaves unconnected are compared in pairs. Links
make components. Direct links are then counted inside each component, in blocks of ``block``
members against each other that are dealt to tasks, so that no pair is a row,
a large group is spread, and no link inside a component is missed.

Defined results: vectors that are null, zero or hold null or non-finite numbers
link with nothing, and neither do vectors of different lengths. Rows that
repeat count as vectors of their own; so do different vectors under one vec_id,
which do not tie each other's groups together. A null vec_id stays by itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgauge.llm.components import connected
from claimgauge.sources.scratch import stage


@dataclass(frozen=True)
class HashPlan:
    least_cosine: float = 0.9
    recall: float = 0.99
    #: width of a projection's cells, for vectors of length 1
    cell: float = 2.0
    block: int = 256
    seed: int = 23

    def together(self, distance: float) -> float:
        """Probability that one projection puts two vectors at this distance into one cell."""
        r = self.cell / distance
        tail = 0.5 * math.erfc(r / math.sqrt(2))
        return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))

    def shape(self, n: int) -> tuple[int, int]:
        """Projections per table, so that n unrelated vectors share a bucket once each; tables, for the recall."""
        k = max(1, math.ceil(math.log(max(n, 2)) / -math.log(self.together(math.sqrt(2)))))
        near = self.together(math.sqrt(2 - 2 * self.least_cosine)) ** k
        return k, max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - near)))


def _matrix(column: pa.Array) -> list[np.ndarray | None]:
    """Vectors in double precision; None for those that link with nothing."""
    out = []
    for row in column:
        if not row.is_valid or not len(row.values) or row.values.null_count:
            out.append(None)
            continue
        v = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
        length = np.sqrt(v @ v) if np.isfinite(v).all() else 0.0
        if length and (not np.isfinite(length) or length < 1e-150):  # out of range when squared
            v = v / np.abs(v).max()
            length = np.sqrt(v @ v)
        out.append(v / length if length else None)
    return out


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, vectors = batch.column(0), batch.column(1)
        a, b = [], []
        for row, unit in zip(vectors, _matrix(vectors), strict=True):
            digest = None if unit is None else hashlib.blake2b(row.values.to_numpy(zero_copy_only=False).tobytes(), digest_size=16).digest()
            a.append(None if digest is None else int.from_bytes(digest[:8], "little", signed=True))
            b.append(None if digest is None else int.from_bytes(digest[8:], "little", signed=True))
        yield pa.RecordBatch.from_arrays([ids, pa.array(a, pa.int64()), pa.array(b, pa.int64()), vectors], names=["vec_id", "fa", "fb", "vector"])


def _buckets(batches: Iterator[pa.RecordBatch], plan: HashPlan, k: int, tables: int) -> Iterator[pa.RecordBatch]:
    made: dict[int, tuple] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            units = _matrix(part.column(1))
            by_size: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                by_size.setdefault(len(u), []).append(i)
            keys = np.zeros((len(units), tables), dtype=np.int64)
            for size, rows in by_size.items():
                if size not in made:
                    rng = np.random.default_rng((plan.seed, size))
                    made[size] = (
                        rng.normal(size=(size, tables * k)), rng.uniform(0, plan.cell, tables * k),
                        rng.integers(1, 2**63, (tables, k), dtype=np.int64) | 1, rng.integers(0, 2**63, tables, dtype=np.int64),
                    )
                directions, offsets, mix, salt = made[size]
                cells = np.floor((np.stack([units[i] for i in rows]) @ directions + offsets) / plan.cell).astype(np.int64)
                with np.errstate(over="ignore"):
                    keys[rows] = (cells.reshape(len(rows), tables, k) * mix[None]).sum(2) + salt[None]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, tables, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays([part.column(0), flat], names=["member", "buckets"])


def _cosines(one: pa.Array, two: pa.Array) -> pa.Array:
    pairs = zip(_matrix(one), _matrix(two), strict=True)
    return pa.array([float(x @ y) if len(x) == len(y) else -1.0 for x, y in pairs], pa.float64())


def _block_counts(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Links of each member in runs of rows with equal (component, i, j): rows of side 0 against those of side 1."""
    held: pa.Table | None = None

    def counted(group: pa.Table) -> tuple[list[int], list[int]]:
        side = group["side"].to_numpy()
        ids, copies = group["member"].to_numpy(), group["copies"].to_numpy()
        units = _matrix(group["vector"].combine_chunks())
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        size = {len(u) for u in units}
        if len(size) != 1:  # vectors of several lengths, tied together by repeated ids
            width = max(size)
            units = [np.r_[u, np.zeros(width - len(u))] if len(u) == width else np.full(width, np.nan) for u in units]
        x = np.stack(units)
        if not len(b):  # a block with itself
            linked = x @ x.T >= least
            np.fill_diagonal(linked, False)
            return ids.tolist(), (linked @ copies).tolist()
        linked = x[a] @ x[b].T >= least
        return [*ids[a].tolist(), *ids[b].tolist()], [*(linked @ copies[b]).tolist(), *(linked.T @ copies[a]).tolist()]

    def done(table: pa.Table, all_of_it: bool) -> tuple[pa.RecordBatch | None, pa.Table]:
        keys = np.stack([table[c].to_numpy() for c in ("component", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), table.num_rows]
        if not all_of_it:
            cuts = cuts[:-1]
        members, links = [], []
        for a, b in zip(cuts, cuts[1:], strict=False):
            m, n = counted(table.slice(a, b - a))
            members += m
            links += n
        out = pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array(links, pa.int64())], names=["member", "links"])
        return out, table.slice(cuts[-1])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None or not held.num_rows else pa.concat_tables([held, table]).combine_chunks()
        if held.num_rows:
            out, held = done(held, False)
            yield out
    if held is not None and held.num_rows:
        yield done(held, True)[0]


def _link_counts(members: DataFrame, components: DataFrame, plan: HashPlan) -> DataFrame:
    """Direct links of each member, copies of others counted, within components."""
    sizes = stage(components.groupBy("component").agg(F.count("*").alias("size")), "vector-component-sizes")
    placed = stage(components.withColumnRenamed("node", "member").join(sizes, "component"), "vector-places")
    rows = members.select("member", "copies", "vector").join(placed, "member")
    blocks = F.ceil(F.col("size") / plan.block).cast("int")
    own = F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    # block i meets every block j >= i: a member is side 0 where its block is i, and side 1 where it is j > i
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", others)
    rows = rows.select(
        "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "member", "copies", "vector",
    )
    dealt = rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j")
    counts = dealt.mapInArrow(lambda batches: _block_counts(batches, plan.least_cosine), "member long, links long")
    return counts.groupBy("member").agg(F.sum("links").alias("links"))


def near_vectors(rows: DataFrame, plan: HashPlan = HashPlan(), vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id and kept (whether it is its component's smallest id)."""
    source = rows.select(F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    marked = stage(source.mapInArrow(_fingerprints, "vec_id long, fa long, fb long, vector array<double>"), "vectors")
    members = stage(
        marked.where("fa is not null and vec_id is not null").groupBy("fa", "fb")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("vector").alias("vector"))
        # a name of its own, since a vec_id may stand for several vectors
        .withColumn("member", F.monotonically_increasing_id()),
        "vector-members",
    )
    k, tables = plan.shape(members.count())
    hashed = members.select("member", "vector").mapInArrow(lambda b: _buckets(b, plan, k, tables), "member long, buckets array<long>")
    placed = stage(hashed.select("member", F.explode("buckets").alias("bucket")), "vector-buckets")
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("member", F.struct(F.xxhash64("member"), "member")).alias("centre"))
    shared = stage(shared.where("n > 1").select("bucket", "centre"), "vector-shared")
    live = stage(placed.join(shared, "bucket"), "vector-live")

    def links(pairs: DataFrame) -> DataFrame:
        pairs = stage(pairs.select("a", "b").distinct(), "vector-pairs")
        one = members.select(F.col("member").alias("a"), F.col("vector").alias("x"))
        two = members.select(F.col("member").alias("b"), F.col("vector").alias("y"))
        cosine = F.arrow_udf(lambda x, y: _cosines(x, y), "double")
        full = pairs.join(two, "b").join(one, "a").withColumn("cosine", cosine("x", "y"))
        return stage(full.where(F.col("cosine") >= plan.least_cosine).select("a", "b"), "vector-links")

    first = links(live.where("member <> centre").select(F.col("centre").alias("a"), F.col("member").alias("b")))
    labels = connected(first).withColumnRenamed("node", "member")
    tagged = stage(live.select("bucket", "member").join(labels, "member", "left").withColumn("component", F.coalesce("component", "member")), "vector-tagged")
    mixed = tagged.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = stage(mixed.where("low <> high").select("bucket"), "vector-mixed")
    open_ = stage(tagged.join(mixed, "bucket"), "vector-open")
    one = open_.select("bucket", F.col("member").alias("a"), F.col("component").alias("ca"))
    two = open_.select("bucket", F.col("member").alias("b"), F.col("component").alias("cb"))
    second = links(one.join(two, "bucket").where("a < b and ca <> cb"))
    labels = connected(second.union(labels.select(F.col("member").alias("a"), F.col("component").alias("b"))))
    counts = _link_counts(members, labels, plan)
    found = members.select("fa", "fb", "member", "copies", "low").join(labels.withColumnRenamed("node", "member"), "member", "left")
    found = stage(found.join(counts, "member", "left"), "vector-found")
    lowest = stage(found.where("component is not null").groupBy("component").agg(F.min("low").alias("least")), "vector-lowest")
    found = found.join(lowest, "component", "left")
    found = stage(found.select("fa", "fb", "copies", "links", F.coalesce("least", "low").alias("component")), "vector-named")
    out = marked.select("vec_id", "fa", "fb").join(found, ["fa", "fb"], "left")
    alone = F.col("vec_id").isNull()
    others = F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1
    out = out.select(
        "vec_id",
        F.when(alone, 0).otherwise(others).cast("long").alias("n_links"),
        F.when(~alone, F.coalesce("component", "vec_id")).cast("long").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

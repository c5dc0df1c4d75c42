"""Near-duplicate documents by a chosen-path similarity join over sets of word shingles.

Texts with equal sets are one member. Members start at the root of several
independent trees. In a node one of the sketch's minwise positions is chosen
from the node's path, and by chance a second one, so that a member goes into
1 / s children on the average, s being the threshold: into the child of its
minwise token at each chosen position. Similar members go down together, and
others part. A node with at most ``leaf`` members is compared exhaustively, and
so is, after ``max_depth`` branchings, whatever is left, in blocks that are
dealt to tasks. Members at similarity s stay together through a whole tree with a
probability that follows from the branching; the number of trees follows from
that and ``recall``.

Candidates of a node must agree with another one in size and sketch, with a
margin of four standard deviations. Their texts go to the node, where the full
sets of shingles are compared, all of a block at once by products of their
incidence; no pair becomes a row, and a block gives one link for each member
that it ties to another. Before anything else, members of a large node are compared with its centre, a member
that the tree's turn chooses; nodes whose members all are connected are done.
The first trees' links are known before the others grow, so that a group of many near
copies is linked to some centres and is done.

Defined results: a document without words has no shingles and links with
nothing. A text with fewer than five words is one shingle. A null doc_id stays
by itself, with a null component, and is kept. Rows with equal doc_ids and
texts are one member and have one verdict; different texts under one doc_id are
members of their own, and do not tie each other's groups together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm import hash_filter
from claimgauge.llm.components import connected
from claimgauge.sources.scratch import discard, stage

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_POSITIONS = 64


@dataclass(frozen=True)
class JoinPlan:
    width: int = 5
    #: linked if 100 * intersection >= percent * union
    percent: int = 75
    recall: float = 0.9999
    leaf: int = 256
    #: members of a block, where a node is compared that has more than a leaf
    block: int = 1024
    max_depth: int = 3
    #: trees whose links are confirmed before the others grow, and different centres among them
    first_trees: int = 3
    seed: int = 5

    @property
    def second(self) -> float:
        """Probability that a node chooses a second position."""
        return 100 / self.percent - 1

    @property
    def together(self) -> float:
        """Probability that two members at the threshold meet in a node of the last level of a tree."""
        s, p = self.percent / 100, 1.0
        for _ in range(self.max_depth + 1):
            p = 1 - (1 - self.second) * (1 - s * p) - self.second * (1 - s * p) ** 2
        return p

    @property
    def trees(self) -> int:
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - self.together)))

    @property
    def least_agreement(self) -> int:
        """Positions of 64 whose four bits agree, at four standard deviations below what the threshold gives."""
        p = self.percent / 100
        p = p + (1 - p) / 16
        return math.floor(_POSITIONS * p - 4 * math.sqrt(_POSITIONS * p * (1 - p)))


_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BYTE_VALUES = np.random.default_rng(3).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PLACES = np.array([pow(0xD6E8FEB86659FD93, k, 2**64) for k in range(64)], dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    if not text:
        return np.zeros(0, np.uint64)
    raw = text.encode("utf-8", "replace")
    flat = np.frombuffer(raw, dtype=np.uint8)
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint8)
    solid = ~((flat == 32) | ((flat >= 9) & (flat <= 13)))
    begins = np.flatnonzero(solid & ~np.r_[False, solid[:-1]])
    if not len(begins):
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(solid & ~np.r_[solid[1:], False]) + 1
    # polynomial over the bytes of a word, Horner-free: words of equal length are summed together
    power = np.full(int((ends - begins).max()), _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    at = np.arange(len(flat)) - np.repeat(begins, np.diff(np.r_[begins, len(flat)])).astype(np.int64) if begins[0] == 0 else None
    if at is None:
        lead = int(begins[0])
        at = np.r_[np.zeros(lead, np.int64), np.arange(lead, len(flat)) - np.repeat(begins, np.diff(np.r_[begins, len(flat)]))]
    value = np.where(solid, _BYTE_VALUES[flat] * power[np.minimum(at, len(power) - 1)], np.uint64(0))
    words = _mixed(np.add.reduceat(value, begins) + (ends - begins).astype(np.uint64))
    if len(words) < width:
        total = np.sum(words * _PLACES[: len(words)], dtype=np.uint64) + np.uint64(len(words))
        return _mixed(np.array([total], dtype=np.uint64))
    n = len(words) - width + 1
    total = np.full(n, np.uint64(width), dtype=np.uint64)
    for k in range(width):
        total += words[k : k + n] * _PLACES[k]
    return np.unique(_mixed(total))


_SEEDS = np.random.default_rng(9).integers(1, 2**63, (2, _POSITIONS), dtype=np.uint64)


def minwise(found: np.ndarray) -> np.ndarray:
    """64 minwise tokens of a set that is not empty, as the high 32 bits of the smallest values."""
    best = np.full(_POSITIONS, np.uint64(2**64 - 1))
    for at in range(0, len(found), 2048):
        part = (found[at : at + 2048, None] ^ _SEEDS[0]) * (_SEEDS[1] | np.uint64(1))
        np.minimum(best, part.min(0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def _sketch(tokens: np.ndarray) -> list[int]:
    """Four longs: bit k of the j-th long is bit j of the hashed k-th token."""
    bits = _mixed(tokens.astype(np.uint64) + np.uint64(1))
    weights = np.uint64(1) << np.arange(_POSITIONS, dtype=np.uint64)
    return [int(np.sum(((bits >> np.uint64(j)) & np.uint64(1)) * weights, dtype=np.uint64).astype(np.int64)) for j in range(4)]


_SIGNATURE = "doc_id long, tie long, n_shingles long, set_a long, set_b long, tokens array<int>, s0 long, s1 long, s2 long, s3 long"


def _signatures(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _SIGNATURE.split(", ")]
    types = [*[pa.int64()] * 5, pa.list_(pa.int32()), *[pa.int64()] * 4]
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part, rows = batch.slice(at, 500), []
            for doc_id, text, tie in zip(*(c.to_pylist() for c in part.columns), strict=True):
                found = shingles(text, width)
                if not len(found):
                    rows.append((doc_id, tie, 0, *[None] * 7))
                    continue
                tokens = minwise(found)
                whole = [int(np.bitwise_xor.reduce(_mixed(found * m)).astype(np.int64)) for m in _PLACES[1:3]]
                rows.append((doc_id, tie, len(found), *whole, tokens.view(np.int32), *_sketch(tokens)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


_S = ("s0", "s1", "s2", "s3")


def _likely(component, sizes, sketches, a, b, plan: JoinPlan) -> np.ndarray:
    """Which rows of side ``a`` may link with which of side ``b``: sizes that can reach the threshold, and sketches that agree."""
    differ = np.zeros((len(a), len(b)), dtype=np.uint64)
    for s in sketches:
        differ |= s[a][:, None] ^ s[b][None, :]
    fits = np.bitwise_count(differ) <= _POSITIONS - plan.least_agreement
    n, m = sizes[a][:, None], sizes[b][None, :]
    fits &= 100 * np.minimum(n, m) >= plan.percent * np.maximum(n, m)
    fits &= component[a][:, None] != component[b][None, :]
    return fits


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows with equal keys, of batches that are sorted by them."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None or not held.num_rows else pa.concat_tables([held, table]).combine_chunks()
        if held.num_rows:
            columns = np.stack([held[c].to_numpy() for c in keys])
            edges = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(0)) + 1).tolist()]
            yield from (held.slice(x, y - x) for x, y in zip(edges, edges[1:], strict=False))
            held = held.slice(edges[-1])
    if held is not None and held.num_rows:
        yield held


_BLOCK = ("node", "i", "j")


def _candidates(batches: Iterator[pa.RecordBatch], plan: JoinPlan) -> Iterator[pa.RecordBatch]:
    """Rows (node, i, j, side, member, component) of members that may link with another of their block, or of the other side."""
    for rows in _runs(batches, _BLOCK):
        component, sizes, side = (rows[c].to_numpy() for c in ("component", "n_shingles", "side"))
        sketches = [rows[s].to_numpy().view(np.uint64) for s in _S]
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(b):  # a block with itself
            some = a[_likely(component, sizes, sketches, a, a, plan).any(1)]
        else:
            fits = _likely(component, sizes, sketches, a, b, plan)
            some = np.r_[a[fits.any(1)], b[fits.any(0)]]
        kept = rows.select([*_BLOCK, "side", "member", "component"]).take(pa.array(some))
        yield from kept.combine_chunks().to_batches()


def _common(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` with sets ``b``, by products of their incidence."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(a), len(b)), dtype=np.float32)
    for low in range(0, int(shared.sum()), columns):
        x, y = np.searchsorted(place, (low, low + columns))
        has = np.zeros((len(sets), columns), dtype=np.float32)
        has[owner[x:y], place[x:y] - low] = 1
        out += has[a] @ has[b].T
    return out.astype(np.int64)


def _confirm(batches: Iterator[pa.RecordBatch], plan: JoinPlan) -> Iterator[pa.RecordBatch]:
    """Links of blocks on the full sets, as one pair (a, b) for each member that is tied to a smaller one."""
    for rows in _runs(batches, _BLOCK):
        member, component, side = (rows[c].to_numpy() for c in ("member", "component", "side"))
        sets = [shingles(t, plan.width) for t in rows["text"].to_pylist()]
        sizes = np.array([len(x) for x in sets])
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        b = b if len(b) else a
        common = _common(sets, a, b)
        linked = 100 * common >= plan.percent * (sizes[a][:, None] + sizes[b][None, :] - common)
        linked &= component[a][:, None] != component[b][None, :]
        label = np.arange(len(member))
        while True:  # the smallest number that links lead to
            far = np.where(linked, label[b][None, :], len(label))
            new = label.copy()
            np.minimum.at(new, a, far.min(1, initial=len(label)))
            np.minimum.at(new, b, np.where(linked, label[a][:, None], len(label)).min(0, initial=len(label)))
            if (new == label).all():
                break
            label = new
        tied = np.flatnonzero(label != np.arange(len(label)))
        yield pa.RecordBatch.from_arrays([pa.array(member[tied]), pa.array(member[label[tied]])], names=["a", "b"])


def _children(rows: DataFrame, plan: JoinPlan, level: int) -> DataFrame:
    """Each row goes into the children of one or two positions, chosen from its node's path."""

    def drawn(what: str, n: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(f"{plan.seed}:{level}:{what}")), F.lit(n)).cast("int")

    pick, step = drawn("a", _POSITIONS), drawn("b", _POSITIONS - 1) + 1
    two = F.array(pick, F.pmod(pick + step, F.lit(_POSITIONS)))
    positions = F.when(drawn("c", 1 << 20) < int(plan.second * (1 << 20)), two).otherwise(F.array(pick))
    nodes = F.transform(positions, lambda i: F.xxhash64("node", i, F.get("tokens", i)))
    return rows.withColumn("node", F.explode(nodes))


class _Join:
    """``texts``: tie, doc_id and text; ``members``: member, rep (doc_id and tie of one of its texts), n_shingles, tokens, sketch."""

    def __init__(self, texts: DataFrame, members: DataFrame, plan: JoinPlan) -> None:
        self.texts, self.members, self.plan = texts, members, plan
        self.labels: DataFrame | None = None

    def with_component(self, rows: DataFrame) -> DataFrame:
        """``rows`` of the column ``member`` with the component that links so far give it."""
        if self.labels is None:
            return rows.withColumn("component", F.col("member"))
        labels = self.labels.select(F.col("node").alias("member"), F.col("component").alias("label"))
        return rows.join(labels, "member", "left").withColumn("component", F.coalesce("label", "member")).drop("label")

    def live(self, rows: DataFrame, turn: int = 0) -> DataFrame:
        """Rows (member, node, turn) of nodes whose members are not all connected yet, with component, size and centre."""
        rows = stage(self.with_component(rows), "path-rows")
        # one order of members for all nodes of a turn, so that its trees agree on centres
        centre = F.min_by("member", F.struct(F.xxhash64("member", "turn", F.lit(turn)), "member"))
        nodes = rows.groupBy("node").agg(
            F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"), centre.alias("centre")
        )
        nodes = stage(nodes.where("low <> high").select("node", "n", "centre"), "path-nodes")
        found = stage(rows.join(nodes, "node"), "path-live")
        discard(rows, nodes)
        return found

    def blocks(self, live: DataFrame) -> DataFrame:
        """Members of whole nodes in blocks: block i meets every block j >= i; a member is side 0 of its own, and side 1 of j > i."""
        plan = self.plan
        blocks = F.when(F.col("n") <= plan.leaf, 1).otherwise(F.ceil(F.col("n") / plan.block)).cast("int")
        rows = live.select("node", "member", "component", blocks.alias("blocks"))
        rows = rows.withColumn("own", F.pmod(F.xxhash64("member", "node"), F.col("blocks")).cast("int"))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return rows.select(
            "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
            (F.col("own") > F.col("other")).cast("int").alias("side"), "member", "component",
        )

    def candidates(self, blocks: DataFrame) -> DataFrame:
        """The rows of blocks whose members may link with another there."""
        plan = self.plan
        rows = blocks.join(self.members.select("member", "n_shingles", *_S), "member")
        rows = rows.select(*_BLOCK, "side", "member", "component", "n_shingles", *_S)
        dealt = rows.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
        kind = "node long, i int, j int, side int, member long, component long"
        return stage(dealt.mapInArrow(lambda batches: _candidates(batches, plan), kind), "near-candidates")

    def stars(self, live: DataFrame) -> DataFrame:
        """A large node's centre (side 0) with its other members (side 1), in blocks of members."""
        plan = self.plan
        large = live.where(F.col("n") > plan.leaf)
        j = F.pmod(F.xxhash64("member"), F.ceil(F.col("n") / plan.block)).cast("int") + 1
        spokes = large.where("member <> centre").select("node", F.lit(0).alias("i"), j.alias("j"), F.lit(1).alias("side"), "member", "component")
        hubs = large.where("member = centre").withColumn("j", F.explode(F.sequence(F.lit(1), F.ceil(F.col("n") / plan.block).cast("int"))))
        return spokes.unionByName(hubs.select("node", F.lit(0).alias("i"), "j", F.lit(0).alias("side"), "member", "component"))

    def confirm(self, parts: list[DataFrame]) -> None:
        """Adds the links among candidates, and brings the components up to date."""
        rows = reduce(DataFrame.unionByName, parts)
        wanted = rows.select("member").distinct().join(self.members.select("member", "rep"), "member").select("member", "rep.*")
        wanted = stage(wanted, "near-wanted")
        name = F.xxhash64("doc_id", "tie")
        likely = hash_filter.likely(self.texts, name, hash_filter.bitmap_rows(wanted, name))
        texts = likely.join(wanted, ["doc_id", "tie"]).groupBy("member").agg(F.first("text").alias("text"))
        texts = stage(texts, "near-texts")
        plan = self.plan
        full = rows.join(texts, "member").select(*_BLOCK, "side", "member", "component", "text")
        dealt = full.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)
        found = stage(dealt.mapInArrow(lambda batches: _confirm(batches, plan), "a long, b long"), "near-links")
        discard(wanted, texts, *parts)
        links = found
        if self.labels is not None:
            links = found.union(self.labels.select(F.col("node").alias("a"), F.col("component").alias("b")))
        before, self.labels = self.labels, connected(links)
        discard(found)
        if before is not None:
            discard(before)

    def grow(self, trees: range) -> None:
        """Grows these trees, and confirms what they find; the first of all tell large nodes' centres first."""
        plan = self.plan
        roots = F.explode(F.array(*(F.lit(t).cast("long") for t in trees)))
        rows = self.members.select("member", "tokens", roots.alias("node"))
        rows = rows.withColumn("turn", F.pmod("node", F.lit(plan.first_trees)).cast("int"))
        live = self.live(_children(rows, plan, 0).drop("tokens"))
        if self.labels is None:
            self.confirm([self.candidates(self.stars(live))])
            last, live = live, self.live(live.select("member", "node", "turn"))
            discard(last)
        found = []
        for level in range(plan.max_depth + 1):
            whole = level == plan.max_depth
            found.append(self.candidates(self.blocks(live if whole else live.where(F.col("n") <= plan.leaf))))
            large = live.where(F.col("n") > plan.leaf)
            if whole or not large.limit(1).count():
                break
            with_tokens = large.select("member", "node", "turn").join(self.members.select("member", "tokens"), "member")
            last, live = live, self.live(_children(with_tokens, plan, level + 1).drop("tokens"), level + 1)
            discard(last)
        discard(live)
        self.confirm(found)

    def run(self) -> DataFrame:
        trees, first = self.plan.trees, min(self.plan.first_trees, self.plan.trees)
        self.grow(range(first))
        if first < trees:
            self.grow(range(first, trees))
        return self.labels


def near_duplicates(docs: DataFrame, plan: JoinPlan = JoinPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id and kept (whether it is its component's smallest id)."""
    return members_of(docs, plan, text, key).select("doc_id", "n_shingles", "component_id", "kept")


def members_of(docs: DataFrame, plan: JoinPlan = JoinPlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """As :func:`near_duplicates`, with ``tie``, the hash of the row's text, and ``group``.

    Linked rows have one group, which no others have, even where ids repeat; it is null for rows without shingles or id.
    """
    body = F.col(f"`{text}`")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("tie"))
    width = plan.width
    signed = stage(rows.mapInArrow(lambda batches: _signatures(batches, width), _SIGNATURE), "near-signatures")
    # equal sets are one member, whatever their ids
    same = ["set_a", "set_b", "n_shingles"]
    sets = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(
        F.min(F.struct("doc_id", "tie")).alias("rep"), F.min_by(F.struct("tokens", *_S), F.struct("doc_id", "tie")).alias("of")
    )
    sets = stage(sets.select(*same, "rep", "of.*").withColumn("member", F.monotonically_increasing_id()), "near-sets")
    labels = _Join(rows, sets.select("member", "rep", "n_shingles", "tokens", *_S), plan).run()
    named = sets.select(*same, "member", F.col("rep.doc_id").alias("low")).join(
        labels.select(F.col("node").alias("member"), "component"), "member", "left"
    )
    named = stage(named, "near-named")
    lowest = stage(named.where("component is not null").groupBy("component").agg(F.min("low").alias("least")), "near-lowest")
    group = F.coalesce("component", "member").alias("group")
    named = stage(named.join(lowest, "component", "left").select(*same, F.coalesce("least", "low").alias("found"), group), "near-components")
    discard(sets, lowest)
    out = signed.select("doc_id", "tie", *same).join(named, same, "left")
    known = F.col("doc_id").isNotNull()
    component = F.when(known, F.coalesce("found", "doc_id")).alias("component_id")
    out = out.select("doc_id", "tie", "n_shingles", component, F.when(known, F.col("group")).alias("group"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

"""Line dedup: of lines that nearly agree, over all documents, one stays.

Lines are compared without case and outer blanks, as sets of character
shingles. A line's signature is a one-permutation MinHash: the hash range has 32
equal stretches, the first ``bands * rows`` of which give the smallest hash of
the line's shingles in it, and an empty stretch the next one's. Bands of
``rows`` values are buckets.

A bucket is a run of sorted rows. Sketches, two bits of each entry, only tell
which members are compared first: a leader with every member whose sketch fits.
A group of near copies thus becomes connected by few candidates. After that
every two members of a bucket that are not connected yet are compared on their
full sets, none left out: sizes and bitmaps of the sets first, which give a bound
that no linked pair misses, then the exact similarity. That happens inside a
task and makes no rows but links. A bucket of more than ``large`` lines is cut
into blocks, and every two blocks meet in a task of their own.
Lines link if the exact Jaccard similarity of the full shingle sets reaches
``percent``. Linked lines make components by distributed union-find, and of each
component the first line stays, by doc_id and place.

Signatures, buckets and exact checks are Arrow batches: column functions need
several times the budget for them (README.md has the figures). Texts of lines
move only for lines in candidates. Equal lines are one member, a line that a
third of all documents share is signed once per batch and one row of its
buckets, and joins on it have a written table on either side, so that Spark can
split them.

Defined results: blank lines are never duplicates and stay. A line shorter than
a shingle is one shingle. A null text has no lines and stays null. Rows with equal doc_id
and text are one document and lose the same lines. Documents with a null id
come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgauge.llm import hash_filter
from claimgauge.llm.components import connected
from claimgauge.llm.text_columns import BLANKS
from claimgauge.sources.scratch import discard, stage


@dataclass(frozen=True)
class LinePlan:
    width: int = 8
    percent: int = 75
    rows: int = 3
    bands: int = 10
    #: of rows * bands sketch entries, where 0.75 gives 24 on the average, and chance 8
    least_agreement: int = 14
    #: entries from which a member proposes no candidates of its own
    sure_agreement: int = 29
    #: a line with fewer different values in its signature is compared whatever its sketch is
    least_values: int = 16
    #: lines of a bucket from which it is cut into blocks
    large: int = 4096

    @property
    def entries(self) -> int:
        return self.rows * self.bands


def _plain(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(BLANKS)))


_STRETCHES = 32
#: bit of a sketch, above its entries, that is set where few values fill the signature
_FEW = 1 << 60
_PAIRED = np.uint64(0x5555555555555555 & (_FEW - 1))
_EMPTY = np.uint64(2**64 - 1)
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, hash) of all shingles of lines that are not empty, repeats included, line by line."""
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    short = lengths < width
    if short.any():  # one shingle, told by its length from a longer one with the same end
        lines = [x if len(x) >= width else x + "\0" * (width - len(x)) for x in lines]
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    n = len(points) - width + 1
    total = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(width):
        total *= np.uint64(_BASE)
        total += points[k : k + n]
    slots = np.maximum(lengths, width)
    first = np.cumsum(slots) - slots
    count = slots - width + 1
    line = np.repeat(np.arange(len(lines)), count)
    at = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count) + first[line]
    found = total[at]
    if short.any():
        found += np.where(short, lengths + 1, 0).astype(np.uint64)[line]
    return line, _mixed(found)


def signatures(lines: list[str], plan: LinePlan) -> tuple[np.ndarray, np.ndarray]:
    """Entries of each line's signature, and its sketch."""
    line, hashes = shingle_hashes(lines, plan.width)
    low = np.full(len(lines) * _STRETCHES, _EMPTY, dtype=np.uint64)
    np.minimum.at(low, line * _STRETCHES + (hashes >> np.uint64(59)).astype(np.int64), hashes)
    low = low.reshape(-1, _STRETCHES)
    for _ in range(2):  # the next stretch that is not empty, beginning again at the end
        for p in range(_STRETCHES - 1, -1, -1):
            low[:, p] = np.where(low[:, p] == _EMPTY, low[:, (p + 1) % _STRETCHES], low[:, p])
    sign = low[:, : plan.entries]
    values = 1 + (sign[:, 1:] != sign[:, :-1]).sum(1)
    values -= (values > 1) & (sign[:, 0] == sign[:, -1])
    sketch = np.zeros(len(lines), dtype=np.uint64)
    for k in range(plan.entries):
        sketch = (sketch << np.uint64(2)) | (sign[:, k] & np.uint64(3))
    return sign, sketch | np.where(values < plan.least_values, np.uint64(_FEW), np.uint64(0))


def buckets(sign: np.ndarray, plan: LinePlan) -> np.ndarray:
    """A bucket for each line and band."""
    out = np.empty((len(sign), plan.bands), dtype=np.uint64)
    for b in range(plan.bands):
        h = np.full(len(sign), b + 1, dtype=np.uint64)
        for r in range(plan.rows):
            h = _mixed(h * np.uint64(_BASE) + sign[:, b * plan.rows + r])
        out[:, b] = h
    return out


def _slices(batch: pa.RecordBatch, texts: int, rows: int = 2000, characters: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of so many rows and about so many characters; column ``texts`` and what follows are texts."""
    lengths = sum(pc.utf8_length(batch.column(i)).to_numpy() for i in range(texts, batch.num_columns))
    number = np.maximum(np.cumsum(lengths, dtype=np.int64) // characters, np.arange(batch.num_rows) // rows)
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        if low < high:
            yield batch.slice(low, high - low)


def _banded(batches: Iterator[pa.RecordBatch], plan: LinePlan) -> Iterator[pa.RecordBatch]:
    """(bucket, id, sketch) of the lines (id, line) of each batch; each line once."""
    for batch in batches:
        for part in _slices(batch, 1):
            ids, first = np.unique(part.column(0).to_numpy(), return_index=True)
            lines = part.column(1).take(pa.array(first)).to_pylist()
            sign, sketch = signatures(lines, plan)
            found = buckets(sign, plan)
            arrays = [found.ravel().view(np.int64), np.repeat(ids, plan.bands), np.repeat(sketch, plan.bands).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["bucket", "id", "sketch"])


def agreement(x: np.ndarray, y: np.ndarray, plan: LinePlan) -> np.ndarray:
    """Entries of two sketches that agree."""
    apart = x ^ y
    apart = (apart | (apart >> np.uint64(1))) & _PAIRED
    return plan.entries - np.bitwise_count(apart).astype(np.int64)


def may_link(x: np.ndarray, y: np.ndarray, plan: LinePlan) -> np.ndarray:
    """Sketches agree as a linked pair's mostly do: such pairs are compared first, all others of a bucket later."""
    few = ((x | y) & np.uint64(_FEW)) != 0
    return few | (agreement(x, y, plan) >= plan.least_agreement)


def _bucket_pairs(
    ids: np.ndarray, sketches: np.ndarray, plan: LinePlan, leaders: int | None = None
) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """First candidates of one bucket: so many leaders with the members that fit them, the next leader from what fits none."""
    a, b = [], []
    while len(ids) > 1 and (leaders is None or len(a) < leaders):
        leader, sketch, ids, sketches = ids[0], sketches[0], ids[1:], sketches[1:]
        near = ids[may_link(sketch, sketches, plan)]
        a.append(np.full(len(near), leader))
        b.append(near)
        few = ((sketch | sketches) & np.uint64(_FEW)) != 0
        left = agreement(sketch, sketches, plan) < np.where(few, plan.entries, plan.sure_agreement)
        ids, sketches = ids[left], sketches[left]
    return a, b


def _bucket_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
    """(columns, starts, sizes) of whole buckets, of rows sorted by bucket and id; a line that repeats there counts once."""

    def runs(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        bucket, ids = columns[:2]
        new = np.r_[True, (bucket[1:] != bucket[:-1]) | (ids[1:] != ids[:-1])]
        columns = [c[new] for c in columns]
        start = np.flatnonzero(np.r_[True, columns[0][1:] != columns[0][:-1]])
        return columns, start, np.diff(np.r_[start, len(columns[0])])

    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        held = columns if held is None else [np.r_[x, y] for x, y in zip(held, columns, strict=True)]
        earlier = np.flatnonzero(held[0] != held[0][-1]) if len(held[0]) else []
        if len(earlier):
            cut = int(earlier[-1]) + 1
            yield runs([x[:cut] for x in held])
            held = [x[cut:] for x in held]
    if held is not None and len(held[0]):
        yield runs(held)


_PAIR, _OPEN = 0, 1
_FOUND = "kind int, a long, b long, bucket long"
#: leaders of a large bucket
_LEADERS = 8


def _first_pairs(batches: Iterator[pa.RecordBatch], plan: LinePlan) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) of a bucket's first lines with those that fit them, for a comparison; and the rows (a, bucket) of
    every bucket where that leaves a pair of lines."""
    for (bucket, ids, sketch), start, size in _bucket_runs(batches):
        sketch = sketch.view(np.uint64)
        run = np.repeat(np.arange(len(start)), size)
        first = start[run]
        fits = np.flatnonzero((np.arange(len(ids)) != first) & (size[run] <= plan.large))
        fits = fits[may_link(sketch[first[fits]], sketch[fits], plan)]
        a, b = [ids[first[fits]]], [ids[fits]]
        for s, n in zip(start[size > plan.large].tolist(), size[size > plan.large].tolist(), strict=True):
            x, y = _bucket_pairs(ids[s : s + n], sketch[s : s + n], plan, _LEADERS)
            a += x
            b += y
        compared = np.bincount(run[fits], minlength=len(start))
        open_ = np.flatnonzero((size[run] > 2) | ((size[run] == 2) & (compared[run] == 0)))
        one, two = np.concatenate(a), np.concatenate(b)
        kinds = np.repeat(np.array([_PAIR, _OPEN], dtype=np.int32), [len(one), len(open_)])
        none = np.zeros(len(open_), dtype=np.int64), np.zeros(len(one), dtype=np.int64)
        columns = (kinds, np.r_[np.minimum(one, two), ids[open_]], np.r_[np.maximum(one, two), none[0]], np.r_[none[1], bucket[open_]])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["kind", "a", "b", "bucket"])


_WORDS = 8  # of 64 bits, in the bitmap of a set


class _Sets:
    """Distinct shingles of lines, as sorted 48-bit hashes, with their sizes and bitmaps."""

    def __init__(self, lines: list[str], plan: LinePlan):
        self.plan = plan
        owner, hashes = shingle_hashes(lines, plan.width)
        order = np.lexsort((hashes, owner))
        owner, hashes = owner[order], hashes[order] >> np.uint64(16)
        new = np.r_[True, (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]
        owner, self.hashes = owner[new], hashes[new]
        self.size = np.bincount(owner, minlength=len(lines))
        self.start = np.cumsum(self.size) - self.size
        bits = np.zeros(len(lines) * _WORDS, dtype=np.uint64)
        word = ((self.hashes >> np.uint64(6)) & np.uint64(_WORDS - 1)).astype(np.int64)
        np.bitwise_or.at(bits, owner * _WORDS + word, np.uint64(1) << (self.hashes & np.uint64(63)))
        self.bits = bits.reshape(-1, _WORDS)

    def may_link(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Numbers of the pairs that may reach the similarity; no other does: a bit that one bitmap alone has is a shingle that one set alone has."""
        m, n = self.size[x], self.size[y]
        sizes = np.flatnonzero(100 * np.minimum(m, n) >= self.plan.percent * np.maximum(m, n))
        x, y, m, n = x[sizes], y[sizes], m[sizes], n[sizes]
        p, q = self.bits[x], self.bits[y]
        most = np.minimum(m - np.bitwise_count(p & ~q).sum(1, dtype=np.int64), n - np.bitwise_count(q & ~p).sum(1, dtype=np.int64))
        return sizes[100 * most >= self.plan.percent * (m + n - most)]

    def linked(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which pairs reach the similarity, on full sets."""
        out = np.zeros(len(x), dtype=bool)
        work = np.cumsum(self.size[x] + self.size[y])
        part = np.maximum(work // (1 << 18), np.arange(len(x)) // 1000)
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(x)]
        for low, high in zip(edges, edges[1:], strict=False):
            both = np.concatenate([self._keys(x[low:high]), self._keys(y[low:high])])
            both.sort()
            common = (both[1:][both[1:] == both[:-1]] >> np.uint64(48)).astype(np.int64)
            common = np.bincount(common, minlength=high - low)
            out[low:high] = 100 * common >= self.plan.percent * (self.size[x[low:high]] + self.size[y[low:high]] - common)
        return out

    def _keys(self, rows: np.ndarray) -> np.ndarray:
        count = self.size[rows]
        pair = np.repeat(np.arange(len(rows)), count)
        at = np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count) + self.start[rows][pair]
        return (pair.astype(np.uint64) << np.uint64(48)) | self.hashes[at]


def _links_within(group: np.ndarray, component: np.ndarray, block: np.ndarray, both: np.ndarray, sets: _Sets) -> tuple[np.ndarray, np.ndarray]:
    """Links of rows of one group, sorted by it; every two rows of different components are compared, and in a group
    where ``both`` is set only those of different blocks.

    Rows that a link connects on the way count as connected from then on.
    """
    a, b = [], []
    x = np.arange(len(group))
    known = np.unique(component, return_inverse=True)[1]
    for step in range(1, len(group)):
        x = x[x + step < len(group)]
        x = x[group[x] == group[x + step]]
        if not len(x):
            break
        y = x + step
        apart = np.flatnonzero((known[x] != known[y]) & ~(both[x] & (block[x] == block[y])))
        near = apart[sets.may_link(x[apart], y[apart])]
        near = near[sets.linked(x[near], y[near])]
        for i, j in zip(x[near].tolist(), y[near].tolist(), strict=True):
            if known[i] != known[j]:
                a.append(i)
                b.append(j)
                known[known == known[j]] = known[i]
    return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)


def _second_links(batches: Iterator[pa.RecordBatch], plan: LinePlan) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of lines that are not connected yet; rows are bucket, i, j, block, component, id and line, sorted.

    i and j are the blocks of a bucket that meet here.
    """
    held: list[pa.RecordBatch] = []

    def found(rows: pa.Table) -> pa.RecordBatch:
        bucket, i, j, block, component, ids = (rows.column(k).to_numpy() for k in range(6))
        group = np.cumsum(np.r_[True, (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        one, two = _links_within(group, component, block, i != j, _Sets(rows.column(6).to_pylist(), plan))
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[one], ids[two])), pa.array(np.maximum(ids[one], ids[two]))], names=["a", "b"])

    def whole(last: bool) -> Iterator[pa.RecordBatch]:
        """Groups that are complete; the last one is held back unless nothing follows."""
        rows = pa.Table.from_batches(held)
        key = [rows.column(k).to_numpy() for k in range(3)]
        earlier = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in key]))
        cut = rows.num_rows if last else int(earlier[-1]) + 1 if len(earlier) else 0
        held[:] = rows.slice(cut).to_batches()
        if cut:
            yield found(rows.slice(0, cut))

    for batch in batches:
        for part in _slices(batch, 6, 10_000, 1 << 21):
            held.append(part)
            yield from whole(False)
    if held:
        yield from whole(True)


def _lines(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Every line that is not blank: its document (doc, version), place, id and plain text."""
    rows = docs.select(
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**63 - 1)).alias("doc"), F.col(f"`{text}`").alias("body")
    ).where("body is not null")
    rows = rows.select("doc", F.xxhash64("body").alias("version"), F.posexplode_outer(F.split("body", "\n")).alias("place", "raw"))
    rows = rows.select("doc", "version", "place", _plain(F.col("raw")).alias("line")).where("line <> ''")
    return rows.select("doc", "version", "place", F.xxhash64("line").alias("id"), "line")


def _linked(one: list[str], two: list[str], plan: LinePlan) -> np.ndarray:
    """Which pairs of lines reach the similarity, on their full sets of shingles."""

    def distinct(lines: list[str]) -> np.ndarray:
        """Sorted numbers of a pair and 48 bits of a shingle's hash; within a pair these do not meet by chance."""
        pair, hashes = shingle_hashes(lines, plan.width)
        keys = (pair.astype(np.uint64) << np.uint64(48)) | (hashes >> np.uint64(16))
        keys.sort()
        return keys[np.r_[True, keys[1:] != keys[:-1]]]

    def per_pair(keys: np.ndarray) -> np.ndarray:
        return np.bincount((keys >> np.uint64(48)).astype(np.int64), minlength=len(one))

    x, y = distinct(one), distinct(two)
    both = np.r_[x, y]
    both.sort()
    common = per_pair(both[1:][both[1:] == both[:-1]])
    return 100 * common >= plan.percent * (per_pair(x) + per_pair(y) - common)


def _confirm(batches: Iterator[pa.RecordBatch], plan: LinePlan) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch, 2, 1000):
            linked = pa.array(_linked(part.column(2).to_pylist(), part.column(3).to_pylist(), plan))
            yield pa.RecordBatch.from_arrays([part.column(i).filter(linked) for i in range(2)], names=["a", "b"])


def _texts(wanted: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines of the wanted ids, each once."""
    kept = lines.mapInArrow(_kept_lines(wanted), "id long, line string").join(wanted, "id", "left_semi")
    return stage(kept.groupBy("id").agg(F.min("line").alias("line")), "line-texts")


def _links(pairs: DataFrame, texts: DataFrame, plan: LinePlan) -> DataFrame:
    """Those pairs of line ids whose exact similarity links them."""
    full = pairs.join(texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
    full = full.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").select("a", "b", "x", "y")
    return stage(full.mapInArrow(lambda batches: _confirm(batches, plan), "a long, b long"), "line-links")


def _open_blocks(rows: DataFrame, plan: LinePlan) -> DataFrame:
    """Rows (bucket, id, component) of buckets that are not connected, once for every two blocks that meet.

    A bucket has one block for each ``large`` of its rows.
    """
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("component").alias("least"), F.max("component").alias("most"))
    sizes = sizes.where("least <> most").select("bucket", F.ceil(F.col("n") / plan.large).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "component", "id")


def _kept_lines(wanted: DataFrame):
    """Lines whose id may be wanted, each once a batch; ids are hashes."""
    bits = wanted.sparkSession.sparkContext.broadcast(hash_filter.bitmap(wanted, F.col("id")))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            at = np.flatnonzero(hash_filter.holds(bits.value, ids))
            yield batch.take(pa.array(at[np.unique(ids[at], return_index=True)[1]]))

    return kept


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "id")


def line_components(docs: DataFrame, plan: LinePlan = LinePlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """id and component of every line that links with another, different one."""
    lines = _lines(docs, text, key).select("id", "line")
    rows = "bucket long, id long, sketch long"
    banded = lines.mapInArrow(lambda batches: _banded(batches, plan), rows).repartition("bucket").sortWithinPartitions("bucket", "id")
    met = stage(banded.mapInArrow(lambda batches: _first_pairs(batches, plan), _FOUND), "line-first")
    pairs = met.where(F.col("kind") == _PAIR)
    ids = met.select(F.col("a").alias("id")).union(pairs.select("b"))
    wanted = stage(ids.distinct(), "line-wanted")
    texts = _texts(wanted, lines)
    discard(wanted)
    first = stage(pairs.select("a", "b").distinct(), "line-pairs")
    links = _links(first, texts, plan)
    labels = connected(links)
    discard(first, links)
    # what the first lines of a bucket did not connect
    known = met.where(F.col("kind") == _OPEN).select("bucket", F.col("a").alias("id"))
    known = known.join(labels.withColumnRenamed("node", "id"), "id", "left")
    known = stage(known.select("bucket", "id", F.coalesce("component", "id").alias("component")), "line-open")
    dealt = _open_blocks(known, plan).join(texts, "id").select("bucket", "i", "j", "block", "component", "id", "line")
    dealt = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "id")
    links = stage(dealt.mapInArrow(lambda batches: _second_links(batches, plan), "a long, b long").distinct(), "line-links")
    whole = connected(links.union(labels.select(F.col("node").alias("a"), F.col("component").alias("b"))))
    discard(met, texts, known, links, labels)
    return whole.withColumnRenamed("node", "id")


def dropped_lines(docs: DataFrame, plan: LinePlan = LinePlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc, version and the sorted places of the lines that a document loses, for documents that lose any."""
    components = line_components(docs, plan, text, key)
    places = stage(_lines(docs, text, key).select("id", "doc", "version", "place"), "line-places")
    spot = F.struct("doc", "version", "place")
    counted = stage(places.groupBy("id").agg(F.min(spot).alias("spot"), F.max(spot).alias("last")), "line-counts")
    named = stage(counted.join(components, "id", "left").withColumn("component", F.coalesce("component", "id")), "line-named")
    discard(counted)
    keepers = named.groupBy("component").agg(F.min("spot").alias("keeper"), F.max("last").alias("last"))
    keepers = stage(keepers.where("keeper <> last").select("component", "keeper"), "line-keepers")
    repeated = stage(named.select("id", "component").join(keepers, "component").select("id", "keeper"), "line-repeated")
    discard(named, keepers)
    lost = places.join(repeated, "id").where(spot != F.col("keeper"))
    lost = stage(lost.groupBy("doc", "version").agg(F.array_sort(F.collect_set("place")).alias("places")), "line-lost")
    discard(places, repeated)
    return lost


def line_report(docs: DataFrame, plan: LinePlan = LinePlan(), text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped and the places of the dropped lines."""
    lost = dropped_lines(docs, plan, text, key)
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("body"))
    slim = slim.select(
        "doc_id", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.xxhash64("body").alias("version"),
        F.coalesce(F.size(F.split("body", "\n")), F.lit(0)).alias("n_lines"),
    )
    out = stage(slim, "line-documents").join(lost, ["doc", "version"], "left")
    places = F.coalesce("places", F.array().cast("array<int>"))
    return out.select("doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size(places).cast("long").alias("n_dropped"), places.alias("dropped"))


def dedup_lines(docs: DataFrame, plan: LinePlan = LinePlan(), text: str = "text", key: str = "doc_id", length: str | None = None) -> DataFrame:
    """``docs`` without the dropped lines, all rows kept; ``length`` names a column that holds the text's characters."""
    lost = dropped_lines(docs, plan, text, key)
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.xxhash64(F.col(f"`{text}`")).alias("version"),
        F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(2**63 - 1)).alias("doc"),
    )
    rows = rows.join(lost, ["doc", "version"], "left")
    body = F.col("row").getField(text)
    left = F.filter(F.split(body, "\n"), lambda line, i: ~F.array_contains("places", i))
    rows = rows.select("row", F.when(F.col("places").isNull(), body).otherwise(F.array_join(left, "\n")).alias("left"))
    out = {c: F.col("row").getField(c) for c in docs.columns} | {text: F.col("left")}
    if length is not None:
        out[length] = F.length("left").cast(docs.schema[length].dataType)
    return rows.select(*(v.alias(c) for c, v in out.items()))

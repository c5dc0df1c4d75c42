"""Alignment of two tokenizers: which tokens of one overlap which tokens of the other.

Tokens of A and B spell the same bytes. Two tokens are linked where their byte
ranges overlap; bytes at which tokens of both end cut a text into groups.

Merging is vectorised in lockstep. One state vector holds a pointer into A and
one into B for every stretch of text of a batch. A step links the two tokens
that all pointers stand at, records a cut where both end together, and moves on
whichever token ends first, or both. Finished stretches leave the vector. A
stretch is ``stretch_bytes`` of a text: a long text enters as many stretches, so
that it takes no more steps than a short one; a link belongs to the stretch in
which its common bytes begin.

How often each pair of ids is linked in the whole corpus is counted with one
shuffle. A chunk of documents (about ``chunk_bytes`` of text, in the order of
its task) keeps a dictionary of its pairs; dictionaries, not documents, meet
for the counts, and come back to their chunk. A chunk and its dictionary are
all that a task holds. Chunks are written to the shared folder first, so that
an executor that is lost costs its tasks.

Defined results: a text that is null or empty, or that one of the tokenizers
does not spell byte by byte (as U+2581 in B), has no tokens, groups and links.
Rows are judged one by one: repeated rows count repeatedly, ids may be null or
repeat. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimgauge.sources.scratch import stage

_ID_BITS = 20  # of the id in B within a pair


def _byte_alphabet() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves, and the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


def _piece_bytes(piece: str) -> bytes:
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


#: characters whose classes no edition of Unicode has changed, so that every regex engine splits them alike
_STABLE = re.compile("[\\0-\\u036f\\u2010-\\u2027]*")
#: the split in front of A's merges, with the white space of these characters spelled out
_S = r"\t-\r \x85\xa0"
_SPLIT = regex.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)


class Tokenizers:
    """A: a byte-level tokenizer file; B: a SentencePiece model. Both with the bytes of each id.

    A's tokens never cross the words that its pattern splits, so that each word is
    encoded once per task (``cache_words`` short ones are kept). Texts with characters
    that editions of Unicode class differently go to the tokenizer whole.
    """

    def __init__(self, a_path: str, b_path: str, cache_words: int = 400_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(a_path)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = _byte_alphabet()
        a_bytes = [b""] * self._a.get_vocab_size()
        for text, i in self._a.get_vocab().items():
            known = all(c in letters for c in text)
            a_bytes[i] = bytes(letters[c] for c in text) if known else text.encode()
        b_bytes = [_piece_bytes(self._b.id_to_piece(i)) for i in range(self._b.get_piece_size())]
        if len(b_bytes) >= 1 << _ID_BITS:
            raise ValueError("the vocabulary of B is too large for packed pairs")
        self.a, self.b = _Side(a_bytes), _Side(b_bytes)
        self.cache_words, self._cache = cache_words, {}

    def encode_a(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text in A; None where they do not spell it."""
        split = [_SPLIT.findall(t) if _STABLE.fullmatch(t) else [t] for t in texts]
        wanted = set().union(*split)
        if len(self._cache) + len(wanted) > self.cache_words:
            self._cache = {}
        known = {w: self._cache[w] for w in wanted & self._cache.keys()}
        new = list(wanted - known.keys())
        for word, found in zip(new, self._a.encode_batch_fast(new, add_special_tokens=False), strict=True):
            ids = found.ids
            known[word] = np.array(ids, dtype=np.int32).tobytes() if self.a.spell(ids) == word.encode() else None
        self._cache.update((w, known[w]) for w in new if len(w) <= 64)
        out = []
        for words in split:
            parts = [known[w] for w in words]
            out.append(None if None in parts else np.frombuffer(b"".join(parts), dtype=np.int32).astype(np.int64))
        return out

    def encode_b(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text in B, which adds a blank in front; None where they do not spell both."""
        found = self._b.encode(texts, num_threads=1)
        return [
            np.array(ids, dtype=np.int64) if self.b.spell(ids) == (" " + t).encode() else None for t, ids in zip(texts, found, strict=True)
        ]


class _Side:
    """Bytes and length of each id, and the id as it is written among groups."""

    def __init__(self, surfaces: list[bytes]) -> None:
        self.surfaces = surfaces
        self.lengths = np.array([len(s) for s in surfaces], dtype=np.int64)

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.surfaces.__getitem__, ids))

    def written(self, last: str) -> np.ndarray:
        """At 2 * id an id that another of its group follows, at 2 * id + 1 one that ``last`` follows."""
        out = np.empty(2 * len(self.surfaces), dtype=object)
        out[0::2] = [f"{i}," for i in range(len(self.surfaces))]
        out[1::2] = [f"{i}{last}" for i in range(len(self.surfaces))]
        return out


@lru_cache(maxsize=2)
def _loaded(a_path: str, b_path: str) -> tuple[Tokenizers, np.ndarray, np.ndarray]:
    """Kept for later tasks of the same Python worker."""
    both = Tokenizers(a_path, b_path)
    return both, both.a.written("|"), both.b.written(";")


def merge_lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, text_ends: np.ndarray, stretch_bytes: int = 1024
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of texts laid end to end, as indices of tokens of A and of B, and whether a cut follows.

    ``a_ends`` and ``b_ends`` are the ends of all tokens in bytes (ascending; tokens
    that spell nothing are not supported), ``text_ends`` those of the texts.
    Links come in the order of their first common byte.
    """
    total = int(text_ends[-1]) if len(text_ends) else 0
    starts = np.r_[0, text_ends[:-1]].astype(np.int64)
    per_text = -(-(text_ends - starts) // stretch_bytes)
    text = np.repeat(np.arange(len(text_ends)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    first = starts[text] + number * stretch_bytes
    stop = np.minimum(first + stretch_bytes, text_ends[text])
    i = np.searchsorted(a_ends, first, side="right")
    j = np.searchsorted(b_ends, first, side="right")
    # at the byte where a link begins: the tokens that it holds and what it cuts
    a_at = np.full(total, -1, dtype=np.int32)
    b_at = np.zeros(total, dtype=np.int32)
    cut_at = np.zeros(total, dtype=bool)
    a_from, b_from = np.r_[0, a_ends[:-1]], np.r_[0, b_ends[:-1]]
    begin = np.maximum(a_from[i], b_from[j])
    own = begin >= first  # the first pair may have begun in the stretch before
    while len(i):
        a_end, b_end = a_ends[i], b_ends[j]
        both = a_end == b_end
        at = begin if own is None else begin[own]
        a_at[at], b_at[at], cut_at[at] = (i, j, both) if own is None else (i[own], j[own], both[own])
        own = None
        begin = np.minimum(a_end, b_end)
        i = i + (a_end <= b_end)
        j = j + (b_end <= a_end)
        go = begin < stop
        if not go.all():
            i, j, begin, stop = i[go], j[go], begin[go], stop[go]
    found = np.flatnonzero(a_at >= 0)
    return a_at[found].astype(np.int64), b_at[found].astype(np.int64), cut_at[found]


def _groups_texts(links, offsets_a, offsets_b, a_ids, b_ids, a_written, b_written) -> list[str]:
    """Each text's groups as ``a1,a2|b1;a3|b2,b3``."""
    a_idx, b_idx, cut = links
    a_last, b_last = np.zeros(len(a_ids), dtype=bool), np.zeros(len(b_ids), dtype=bool)
    a_last[a_idx[cut]] = True
    b_last[b_idx[cut]] = True
    # ids in the order group, side, place: each is moved back by the tokens of the other side before it
    a_group = np.cumsum(a_last) - a_last
    b_group = np.cumsum(b_last) - b_last
    groups = int(a_last.sum())
    a_until = np.cumsum(np.bincount(a_group, minlength=groups))
    b_until = np.cumsum(np.bincount(b_group, minlength=groups))
    out = np.empty(len(a_ids) + len(b_ids), dtype=object)
    b_before = np.r_[0, b_until]
    out[np.arange(len(a_ids)) + b_before[a_group]] = a_written[2 * a_ids + a_last]
    out[np.arange(len(b_ids)) + a_until[b_group]] = b_written[2 * b_ids + b_last]
    edges = (offsets_a + offsets_b).tolist()
    flat = out.tolist()
    return ["".join(flat[x:y])[:-1] for x, y in zip(edges, edges[1:], strict=False)]


class _Chunk:
    """Documents aligned so far, and the pairs that they link."""

    def __init__(self) -> None:
        self.name = uuid.uuid4().hex
        self.bytes, self.rows = 0, []
        self.pairs, self.times, self.counts = [], [], []

    def add(self, keys: pa.RecordBatch, texts: list[str | None], tools, stretch_bytes: int, keep_groups: bool) -> None:
        both, a_written, b_written = tools
        spoken = [k for k, t in enumerate(texts) if t]
        self.bytes += sum(len(texts[k]) for k in spoken)
        both_ids = zip(spoken, both.encode_a([" " + texts[k] for k in spoken]), both.encode_b([texts[k] for k in spoken]), strict=True)
        known = [(k, a, b) for k, a, b in both_ids if a is not None and b is not None]
        good, a_good, b_good = ([x[i] for x in known] for i in range(3))
        n = len(texts)
        n_a, n_b = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        n_a[good], n_b[good] = [len(x) for x in a_good], [len(x) for x in b_good]
        groups, links_of, digest, shown = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [""] * n, [""] * n
        counts = np.zeros(n, dtype=np.int64)
        if good:
            a_ids, b_ids = (np.concatenate(side) for side in (a_good, b_good))
            a_ends, b_ends = np.cumsum(both.a.lengths[a_ids]), np.cumsum(both.b.lengths[b_ids])
            a_off, b_off = np.r_[0, np.cumsum(n_a[good])], np.r_[0, np.cumsum(n_b[good])]
            links = merge_lockstep(a_ends, b_ends, a_ends[a_off[1:] - 1], stretch_bytes)
            owner = np.searchsorted(a_off, links[0], side="right") - 1
            links_of[good] = np.bincount(owner, minlength=len(good))
            groups[good] = np.bincount(owner[links[2]], minlength=len(good))
            texts_of = _groups_texts(links, a_off, b_off, a_ids, b_ids, a_written, b_written)
            for k, text in zip(good, texts_of, strict=True):
                digest[k] = hashlib.sha256(text.encode()).hexdigest()
                if keep_groups:
                    shown[k] = text
            pair = (a_ids[links[0]] << _ID_BITS) | b_ids[links[1]]
            order = np.lexsort((pair, owner))
            pair, owner = pair[order], owner[order]
            new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])])
            self.pairs.append(pair[new])
            self.times.append(np.diff(np.r_[new, len(pair)]))
            counts[good] = np.bincount(owner[new], minlength=len(good))
        self.counts.append(counts)
        self.rows.append((keys, n_a, n_b, groups, links_of, digest, shown))

    def tables(self, names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per document, its pairs as places in the dictionary, and a row with the dictionary."""
        pairs = np.concatenate(self.pairs) if self.pairs else np.zeros(0, dtype=np.int64)
        times = np.concatenate(self.times) if self.times else np.zeros(0, dtype=np.int64)
        known, place = np.unique(pairs, return_inverse=True)
        at = 0
        for (keys, n_a, n_b, groups, links, digest, shown), counts in zip(self.rows, self.counts, strict=True):
            until = at + int(counts.sum())
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            n = len(n_a)
            made = {name: keys.column(i) for i, name in enumerate(names)} | {
                "al_chunk": pa.array([self.name] * n), "al_a": pa.array(n_a), "al_b": pa.array(n_b),
                "al_groups": pa.array(groups), "al_links": pa.array(links), "al_digest": pa.array(digest), "al_shown": pa.array(shown),
                "al_pairs": pa.ListArray.from_arrays(offsets, pa.array(place[at:until].astype(np.int64))),
                "al_times": pa.ListArray.from_arrays(offsets, pa.array(times[at:until].astype(np.int64))),
                "al_is_words": pa.array([False] * n),
            }
            yield _filled(made, n, schema)
            at = until
        if len(known):
            used = np.zeros(len(known), dtype=np.int64)
            np.add.at(used, place, times)
            yield _filled(
                {
                    "al_chunk": pa.array([self.name]), "al_pairs": pa.array([known.tolist()], pa.list_(pa.int64())),
                    "al_times": pa.array([used.tolist()], pa.list_(pa.int64())), "al_is_words": pa.array([True]),
                },
                1, schema,
            )


def _filled(columns: dict[str, pa.Array], n: int, schema: pa.Schema) -> pa.RecordBatch:
    arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: what a chunk's rows hold besides the columns that stay
_CHUNK = {
    "al_chunk": ("string", pa.string()),
    "al_a": ("long", pa.int64()),
    "al_b": ("long", pa.int64()),
    "al_groups": ("long", pa.int64()),
    "al_links": ("long", pa.int64()),
    "al_digest": ("string", pa.string()),
    "al_shown": ("string", pa.string()),
    "al_pairs": ("array<long>", pa.list_(pa.int64())),
    "al_times": ("array<long>", pa.list_(pa.int64())),
    "al_is_words": ("boolean", pa.bool_()),
}


def _chunks(docs: DataFrame, a_path, b_path, text, chunk_bytes, stretch_bytes, keep_groups) -> DataFrame:
    kept = [c for c in docs.columns if c != text]
    names = [f"key{i}" for i in range(len(kept))]
    keys = [F.col(f"`{c}`").alias(n) for c, n in zip(kept, names, strict=True)]
    schema = docs.select(*keys, *(F.lit(None).cast(kind).alias(c) for c, (kind, _) in _CHUNK.items())).schema

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, chunk, arrow = _loaded(a_path, b_path), _Chunk(), None
        for frame in frames:
            arrow = pa.schema([*list(frame.schema)[:-1], *(pa.field(c, kind) for c, (_, kind) in _CHUNK.items())])
            for at in range(0, frame.num_rows, 256):
                part = frame.slice(at, 256)
                chunk.add(part, part.column(part.num_columns - 1).to_pylist(), tools, stretch_bytes, keep_groups)
                if chunk.bytes >= chunk_bytes:
                    yield from chunk.tables(names, arrow)
                    chunk = _Chunk()
        if arrow is not None:
            yield from chunk.tables(names, arrow)

    return docs.select(*keys, F.col(f"`{text}`").alias("text")).mapInArrow(batches, schema)


def _counted_words(chunks: DataFrame) -> DataFrame:
    """Dictionary entries with the corpus-wide count of their pair, and whether no pair of the same B id has more."""
    entries = chunks.where("al_is_words").select(
        F.col("al_chunk").alias("chunk"), F.posexplode(F.arrays_zip("al_pairs", "al_times")).alias("place", "entry")
    )
    entries = entries.select("chunk", "place", F.col("entry.al_pairs").alias("pair"), F.col("entry.al_times").alias("times"))
    # a pair is listed once by each chunk
    counted = entries.withColumn("n", F.sum("times").over(Window.partitionBy("pair")))
    counted = stage(counted.select("chunk", "place", F.col("pair").bitwiseAND((1 << _ID_BITS) - 1).alias("b"), "n"), "pair-counts")
    # one row for each id of B: no more than its vocabulary
    best = counted.groupBy("b").agg(F.max("n").alias("most"))
    return counted.join(F.broadcast(best), "b").select("chunk", "place", "n", (F.col("n") == F.col("most")).alias("is_best"))


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    chunk_bytes: int = 24 << 20,
    stretch_bytes: int = 1024,
    keep_groups: bool = False,
) -> DataFrame:
    """``docs`` without the text, with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    With ``keep_groups`` also the groups themselves, as text. Other columns stay as
    they are; those with a name of a result are replaced.
    """
    results = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] + (["groups"] if keep_groups else [])
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in results))
    kept = [c for c in docs.columns if c != text]
    keys = [f"key{i}" for i in range(len(kept))]
    chunks = stage(_chunks(docs, a_path, b_path, text, chunk_bytes, stretch_bytes, keep_groups), "aligned-chunks")
    rows = chunks.where("not al_is_words").drop("al_is_words")
    words = _counted_words(chunks)
    numbers = ["al_a", "al_b", "al_groups", "al_links"]
    schema = rows.select(*keys, *numbers, "al_digest", "al_shown").schema.add("best", "long").add("total", "long")

    def judged(group: pa.Table, known: pa.Table) -> pa.Table:
        count = np.zeros(known.num_rows, dtype=np.int64)
        best = np.zeros(known.num_rows, dtype=bool)
        place = known.column("place").to_numpy()
        count[place], best[place] = known.column("n").to_numpy(), known.column("is_best").to_numpy(zero_copy_only=False)
        group = group.combine_chunks()
        out = [group.column(c) for c in [*keys, *numbers, "al_digest", "al_shown"]]
        pairs, times = group.column("al_pairs").combine_chunks(), group.column("al_times").combine_chunks()
        if not isinstance(pairs, pa.ListArray | pa.LargeListArray):
            pairs, times = pa.concat_arrays(pairs.chunks), pa.concat_arrays(times.chunks)
        at, held = pairs.flatten().to_numpy(), times.flatten().to_numpy()
        ends = np.r_[0, np.cumsum(pairs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]
        for values in (held * best[at], held * count[at]):
            sums = np.r_[0, np.cumsum(values)]
            out.append(pa.chunked_array([pa.array(sums[ends[1:]] - sums[ends[:-1]])]))
        return pa.table(out, names=[f.name for f in schema])

    joined = rows.groupBy(F.col("al_chunk")).cogroup(words.groupBy(F.col("chunk"))).applyInArrow(judged, schema)
    found = [*numbers, "best", "total", "al_digest", "al_shown"]
    return joined.select(
        *(F.col(k).alias(c) for k, c in zip(keys, kept, strict=True)), *(F.col(x).alias(r) for x, r in zip(found, results, strict=False))
    )

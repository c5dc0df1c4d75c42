"""Phrase collocations by Rabin-Karp fingerprints of all n-grams.

1. Tasks hash every n-gram of one to ``longest`` words from prefix polynomials
   over the bytes of a batch, in numpy. A fingerprint is 64 bits of one
   polynomial; 32 bits of a second one tell fingerprints apart that two n-grams
   share.
2. Each task adds up what it has read (about ``flush`` n-grams at a time), and
   sends fingerprints with their counts and a pointer to an occurrence. They
   travel packed, sorted and dealt to buckets of the hash range, whose number
   follows the size of the texts; a frequent n-gram is one entry per flush, so
   that no bucket is hot. Words and pairs come first. An n-gram of three words or
   more is sent only if both of its parts of one word less may be frequent: each
   task has a bitmap of ``FILTER_BITS`` bits with the frequent ones. Its size is
   fixed; for very many frequent parts it lets more through, and loses none.
3. Fingerprints that occur often enough are looked up in the texts that their
   pointers name: the text must hold an n-gram of this fingerprint under both
   polynomials. Only then an n-gram becomes a string.
4. Counts of parts, scores and the drop of phrases inside longer ones are joins
   of the frequent phrases, since a part is at least as frequent as its phrase.

A pointer is 32 bits of the hash of a whole text. Several texts under one
pointer are all searched, and copies of a text give the same phrases.

Defined results: a null text is empty, a null language is ``und``. Texts are cut
into pieces at sentence punctuation and line ends, pieces into words at blanks
and tabs; no phrase crosses pieces or texts. A phrase of k words counts every
occurrence, overlaps included. Row order, ids and other columns do not matter;
repeated rows count repeatedly. An empty table gives no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimgauge.sources.scratch import stage

SEPARATORS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: odd multipliers of the two polynomials, and of the mix that ends a hash
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: a bit for each value of so many leading bits of a fingerprint: 16 MB, whatever the corpus
FILTER_BITS = 27
_ENTRY = np.dtype([("fp", "<u8"), ("check", "<u4"), ("n", "<u8"), ("pointer", "<u4")])

_byte = np.arange(256)
_IS_SEPARATOR = np.isin(_byte, list(SEPARATORS))
_IS_WORD = ~_IS_SEPARATOR & ~np.isin(_byte, list(BLANKS))


@lru_cache(maxsize=2)
def _letters(which: int) -> np.ndarray:
    """A fixed random number for each byte."""
    return np.random.default_rng(which).integers(1, 1 << 63, 256, dtype=np.uint64)


class _Powers:
    """Powers of the bases and of their inverses, as many as were asked for."""

    def __init__(self) -> None:
        self.known = {}

    def __call__(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in self.known or len(self.known[base][0]) < n:
            size = max(n, 1 << 20)
            made = []
            for factor in (base, pow(base, -1, 1 << 64)):
                steps = np.full(size, factor, dtype=np.uint64)
                steps[0] = 1
                made.append(np.cumprod(steps))
            self.known[base] = tuple(made)
        return self.known[base]


_powers = _Powers()


class Words:
    """Words of texts laid end to end, each followed by one blank, and the piece that each is in."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b"\n".join(texts).translate(_LOWER) + b"\n", dtype=np.uint8)
        is_word = _IS_WORD[raw]
        before = np.r_[False, is_word[:-1]]
        starts = np.flatnonzero(is_word & ~before)
        ends = np.flatnonzero(~is_word & before)
        self.piece = np.cumsum(_IS_SEPARATOR[raw], dtype=np.int64)[starts]
        edges = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(edges, starts, side="right")
        self.bytes = np.where(is_word, raw, 32)[is_word | before].astype(np.uint8)
        lengths = ends - starts
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths

    def __len__(self) -> int:
        return len(self.starts)

    def phrase(self, at: int, n: int) -> str:
        return self.bytes[self.starts[at] : self.ends[at + n - 1]].tobytes().decode()

    def hashed(
        self, lengths: Sequence[int], bits: int = 64, block: int = 200_000, ahead: int = 0
    ) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(n, first word, fingerprint, check) of all n-grams, for ``block`` words at a time.

        Those of the first length go on for ``ahead`` words of the next block.
        """
        for low in range(0, len(self), block):
            high = min(low + block, len(self))
            last = min(high + ahead + max(lengths) - 1, len(self))
            origin = self.starts[low]
            part = self.bytes[origin : self.ends[last - 1]]
            sums = []
            for which, base in enumerate(_BASES):
                powers, inverse = _powers(base, len(part) + 1)
                terms = _letters(which)[part]
                terms *= powers[: len(part)]
                sums.append((np.r_[np.uint64(0), np.cumsum(terms)], inverse))
            for n in lengths:
                until = high + (ahead if n == lengths[0] else 0)
                first = np.arange(low, min(until, len(self) - n + 1))
                first = first[self.piece[first] == self.piece[first + n - 1]]
                a, z = self.starts[first] - origin, self.ends[first + n - 1] - origin
                made = []
                for prefix, inverse in sums:
                    h = prefix[z] - prefix[a]
                    h *= inverse[a]
                    for factor in _MIX:
                        h ^= h >> np.uint64(31)
                        h *= np.uint64(factor)
                    made.append(h ^ (h >> np.uint64(32)))
                yield n, first, made[0] >> np.uint64(64 - bits), made[1].astype(np.uint32)


def _pack(entries: np.ndarray) -> bytes:
    """Sorted entries, one column after the other, byte by byte, so that small numbers compress."""
    steps = np.diff(entries["fp"], prepend=np.uint64(0))
    parts = [steps, entries["n"], entries["check"], entries["pointer"]]
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() for x in map(np.ascontiguousarray, parts)]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(packed, n * 24, codec="zstd", asbytes=True), dtype=np.uint8)
    out, at = np.empty(n, dtype=_ENTRY), 0
    for name, kind in (("fp", "<u8"), ("n", "<u8"), ("check", "<u4"), ("pointer", "<u4")):
        width = np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(raw[at : at + width * n].reshape(width, n).T).view(kind).ravel()
        at += width * n
    out["fp"] = np.cumsum(out["fp"])
    return out


def _summed(entries: np.ndarray) -> np.ndarray:
    """One entry for each fingerprint and check, in order."""
    order = np.argsort(entries["fp"], kind="stable")  # sorted runs are merged
    other_fp, other_check = (np.diff(entries[c][order]) != 0 for c in ("fp", "check"))
    if (other_check & ~other_fp).any():  # n-grams that share a fingerprint
        order = np.lexsort((entries["check"], entries["fp"]))
        other_fp, other_check = (np.diff(entries[c][order]) != 0 for c in ("fp", "check"))
    entries = entries[order]
    at = np.flatnonzero(np.r_[len(entries) > 0, other_fp | other_check])
    out = entries[at]
    if len(at):
        out["n"] = np.add.reduceat(entries["n"], at)
        out["pointer"] = np.minimum.reduceat(entries["pointer"], at)
    return out


_PACKED = "bucket int, lang string, n int, entries long, occurrences long, packed binary"


def _filter_place(fp: np.ndarray, bits: int) -> np.ndarray:
    return (fp << np.uint64(64 - bits)) >> np.uint64(64 - FILTER_BITS)


def _frequent_parts(found: DataFrame, n: int, bits: int) -> np.ndarray:
    """A bit for each n-gram that is frequent in any language; the driver and every task hold 16 MB."""
    place = F.shiftrightunsigned(F.shiftleft("fp", 64 - bits), 64 - FILTER_BITS)
    places = found.where(F.col("n") == n).select((place + 1).alias("place"))  # buckets count from 1
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    for row in parts.collect():
        part = np.frombuffer(row["bits"], dtype=np.uint8)
        out[(row["at"] - 1) * len(part) : row["at"] * len(part)] = part
    return out


def _packed(
    rows: DataFrame, lengths: Sequence[int], buckets: int, flush: int, bits: int, batch_bytes: int, parts: np.ndarray | None = None
) -> DataFrame:
    """Counted fingerprints of each task, by bucket, language and length.

    With ``parts`` only those whose parts of one word less are among them.
    """
    kept = None if parts is None else rows.sparkSession.sparkContext.broadcast(parts)

    def send(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, n), parts in held.items():
            fp, check, pointer = (np.concatenate(x) for x in zip(*parts, strict=True))
            entries = np.empty(len(fp), dtype=_ENTRY)
            entries["fp"], entries["check"], entries["n"], entries["pointer"] = fp, check, 1, pointer
            entries = _summed(entries)
            # buckets are ranges of the fingerprint: 32 of its bits, scaled
            high = entries["fp"] >> np.uint64(bits - 32) if bits >= 32 else entries["fp"] << np.uint64(32 - bits)
            cuts = np.searchsorted((high * np.uint64(buckets)) >> np.uint64(32), np.arange(buckets + 1))
            out = {c: [] for c in ("bucket", "entries", "occurrences", "packed")}
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                part = entries[cuts[b] : cuts[b + 1]]
                for c, v in zip(out, (b, len(part), int(part["n"].sum()), _pack(part)), strict=True):
                    out[c].append(v)
            m = len(out["bucket"])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["bucket"], pa.int32()), pa.array([lang] * m, pa.string()), pa.array([n] * m, pa.int32()),
                    pa.array(out["entries"], pa.int64()), pa.array(out["occurrences"], pa.int64()), pa.array(out["packed"], pa.binary()),
                ],
                names=["bucket", "lang", "n", "entries", "occurrences", "packed"],
            )

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = {}, 0
        for lang, pointers, texts in _by_language(frames, batch_bytes):
            words = Words(texts)
            pointer_of = np.asarray(pointers, dtype=np.uint32)[words.text]
            for n, first, fp, check in _hashed(words, lengths, bits, kept):
                held.setdefault((lang, n), []).append((fp, check, pointer_of[first]))
                count += len(fp)
                if count >= flush:
                    yield from send(held)
                    held, count = {}, 0
        yield from send(held)

    return rows.select("lang", "pointer", "text").mapInArrow(batches, _PACKED)


def _hashed(words: Words, lengths: Sequence[int], bits: int, kept) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    if kept is None:
        yield from words.hashed(lengths, bits)
        return
    (n,) = lengths
    frequent = np.zeros(len(words) + 1, dtype=bool)
    for length, first, fp, check in words.hashed((n - 1, n), bits, ahead=1):
        if length < n:
            place = _filter_place(fp, bits)
            frequent[first] = (kept.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
        else:
            both = frequent[first] & frequent[first + 1]
            yield n, first[both], fp[both], check[both]


def _by_language(frames: Iterator[pa.RecordBatch], batch_bytes: int) -> Iterator[tuple[str, list[int], list[bytes]]]:
    """(language, pointers, texts) of about ``batch_bytes`` each; a text is never split."""
    open_: dict[str, tuple[list[int], list[bytes]]] = {}
    sizes: dict[str, int] = {}
    for frame in frames:
        for at in range(0, frame.num_rows, 256):
            part = frame.slice(at, 256)
            texts = part.column(2).cast(pa.binary()).to_pylist()
            for lang, pointer, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts, strict=True):
                pointers, held = open_.setdefault(lang, ([], []))
                pointers.append(pointer)
                held.append(text)
                sizes[lang] = sizes.get(lang, 0) + len(text)
                if sizes[lang] >= batch_bytes:
                    yield lang, *open_.pop(lang)
                    del sizes[lang]
    for lang, (pointers, held) in open_.items():
        yield lang, pointers, held


_FOUND = "lang string, n int, fp long, check long, f long, pointer long"


def _frequent(packed: DataFrame, least: int) -> DataFrame:
    """Fingerprints with at least ``least`` occurrences; rows with n = 0 hold numbers of words."""

    def merged(group: pa.Table) -> pa.Table:
        keys = list(zip(group.column("lang").to_pylist(), group.column("n").to_pylist(), strict=True))
        sizes, packs = group.column("entries").to_pylist(), group.column("packed").to_pylist()
        words = group.column("occurrences").to_pylist()
        out = []
        for lang, n in sorted(set(keys)):
            mine = [i for i, k in enumerate(keys) if k == (lang, n)]
            entries = _summed(np.concatenate([_unpack(packs[i], sizes[i]) for i in mine]))
            entries = entries[entries["n"] >= least]
            columns = [entries["fp"].view(np.int64), entries["check"].astype(np.int64), entries["n"].astype(np.int64)]
            columns.append(entries["pointer"].astype(np.int64))
            columns = [np.ascontiguousarray(c) for c in columns]
            m = len(entries)
            if n == 1:
                m += 1
                zero = np.zeros(1, dtype=np.int64)
                total = np.array([sum(words[i] for i in mine)], dtype=np.int64)
                columns = [np.r_[c, x] for c, x in zip(columns, (zero, zero, total, zero), strict=True)]
            lengths = pa.array([n] * len(entries) + [0] * (m - len(entries)), pa.int32())
            out.append(pa.table([pa.array([lang] * m, pa.string()), lengths, *map(pa.array, columns)], names=_NAMES))
        return pa.concat_tables(out)

    return packed.groupBy("bucket").applyInArrow(merged, _FOUND)


_NAMES = ["lang", "n", "fp", "check", "f", "pointer"]


def _spelled(rows: DataFrame, found: DataFrame, longest: int, bits: int) -> DataFrame:
    """lang, phrase, words, f: the n-grams behind the found fingerprints, from the texts that the pointers name."""
    wanted = (
        found.where("n > 0")
        .groupBy("lang", "pointer")
        .agg(F.collect_list(F.struct("n", "fp", "check", "f")).alias("wanted"))
    )
    joined = rows.join(wanted, ["lang", "pointer"]).select("lang", "text", "wanted")

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for at in range(0, frame.num_rows, 64):
                part = frame.slice(at, 64)
                langs, phrases, lengths, counts = [], [], [], []
                texts = part.column(1).cast(pa.binary()).to_pylist()
                lists = part.column(2)
                fields = {c: lists.flatten().field(c).to_numpy() for c in ("n", "fp", "check", "f")}
                ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
                words = Words(texts)
                owner = words.text
                for n, first, fp, check in words.hashed(range(1, longest + 1), bits):
                    # the wanted ones of length n, looked up by text and fingerprint
                    fp = fp.view(np.int64)
                    mine = np.flatnonzero(fields["n"] == n)
                    text = np.searchsorted(ends, mine, side="right") - 1
                    near = np.flatnonzero(np.isin(fp, fields["fp"][mine]))
                    have = {}
                    for k, t, x, y in zip(first[near].tolist(), owner[first[near]].tolist(), fp[near].tolist(), check[near].tolist(), strict=True):
                        have.setdefault((t, x, y), k)
                    asked = zip(text.tolist(), fields["fp"][mine].tolist(), fields["check"][mine].tolist(), fields["f"][mine].tolist(), strict=True)
                    for t, x, y, f in asked:
                        k = have.get((t, x, y))
                        if k is not None:
                            langs.append(part.column(0)[t].as_py())
                            phrases.append(words.phrase(k, n))
                            lengths.append(n)
                            counts.append(f)
                arrays = [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(lengths, pa.int32()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["lang", "phrase", "words", "f"])

    # a block of words may find a phrase again, and so may a copy of the text
    return joined.mapInArrow(batches, "lang string, phrase string, words int, f long").distinct()


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    least: int = 10,
    bucket_bytes: int = 8 << 20,
    flush: int = 3_000_000,
    bits: int = 64,
    batch_bytes: int = 1 << 20,
) -> tuple[DataFrame, DataFrame]:
    """Phrases of 1 to ``longest`` words that occur ``least`` times in a language, and words per language.

    Columns lang, phrase, words, f of the one and lang, n of the other, both as
    written tables. ``bits`` of a fingerprint are used, 64 at most.
    """
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), body.alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumn("pointer", F.xxhash64("text").bitwiseAND(0xFFFFFFFF))
    buckets = max(1, -(-size // bucket_bytes))
    lengths = tuple(range(1, min(longest, 2) + 1))
    found = [stage(_frequent(_packed(rows, lengths, buckets, flush, bits, batch_bytes), least), "fingerprints")]
    totals = found[0].where("n = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    for n in range(3, longest + 1):
        parts = _frequent_parts(found[-1], n - 1, bits)
        found.append(stage(_frequent(_packed(rows, (n,), buckets, flush, bits, batch_bytes, parts), least), "fingerprints"))
    found = reduce(DataFrame.unionByName, found)
    phrases = stage(_spelled(rows, found, longest, bits), "phrases")
    return phrases, totals


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = 3,
    least: int = 10,
    top: int = 2000,
    inside_percent: int = 50,
    **sizes: int,
) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of each language by score; ties go to the smaller phrase.

    Columns lang, rank, phrase, a, l, r, n and score, where l and r are the counts of
    the parts at the weakest cut. A phrase inside a longer one with at least
    ``inside_percent`` of its occurrences is left out. ``sizes`` go to ``frequent_phrases``.
    """
    known, totals = frequent_phrases(docs, text, lang, longest, least, **sizes)
    counts = known.select("lang", F.col("phrase").alias("part"), F.col("f").alias("times"))
    long_ones = known.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))

    # every cut with the counts of its parts, then the weakest
    cut = long_ones.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).selectExpr(
        "*", "substring_index(phrase, ' ', k) as part_l", "substring_index(phrase, ' ', k - words) as part_r"
    )
    for side in ("l", "r"):
        found = counts.withColumnsRenamed({"part": f"part_{side}", "times": side})
        cut = cut.join(found, ["lang", f"part_{side}"])
    exact = "decimal(19, 0)"
    score = f"(cast(1000000 as decimal(7, 0)) * cast(cast(a as {exact}) * a as decimal(31, 0))) div (cast(l as {exact}) * cast(r as {exact}))"
    weakest = (
        cut.withColumn("score", F.expr(score))
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )

    # phrases one word longer cover all: a part of a part is a part, and occurs at least as often
    whole = long_ones.where("words >= 3").select("lang", "words", "phrase", "a")
    inner = [(m, k) for m in range(2, longest) for k in range(longest - m + 1)]
    spans = F.array(*(F.when(F.col("words") >= m + k, F.array_join(F.slice(F.split("phrase", " "), k + 1, m), " ")) for m, k in inner))
    if inner:
        around = (
            whole.select("lang", "a", F.explode(F.array_compact(spans)).alias("inside"), F.col("phrase").alias("outer"))
            .where("inside <> outer")
            .groupBy("lang", "inside")
            .agg(F.max("a").alias("around"))
        )
        weakest = weakest.join(
            around.withColumnRenamed("inside", "phrase"), ["lang", "phrase"], "left"
        ).where(f"around is null or 100 * around < {int(inside_percent)} * a")

    # the best of each share of a language first, so that no task ranks a whole language
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(F.desc("score"), F.desc("a"))
    best = weakest.withColumn("place", F.rank().over(share)).where(f"place <= {int(top)}").drop("place")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).where(f"rank <= {int(top)}")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""SentencePiece BPE with byte fallback: encode whole texts to ids, decode ids to text.

Merges run in vectorised rounds. All words that a batch adds are one flat numpy
array of symbols with segment starts. A round finds each word's best-ranked
pair by a segmented minimum, merges its leftmost occurrences in all words at
once, compacts the array, and goes on until no word has a pair left.

Sequential BPE takes one best pair at a time, leftmost first. Merging several
occurrences of a pair at once gives the same as long as no merge makes a
neighbouring pair that ranks as well or better; words where one does take only
their leftmost pair in that round.

Texts: null counts as empty and gives no ids. A word is a run of blanks with
what follows up to the next blank; no piece of the vocabulary crosses such a
border (checked when the model is read). Repeated words are merged once per
task; that cache holds
at most twice ``cache_words`` and one batch.

Work is per row, without any shuffle; an executor that is lost costs its tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANK = "▁"
_WORD = re.compile(f"{BLANK}+[^{BLANK}]*")
_CODE_POINTS = 0x110000
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_NO_RANK = np.int32(2**31 - 1)
_UNKNOWN_SURFACE = " ⁇ ".encode()


class PieceModel:
    """Vocabulary, merge table and decoding table of one model file."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2 as messages

        proto = messages.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        norm, train = proto.normalizer_spec, proto.trainer_spec
        if train.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models without normalisation are supported")
        if not (norm.add_dummy_prefix and norm.escape_whitespaces and train.byte_fallback):
            raise ValueError("only models with a blank prefix, escaped blanks and byte fallback are supported")
        pieces = [(p.piece, p.score, p.type) for p in proto.pieces]
        if any(kind not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE) for _, _, kind in pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        normal = {text: i for i, (text, _, kind) in enumerate(pieces) if kind == _NORMAL}
        if any(re.search(f"[^{BLANK}]{BLANK}", text) for text in normal):
            raise ValueError("a piece crosses a word border")
        self.size = len(pieces)
        byte_ids = [i for i, p in enumerate(pieces) if p[2] == _BYTE]
        self.byte_ids = np.array(byte_ids, dtype=np.int32)
        if [pieces[i][0] for i in byte_ids] != [f"<0x{b:02X}>" for b in range(256)]:
            raise ValueError("byte pieces are not in order")
        self._chars = np.full(_CODE_POINTS, -1, dtype=np.int32)
        for text, i in normal.items():
            if len(text) == 1:
                self._chars[ord(text)] = i
        self._merges(normal, pieces)
        self._decoding(pieces)

    def _symbol(self, text: str, normal: dict[str, int]) -> int | None:
        """Id of a piece; a character outside the vocabulary gets an id above it."""
        if text in normal:
            return normal[text]
        return self.size + ord(text) if len(text) == 1 else None

    def _merges(self, normal: dict[str, int], pieces: list[tuple]) -> None:
        scores = sorted({pieces[i][1] for i in normal.values()}, reverse=True)
        rank_of = {score: rank for rank, score in enumerate(scores)}
        keys, ranks, made = [], [], []
        for text, i in normal.items():
            for cut in range(1, len(text)):
                left, right = self._symbol(text[:cut], normal), self._symbol(text[cut:], normal)
                if left is not None and right is not None:
                    keys.append((left << 32) | right)
                    ranks.append(rank_of[pieces[i][1]])
                    made.append(i)
        self._table(np.array(keys, dtype=np.int64), np.array(ranks, dtype=np.int32), np.array(made, dtype=np.int64))

    def _table(self, keys: np.ndarray, ranks: np.ndarray, made: np.ndarray) -> None:
        """A hash table of pairs with linear probing, at most a quarter full."""
        bits = max(10, int(len(keys) * 4).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._ranks = np.full(1 << bits, _NO_RANK, dtype=np.int32)
        self._made = np.zeros(1 << bits, dtype=np.int64)
        at, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self._keys[at[left]] == -1]
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self._keys[slots], self._ranks[slots], self._made[slots] = keys[put], ranks[put], made[put]
            left = left[self._keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def _decoding(self, pieces: list[tuple]) -> None:
        self._surface = [
            _UNKNOWN_SURFACE if kind == _UNKNOWN
            else b"" if kind == _CONTROL
            else bytes([int(text[3:5], 16)]) if kind == _BYTE
            else text.replace(BLANK, " ").encode()
            for text, _, kind in pieces
        ]
        self._surface_array = np.array(self._surface, dtype=object)
        self._is_byte = np.zeros(self.size, dtype=bool)
        self._is_byte[self.byte_ids] = True
        self._is_control = np.array([kind == _CONTROL for _, _, kind in pieces])

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair and the piece it makes; _NO_RANK where it makes none."""
        key = (left << 32) | right
        at = self._slot(key)
        held = self._keys[at]
        off = np.flatnonzero((held != key) & (held != -1))
        while len(off):
            at[off] = (at[off] + 1) & self._mask
            held = self._keys[at[off]]
            off = off[(held != key[off]) & (held != -1)]
        return self._ranks[at], self._made[at]

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as the bytes of 32-bit integers; words are not empty."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        known = self._chars[points]
        symbols = np.where(known >= 0, known, self.size + points)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        word = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_word = [], []
        while len(symbols):
            # rank of the pair that starts at each symbol; a word's last symbol starts none
            rank = np.full(len(symbols), _NO_RANK, dtype=np.int32)
            made = np.zeros(len(symbols), dtype=np.int64)
            inner = np.flatnonzero(word[1:] == word[:-1])
            rank[inner], made[inner] = self._ranked(symbols[inner], symbols[inner + 1])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(symbols)])
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            open_ = best != _NO_RANK
            if not open_.all():  # finished words leave the array
                done_symbols.append(symbols[~open_])
                done_word.append(word[~open_])
                symbols, word, rank, made, best = (x[open_] for x in (symbols, word, rank, made, best))
                if not len(symbols):
                    break
            symbols, word = self._merge_once(symbols, word, rank, made, best)
        flat = np.concatenate(done_symbols) if done_symbols else symbols
        owner = np.concatenate(done_word) if done_word else word
        order = np.argsort(owner, kind="stable")
        flat, owner = self._fallback(flat[order], owner[order])
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        raw = flat.tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    def _merge_once(self, symbols, word, rank, made, best) -> tuple[np.ndarray, np.ndarray]:
        hit = np.flatnonzero(rank == best)
        # of overlapping occurrences (as in "aaa") every second one counts, from the left
        runs = np.r_[True, (np.diff(hit) != 1) | (word[hit[1:]] != word[hit[:-1]])]
        place = np.arange(len(hit)) - np.flatnonzero(runs)[np.cumsum(runs) - 1]
        hit = hit[place % 2 == 0]
        merged, owner, fresh, kept_at = self._apply(symbols, word, made, hit)
        # a word where a merge made a pair that ranks as well or better takes one merge only; when a
        # pair merges, what is left of it has merged and what is right of it has not
        after = np.flatnonzero(fresh[1:] & (owner[1:] == owner[:-1])) + 1
        ranks, _ = self._ranked(merged[after - 1], merged[after])
        early = owner[after[ranks <= best[kept_at[after]]]]
        before = hit[hit + 2 < len(symbols)]
        before = before[word[before] == word[before + 2]]
        ranks, _ = self._ranked(made[before], symbols[before + 2])
        early = np.union1d(early, word[before[ranks <= best[before]]])
        if len(early):
            first = np.r_[True, word[hit[1:]] != word[hit[:-1]]]
            hit = hit[first | ~np.isin(word[hit], early)]
            merged, owner, _, _ = self._apply(symbols, word, made, hit)
        return merged, owner

    @staticmethod
    def _apply(symbols, word, made, hit):
        merged, keep = symbols.copy(), np.ones(len(symbols), dtype=bool)
        merged[hit] = made[hit]
        keep[hit + 1] = False
        fresh = np.zeros(len(symbols), dtype=bool)
        fresh[hit] = True
        kept_at = np.flatnonzero(keep)
        return merged[kept_at], word[kept_at], fresh[kept_at], kept_at

    def _fallback(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters outside the vocabulary become the pieces of their UTF-8 bytes."""
        outside = np.flatnonzero(symbols >= self.size)
        if not len(outside):
            return symbols.astype(np.int32), owner
        encoded = [chr(c).encode() for c in (symbols[outside] - self.size).tolist()]
        width = np.ones(len(symbols), dtype=np.int64)
        width[outside] = [len(b) for b in encoded]
        out = np.repeat(symbols, width)
        at = np.repeat(np.isin(np.arange(len(symbols)), outside), width)
        out[at] = self.byte_ids[np.frombuffer(b"".join(encoded), dtype=np.uint8)]
        return out.astype(np.int32), np.repeat(owner, width)

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(np.asarray(ids, dtype=np.int64), [0, len(ids)])[0]

    def decode_many(self, ids: np.ndarray, offsets: list[int]) -> list[str]:
        """Texts of lists of ids laid end to end, with U+FFFD for each byte that is not part of UTF-8."""
        surfaces = self._surface_array[ids].tolist()
        any_control, out = bool(self._is_control[ids].any()), []
        for a, b in zip(offsets, offsets[1:], strict=False):
            try:
                if any_control and self._is_control[ids[a:b]].any():  # these part runs of bytes
                    text = self._with_bytes(ids[a:b])
                else:
                    text = b"".join(surfaces[a:b]).decode()
            except UnicodeDecodeError:
                text = self._with_bytes(ids[a:b])
            if text.startswith(" "):  # the blank that encoding put in front of the text
                first = a
                while self._is_control[ids[first]]:
                    first += 1
                if not self._is_byte[ids[first]] and surfaces[first] != _UNKNOWN_SURFACE:
                    text = text[1:]
            out.append(text)
        return out

    def _with_bytes(self, ids: np.ndarray) -> str:
        kind = self._is_byte[ids]
        cuts = np.flatnonzero(np.diff(kind)) + 1
        out = []
        for part in np.split(ids, cuts):
            raw = b"".join(map(self._surface.__getitem__, part.tolist()))
            out.append(_lenient(raw) if self._is_byte[part[0]] else raw.decode())
        return "".join(out)


def _lenient(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at : at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


class _Encoder:
    """Encodes texts with a bounded cache of merged words."""

    def __init__(self, model: PieceModel, cache_words: int) -> None:
        self.model, self.cache_words, self.cache, self.older = model, cache_words, {}, {}

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as the bytes of 32-bit integers."""
        split = [self._words(t) if t else [] for t in texts]
        words = set().union(*split)
        new = words - self.cache.keys()
        if len(self.cache) + len(new) > self.cache_words:  # words not used since the last time are forgotten
            self.cache, self.older, new = {}, self.cache, words
        again = new & self.older.keys()
        self.cache.update((w, self.older[w]) for w in again)
        fresh = list(new - again)
        self.cache.update(zip(fresh, self.model.merge_words(fresh), strict=True))
        known = self.cache.__getitem__
        return [b"".join(map(known, words)) for words in split]

    @staticmethod
    def _words(text: str) -> list[str]:
        text = BLANK + text.replace(" ", BLANK)
        if text.find(BLANK + BLANK) < 0:
            return [BLANK + w for w in text[1:].split(BLANK)] if text[-1] != BLANK else _WORD.findall(text)
        return _WORD.findall(text)


@lru_cache(maxsize=2)
def _loaded(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=2)
def _encoder(path: str, cache_words: int) -> _Encoder:
    """Kept for later tasks of the same Python worker."""
    return _Encoder(_loaded(path), cache_words)


def encode(docs: DataFrame, model_path: str, text: str = "text", ids: str = "ids", cache_words: int = 200_000) -> DataFrame:
    """``docs`` with the array column ``ids``; an equally named column is replaced.

    ``model_path`` is read where tasks run, so it has to be installed on every machine.
    """

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path, cache_words)
        for batch in frames:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = encoder.ids(part.column(part.num_columns - 1).to_pylist())
                offsets = np.r_[0, np.cumsum([len(x) // 4 for x in found])].astype(np.int32)
                values = np.frombuffer(b"".join(found), dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                rest = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*rest, lists], names=[*names, ids])

    names = [c for c in docs.columns if c != ids]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(ids, T.ArrayType(T.IntegerType()))])
    rows = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(batches, schema)


def _decoded(model: PieceModel, lists: pa.ListArray) -> pa.Array:
    ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return pa.array(model.decode_many(values, [0, *ends.tolist()]), pa.string())


def decode(rows: DataFrame, model_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``rows`` with the string column ``text`` made from the ids; null ids give an empty text."""

    def texts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _loaded(model_path)
        for batch in batches:
            parts = [batch.slice(at, 256) for at in range(0, len(batch), 256)]
            yield pa.concat_arrays([_decoded(model, part) for part in parts] or [pa.array([], pa.string())])

    made = F.arrow_udf(texts, "string")
    names = [F.col(f"`{c}`") for c in rows.columns if c != text]
    return rows.select(*names, made(F.col(f"`{ids}`")).alias(text))

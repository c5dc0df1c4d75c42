"""Quality of documents from their lines, by a linear-chain conditional random field.

Every line with a word is good or bad. The field sees features of the line, of
the line before and of the line after, and how states follow each other.
Forward-backward gives each line's probability of being bad; weighted by the
lines' lengths they make a document's share of bad text, which a logistic curve
turns into a score.

Labels are given for documents only. Lines of good documents are good; of bad
documents those lines are bad which a logistic regression on the line's own
features calls bad, and the worst one if it calls none so.

Training takes about ``sample_docs`` labelled documents, chosen by a hash and never twice as many. Scoring is per row: whole texts, without a shuffle; chains of several documents are walked
together, so that a step is one numpy operation.

Defined results: null and empty texts and texts without a word score
``empty_score``. Rows may repeat. Without labels of both kinds all scores are
``empty_score``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimgauge.llm.text_columns import bounded_sample



@dataclass(frozen=True)
class CrfPlan:
    sample_docs: int = 3000
    steps: int = 200
    rate: float = 0.1
    ridge: float = 1e-3
    empty_score: float = 0.05
    step_docs: int = 64


_BYTES = np.arange(256)
_SPACE = np.isin(_BYTES, [32, *range(9, 14)])
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#*$%&|<>"])
_MARK = (_BYTES >= 33) & (_BYTES < 127) & ~(_UPPER | _LOWER | _DIGIT | _SYMBOL)
_PIPE = _BYTES == ord("|")
_CLASSES = (_UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _PIPE)
_RANDOM = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
N_OWN = 16


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each stretch of bytes, wherever it stands."""
    total = np.r_[np.uint64(0), np.cumsum(_RANDOM[flat] * _powers(len(flat), _BASE), dtype=np.uint64)]
    back = _powers(len(flat) + 1, pow(_BASE, -1, 2**64))
    return (total[ends] - total[starts]) * back[starts]


def own_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line with a word, its length in bytes, and the number of its text; texts are not null."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    flat = np.frombuffer(b"\n".join([*raw, b""]), dtype=np.uint8)
    empty = np.zeros((0, N_OWN), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(flat):
        return empty
    ends = np.flatnonzero(flat == 10)
    starts = np.r_[0, ends[:-1] + 1]
    doc_ends = np.cumsum([len(r) + 1 for r in raw])
    doc = np.searchsorted(doc_ends, starts, side="right")
    solid = ~_SPACE[flat]
    begins = np.flatnonzero(solid & ~np.r_[False, solid[:-1]])
    stops = np.flatnonzero(solid & ~np.r_[solid[1:], False]) + 1
    line = np.searchsorted(ends, begins)
    words = np.bincount(line, minlength=len(ends))
    keep = np.flatnonzero(words > 0)
    if not len(keep):
        return empty
    size = (ends - starts).astype(np.float64)
    upper, lower, digit, symbol, mark, pipe = (np.add.reduceat(c[flat], starts, dtype=np.int64) for c in _CLASSES)
    hashes = _hashes(flat, begins, stops)
    again = np.r_[False, (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])]
    order = np.lexsort((hashes, line))
    same = np.r_[False, (hashes[order][1:] == hashes[order][:-1]) & (line[order][1:] == line[order][:-1])]
    n = np.maximum(words, 1)
    repeated = np.bincount(line, weights=again, minlength=len(ends)) / n
    twice = np.bincount(line[order], weights=same, minlength=len(ends)) / n
    whole = _hashes(flat, starts, ends)
    by_text = np.lexsort((starts, whole, doc))
    dup = np.zeros(len(ends))
    dup[by_text[1:]] = (whole[by_text][1:] == whole[by_text][:-1]) & (doc[by_text][1:] == doc[by_text][:-1])
    solid_size = np.maximum(np.add.reduceat(solid, starts, dtype=np.int64), 1)
    shout = upper / np.maximum(upper + lower, 1)
    out = np.stack([
        np.ones(len(ends)), np.log1p(words) / 5, shout, digit / solid_size, symbol / solid_size, mark / solid_size, repeated, twice, dup,
        solid_size / n / 10, pipe > 0, words == 1, shout > 0.6, symbol / solid_size > 0.04, twice > 0.4, digit / solid_size > 0.3,
    ], axis=1).astype(np.float32)
    return out[keep], size[keep].astype(np.int64), doc[keep]


def with_neighbours(own: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Own features with those of the lines before and after in the same text; zeros where there is none."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = doc[1:] == doc[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    return np.concatenate([own, before, after], axis=1)


@dataclass
class LineField:
    plan: CrfPlan
    emit: np.ndarray = field(default_factory=lambda: np.zeros(3 * N_OWN))
    #: log weights of (good, bad) following (good, bad)
    follow: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    curve: tuple[float, float] = (0.0, 0.0)
    trained: bool = False

    def marginals(self, emission: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Probability that each line is bad, expected pairs of states, and the log of the sum over all paths.

        ``emission`` is the log weight of bad against good; lines stand in order of their texts.
        """
        _, first, size = np.unique(doc, return_index=True, return_counts=True)
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        score = np.stack([np.zeros(len(emission)), emission], axis=1)
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")  # texts with more than t lines
        for t in range(longest):
            at = first[: active[t]] + t
            if t:
                ahead[at] = np.logaddexp.reduce(ahead[at - 1][:, :, None] + self.follow[None], axis=1)
            ahead[at] += score[at]
        for t in range(longest - 2, -1, -1):
            at = first[: active[t + 1]] + t
            back[at] = np.logaddexp.reduce(self.follow[None] + (score[at + 1] + back[at + 1])[:, None, :], axis=2)
        total = np.zeros(len(emission))
        last = first + size - 1
        sums = np.logaddexp(ahead[last, 0], ahead[last, 1])
        total[last] = sums
        total = np.repeat(sums[np.argsort(order, kind="stable")], np.diff(np.r_[np.sort(first), len(emission)]))
        bad = np.exp(ahead[:, 1] + back[:, 1] - total)
        linked = np.flatnonzero(doc[1:] == doc[:-1])
        pair = ahead[linked][:, :, None] + self.follow[None] + (score[linked + 1] + back[linked + 1])[:, None, :]
        pairs = np.exp(pair - total[linked][:, None, None]).sum(0) if len(linked) else np.zeros((2, 2))
        return np.clip(bad, 0, 1), pairs, float(sums.sum())

    def fit(self, x: np.ndarray, doc: np.ndarray, bad: np.ndarray) -> None:
        """Maximum likelihood with a ridge, by Adam over the whole sample."""
        weights = np.concatenate([self.emit, self.follow.ravel()])
        m, v = np.zeros_like(weights), np.zeros_like(weights)
        linked = np.flatnonzero(doc[1:] == doc[:-1])
        seen = np.zeros((2, 2))
        np.add.at(seen, (bad[linked], bad[linked + 1]), 1)
        for step in range(1, self.plan.steps + 1):
            p, pairs, _ = self.marginals(x @ self.emit, doc)
            g = np.concatenate([x.T @ (p - bad), (pairs - seen).ravel()]) / len(x) + self.plan.ridge * weights
            m, v = 0.9 * m + 0.1 * g, 0.98 * v + 0.02 * g * g
            weights = weights - self.plan.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + 1e-9)
            self.emit, self.follow = weights[:-4], weights[-4:].reshape(2, 2)

    def bad_share(self, texts: list[str]) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities; nan without a line that has a word."""
        own, size, doc = own_features(texts)
        out = np.full(len(texts), np.nan)
        if len(own):
            p, _, _ = self.marginals(with_neighbours(own, doc) @ self.emit, doc)
            whole = np.bincount(doc, weights=size, minlength=len(texts))
            share = np.bincount(doc, weights=p * size, minlength=len(texts)) / np.maximum(whole, 1)
            out[whole > 0] = share[whole > 0]
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not self.trained:
            return np.full(len(texts), self.plan.empty_score)
        share = self.bad_share([t or "" for t in texts])
        return np.where(np.isnan(share), self.plan.empty_score, _sigmoid(self.curve[0] + self.curve[1] * _stretch(share)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _stretch(share: np.ndarray) -> np.ndarray:
    p = np.clip(np.nan_to_num(share, nan=0.5), 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, g), -2, 2)
    return w


def fit_field(texts: list[str], good: list[int], plan: CrfPlan = CrfPlan()) -> LineField:
    """Trains on texts with 1 for good and 0 for bad."""
    model, quality = LineField(plan), np.array(good, dtype=np.int64)
    own, size, doc = own_features(texts) if texts else (np.zeros((0, N_OWN)), None, np.zeros(0, np.int64))
    if not len(own) or len(set(quality[doc].tolist())) < 2:
        return model
    own = own.astype(np.float64)
    inherited = 1 - quality[doc]
    balance = np.where(inherited == 1, 0.5 / inherited.sum(), 0.5 / (1 - inherited).sum()) * len(own)
    p = _sigmoid(own @ _logistic(own, inherited, balance))
    worst = np.zeros(len(texts))
    np.maximum.at(worst, doc, p)
    bad = (inherited == 1) & ((p >= 0.5) | (p >= worst[doc]))
    model.fit(with_neighbours(own, doc), doc, bad.astype(np.int64))
    model.trained = True
    share = model.bad_share(texts)
    known = ~np.isnan(share)
    x = np.stack([np.ones(known.sum()), _stretch(share[known])], axis=1)
    model.curve = tuple(_logistic(x, quality[known], np.ones(known.sum())).tolist())
    return model


def train(docs: DataFrame, labels: DataFrame, plan: CrfPlan = CrfPlan(), text: str = "text", label: str = "quality", key: str = "doc_id") -> LineField:
    """Fits a field on the sample; texts of the sampled ids alone reach the driver."""
    known = labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("good")).where("key is not null and good in (0, 1)")
    known = known.groupBy("key").agg(F.min("good").alias("good"))  # of contradicting labels the worse one
    sample = bounded_sample(known, plan.sample_docs, "key")
    picked = docs.sparkSession.createDataFrame([(r.key, int(r.good)) for r in sample], "key long, good int")
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"))
    # at most twice sample_docs ids
    rows = texts.join(F.broadcast(picked), "key").where("body is not null").groupBy("key").agg(F.min(F.struct("body", "good")).alias("one"))
    found = sorted((r.key, r.one.body, r.one.good) for r in rows.collect())
    return fit_field([r[1] for r in found], [r[2] for r in found], plan)


def score(docs: DataFrame, model: LineField, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with score and predicted, from nothing but the text."""
    rows = docs.select(*keep, F.col(f"`{text}`").alias("__text_to_read"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("score", T.DoubleType())])
    names, packed = [f.name for f in schema.fields], pickle.dumps(model)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(packed)
        for frame in frames:
            for at in range(0, frame.num_rows, own.plan.step_docs):
                part = frame.slice(at, own.plan.step_docs)
                found = own.scores(part.column(part.num_columns - 1).to_pylist())
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], names=names)

    scored = rows.mapInArrow(batches, schema)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))



"""Language of texts by a byte convolutional network.

Every text is cut into windows of ``window`` bytes, the last one padded with
zero bytes. A window's bytes are embedded, filters of several widths run over
them, their activations are max-pooled over the window, and a softmax layer
gives the languages. A text's probabilities are the mean of its windows', by
the letters' share of bytes in each window. The network is trained in numpy, on
windows from all over the sampled texts.

For inference a filter is a sum of lookups: the embedding times the weights at
one offset is a table of 256 rows, and two neighbouring offsets are a table of
65,536 rows, so that a filter of width 4 takes two lookups per byte.

Training reads about ``sample_docs`` labelled texts, chosen by a hash and never twice as many, and at most ``windows_per_doc`` windows of each, spread
evenly over the whole text; that bound is all that reaches the driver. Prediction reads whole
texts, row by row, without a shuffle; memory per step is bounded by ``step_windows``.

Defined results: a text that is null or has no letter is ``und`` with score 1.
Labels that are null are not learned from; without any label all texts are ``und``.
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

UNDETERMINED = "und"


@dataclass(frozen=True)
class NetPlan:
    window: int = 192
    widths: tuple[int, ...] = (2, 4)
    filters: int = 16
    embedding: int = 8
    sample_docs: int = 1500
    windows_per_doc: int = 6
    epochs: int = 14
    batch: int = 128
    rate: float = 0.004
    seed: int = 11
    step_windows: int = 256


@dataclass
class ByteNet:
    plan: NetPlan
    classes: list[str]
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def start(self) -> None:
        rng, p = np.random.default_rng(self.plan.seed), self.plan
        self.weights["emb"] = rng.normal(0, 1, (256, p.embedding)).astype(np.float32)
        self.weights["emb"][0] = 0
        for w in p.widths:
            self.weights[f"conv{w}"] = rng.normal(0, (w * p.embedding) ** -0.5, (w, p.embedding, p.filters)).astype(np.float32)
            self.weights[f"bias{w}"] = np.zeros(p.filters, np.float32)
        wide = p.filters * len(p.widths)
        self.weights["out"] = rng.normal(0, wide**-0.5, (wide, len(self.classes))).astype(np.float32)
        self.weights["out_bias"] = np.zeros(len(self.classes), np.float32)

    def _forward(self, x: np.ndarray):
        """Logits of windows (n, window) and what the gradient needs."""
        pooled, at = [], []
        for w in self.plan.widths:
            tables = np.einsum("be,wef->wbf", self.weights["emb"], self.weights[f"conv{w}"])
            places = x.shape[1] - w + 1
            act = sum(tables[k][x[:, k : k + places]] for k in range(w))
            best = act.argmax(1)
            at.append(best)
            pooled.append(np.take_along_axis(act, best[:, None, :], 1)[:, 0] + self.weights[f"bias{w}"])
        pooled = np.concatenate(pooled, 1)
        hidden = np.maximum(pooled, 0)
        return hidden @ self.weights["out"] + self.weights["out_bias"], hidden, at

    def _gradient(self, x: np.ndarray, y: np.ndarray, share: np.ndarray) -> dict[str, np.ndarray]:
        logits, hidden, at = self._forward(x)
        p = _softmax(logits)
        p[np.arange(len(y)), y] -= 1
        p *= (share / share.sum())[:, None]
        grad = {"out": hidden.T @ p, "out_bias": p.sum(0), "emb": np.zeros_like(self.weights["emb"])}
        back = (p @ self.weights["out"].T) * (hidden > 0)
        n = self.plan.filters
        for i, w in enumerate(self.plan.widths):
            g, best, conv = back[:, i * n : (i + 1) * n], at[i], self.weights[f"conv{w}"]
            grad[f"bias{w}"] = g.sum(0)
            grad[f"conv{w}"] = np.zeros_like(conv)
            for k in range(w):
                seen = x[np.arange(len(x))[:, None], best + k]  # (n, filters)
                embedded = self.weights["emb"][seen]
                grad[f"conv{w}"][k] = np.einsum("nfe,nf->ef", embedded, g)
                np.add.at(grad["emb"], seen, g[:, :, None] * conv[k].T[None])
        return grad

    def fit(self, x: np.ndarray, y: np.ndarray) -> None:
        """Adam over shuffled batches; classes count alike however many windows they have."""
        self.start()
        rng, p = np.random.default_rng(self.plan.seed + 1), self.plan
        share = (1 / np.maximum(np.bincount(y, minlength=len(self.classes)), 1))[y].astype(np.float32)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(p.epochs):
            rate = p.rate * (1 - epoch / p.epochs)
            order = rng.permutation(len(x))
            for a in range(0, len(order), p.batch):
                step += 1
                take = order[a : a + p.batch]
                for k, g in self._gradient(x[take], y[take], share[take]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    fix = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                    self.weights[k] -= (rate * fix).astype(np.float32)
            self.weights["emb"][0] = 0

    def tables(self) -> list[tuple[int, list[np.ndarray]]]:
        """Per width: lookup tables of two neighbouring offsets each, and one of a single byte for odd widths."""
        out = []
        for w in self.plan.widths:
            one = np.einsum("be,wef->wbf", self.weights["emb"], self.weights[f"conv{w}"]).astype(np.float32)
            pairs = [(one[k][:, None, :] + one[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, w - 1, 2)]
            out.append((w, pairs + ([one[w - 1]] if w % 2 else [])))
        return out

    def probabilities(self, x: np.ndarray, tables: list[tuple[int, list[np.ndarray]]]) -> np.ndarray:
        two = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        pooled = []
        for w, parts in tables:
            places = x.shape[1] - w + 1
            act = None
            for k, part in enumerate(parts):
                seen = two if len(part) > 256 else x
                rows = part.take(seen[:, 2 * k : 2 * k + places], axis=0)
                act = rows if act is None else np.add(act, rows, out=act)
            pooled.append(act.max(1) + self.weights[f"bias{w}"])
        hidden = np.maximum(np.concatenate(pooled, 1), 0)
        return _softmax(hidden @ self.weights["out"] + self.weights["out_bias"])


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


#: bytes that are part of a letter in UTF-8 as far as bytes tell; whether a text has any letter is asked of its characters
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(0xC3, 0xF5)]] = True


def windows_of(texts: list[str], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of all texts below each other, and the number of each text's; a text has one at least."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([len(r) for r in raw], dtype=np.int64)
    count = np.maximum(1, -(-sizes // window))
    flat = np.zeros(int(count.sum()) * window, dtype=np.uint8)
    at = 0
    for r, n in zip(raw, count.tolist(), strict=True):
        flat[at : at + len(r)] = np.frombuffer(r, dtype=np.uint8)
        at += n * window
    return flat.reshape(-1, window), count


def _has_letter(text: str) -> bool:
    return any(map(str.isalpha, text[:200])) or any(map(str.isalpha, text))


def train(labelled: DataFrame, plan: NetPlan = NetPlan(), text: str = "text", lang: str = "lang", key: str = "doc_id") -> ByteNet:
    """Fits a network on a bounded sample of rows with a label and a text."""
    rows = labelled.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("body"), F.col(f"`{lang}`").alias("lang"))
    rows = rows.where("lang is not null and body is not null and body <> ''")
    cuts = F.transform(
        F.sequence(F.lit(0), F.lit(plan.windows_per_doc - 1)),
        lambda i: F.substring(F.col("body"), F.floor(i * F.greatest(F.length("body") - plan.window, F.lit(0)) / max(1, plan.windows_per_doc - 1)).cast("int") + 1, F.lit(plan.window)),
    )
    rows = rows.withColumn("hash", F.xxhash64("key", "body")).select("hash", "lang", F.array_distinct(cuts).alias("cuts"))
    sample = bounded_sample(rows, plan.sample_docs, "hash")
    classes = sorted({r.lang for r in sample})
    net = ByteNet(plan, classes)
    texts, y = [], []
    for r in sorted(sample, key=lambda r: (r.hash, r.lang)):
        for i, cut in enumerate(r.cuts):
            # every fifth window is learned in capitals as well
            for form in (cut, cut.upper()) if i % 5 == 0 else (cut,):
                if _has_letter(form):
                    texts.append(form.encode()[: plan.window].decode(errors="ignore"))
                    y.append(classes.index(r.lang))
    if texts:
        net.fit(windows_of(texts, plan.window)[0].astype(np.int64), np.array(y))
    else:
        net.classes = []
    return net


def _predict(net: ByteNet, tables, texts: list[str | None]) -> tuple[list[str], list[float]]:
    lang, score = [UNDETERMINED] * len(texts), [1.0] * len(texts)
    known = [i for i, t in enumerate(texts) if net.classes and t and _has_letter(t)]
    if not known:
        return lang, score
    x, count = windows_of([texts[i] for i in known], net.plan.window)
    parts, step = [], net.plan.step_windows
    for a in range(0, len(x), step):
        part = x[a : a + step]
        parts.append(net.probabilities(part, tables) * (_LETTER[part].sum(1, keepdims=True) + 1e-6))
    total = np.add.reduceat(np.concatenate(parts), np.r_[0, np.cumsum(count)[:-1]])
    total /= total.sum(1, keepdims=True)
    best = total.argmax(1)
    for k, i in enumerate(known):
        lang[i], score[i] = net.classes[best[k]], float(min(1.0, total[k, best[k]]))
    return lang, score


def predict(docs: DataFrame, net: ByteNet, text: str = "text", keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with lang_pred and score, from nothing but the text."""
    rows = docs.select(*keep, F.col(f"`{text}`").alias("__text_to_read"))
    fields = rows.schema.fields[:-1]
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    names = [f.name for f in schema.fields]
    packed = pickle.dumps(net)

    def batches(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pickle.loads(packed)
        tables = own.tables() if own.classes else []
        for frame in frames:
            for at in range(0, frame.num_rows, 128):
                part = frame.slice(at, 128)
                lang, score = _predict(own, tables, part.column(part.num_columns - 1).to_pylist())
                kept = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names)

    return rows.mapInArrow(batches, schema)

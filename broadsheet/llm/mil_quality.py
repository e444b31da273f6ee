"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded as shares of word and byte
classes; a gated attention, softmax(w . (tanh(V h) * sigmoid(U h))), learned from
document labels alone, weighs the passages, and the weighted passage representation
is scored. So one damaged passage can decide about a long document, and the weights
say which one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import whole_text
from .labelled import remainder, sample

#: Labelled documents of each kind that the model is fitted on, at most.
TRAIN_PER_CLASS = 1_500
PASSAGE_WORDS = 48
HASHED = 32
HIDDEN, GATE = 24, 12
EPOCHS, STEP, DECAY = 150, 0.02, 1e-4

_CLASSES = (
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",;:", "!", "?",
    "|", "#", "$", "%", "&", "*", "@_~^`\\", "+-=<>/", "()[]{}", "\"'",
)
_CLASS_OF = np.full(256, len(_CLASSES))
for _k, _chars in enumerate(_CLASSES):
    _CLASS_OF[list(_chars.encode())] = _k
_CLASS_OF[128:] = len(_CLASSES) + 1
_N_CLASSES = len(_CLASSES) + 2
FEATURES = _N_CLASSES + 12 + HASHED


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_LETTER, _UPPER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_LETTER[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_LETTER[128:] = True
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_DIGIT[list(b"0123456789")] = True
#: Odd multiplier of the word hash, and its inverse modulo 2**64.
_ODD = 0x9E3779B97F4A7C15
_BACK = pow(_ODD, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, base, np.uint64)]) if n else np.empty(0, np.uint64)


def _word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word's bytes, the same wherever the word stands."""
    with np.errstate(over="ignore"):
        sums = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(_ODD, len(raw)), dtype=np.uint64)]
        h = (sums[ends] - sums[starts]) * _powers(_BACK, len(raw))[starts]
        h ^= h >> np.uint64(29)
        return h * np.uint64(0xBF58476D1CE4E5B9)


def encode_passages(text: str) -> np.ndarray:
    """One row of features per passage of PASSAGE_WORDS words; a text without words is one passage of zeros."""
    raw = np.frombuffer(text.encode(), np.uint8)
    edge = np.diff(np.r_[True, _SPACE[raw], True].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n_words = len(starts)
    n = max(1, -(-n_words // PASSAGE_WORDS))
    rows = np.zeros((n, FEATURES))
    if not n_words:
        return rows
    first = np.arange(0, n_words, PASSAGE_WORDS)
    of = np.arange(n_words) // PASSAGE_WORDS
    size = np.bincount(of, minlength=n)
    cuts = starts[first]
    place = np.searchsorted(cuts, np.arange(cuts[0], ends[-1]), "right") - 1
    classes = np.bincount(place * _N_CLASSES + _CLASS_OF[raw[cuts[0]:ends[-1]]], minlength=n * _N_CLASSES).reshape(n, -1)
    rows[:, :_N_CLASSES] = classes / classes.sum(1, keepdims=True)
    h = _word_hashes(raw, starts, ends)
    lengths = np.minimum(ends - starts, 100)

    def share(mark: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=mark, minlength=n) / size

    def plain(kind: np.ndarray) -> np.ndarray:
        seen = np.r_[0, np.cumsum(kind[raw])]
        return seen[ends] - seen[starts] == ends - starts

    order = np.lexsort((h, of))
    new = np.r_[True, (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])]
    mean = share(lengths)
    rows[:, _N_CLASSES:_N_CLASSES + 12] = np.stack([
        size / PASSAGE_WORDS, np.bincount(of[order], weights=new, minlength=n) / size, np.minimum(mean, 40) / 10,
        np.minimum(np.sqrt(np.maximum(share(lengths**2) - mean**2, 0)), 40) / 10,
        np.maximum.reduceat(lengths, first) / 20, share(lengths <= 2), share(lengths >= 12),
        share(np.r_[False, (h[1:] == h[:-1]) & (of[1:] == of[:-1])]),
        share(~(_LETTER | _DIGIT)[raw[ends - 1]]), share(_UPPER[raw[starts]]), share(~plain(_LETTER)), share(plain(_DIGIT)),
    ], axis=1)
    bag = np.bincount(of * HASHED + (h >> np.uint64(59)).astype(int), minlength=n * HASHED).reshape(n, -1)
    rows[:, _N_CLASSES + 12:] = bag / size[:, None]
    return rows


@dataclass(frozen=True)
class Model:
    """Standardisation, encoder, gated attention and classifier."""

    mean: np.ndarray
    spread: np.ndarray
    params: dict[str, np.ndarray]

    def score(self, passages: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _forward(self.params, (passages - self.mean) / self.spread, starts)["p"]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    """``starts`` are the first passages of the documents; passages of a document lie together."""
    counts = np.diff(np.append(starts, len(x)))
    h = np.tanh(x @ w["encode"] + w["encode_0"])
    t, g = np.tanh(h @ w["v"]), _sigmoid(h @ w["u"])
    e = (t * g) @ w["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    a = e / np.repeat(np.add.reduceat(e, starts), counts)
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "attention": a, "z": z, "p": _sigmoid(z @ w["out"] + w["out_0"]), "counts": counts}


def _slopes(w: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(w, x, starts)
    h, t, g, a, z, counts = (f[k] for k in ("h", "t", "g", "attention", "z", "counts"))
    d = (f["p"] - y) * weight / weight.sum()
    dz = np.repeat(d, counts)[:, None] * w["out"]
    of_a = (dz * h).sum(1)
    de = a * (of_a - np.repeat(np.add.reduceat(a * of_a, starts), counts))
    dt, dg = de[:, None] * w["a"] * g * (1 - t * t), de[:, None] * w["a"] * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ w["v"].T + dg @ w["u"].T) * (1 - h * h)
    return {
        "encode": x.T @ dh, "encode_0": dh.sum(0), "v": h.T @ dt, "u": h.T @ dg, "a": (t * g).T @ de,
        "out": z.T @ d, "out_0": d.sum(),
    }


def train(bags: list[np.ndarray], labels: np.ndarray) -> Model:
    """Full-batch Adam from a fixed start; both labels weigh the same."""
    starts = np.cumsum([0, *map(len, bags[:-1])])
    x = np.concatenate(bags)
    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / spread
    rng = np.random.default_rng(5)
    shapes = {"encode": (FEATURES, HIDDEN), "v": (HIDDEN, GATE), "u": (HIDDEN, GATE), "a": (GATE,), "out": (HIDDEN,)}
    w = {k: rng.normal(0, shape[0] ** -0.5, shape) for k, shape in shapes.items()}
    w |= {"encode_0": np.zeros(HIDDEN), "out_0": np.zeros(())}
    weight = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    for epoch in range(1, EPOCHS + 1):
        for k, slope in _slopes(w, x, starts, labels, weight).items():
            slope = slope + DECAY * w[k]
            first[k] = 0.9 * first[k] + 0.1 * slope
            second[k] = 0.999 * second[k] + 0.001 * slope * slope
            w[k] = w[k] - STEP * (first[k] / (1 - 0.9**epoch)) / (np.sqrt(second[k] / (1 - 0.999**epoch)) + 1e-8)
    return Model(mean, spread, w)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from a bounded sample of the labelled documents; None without examples of both kinds."""
    rows = sample(docs, labels, "quality", 4, 2, TRAIN_PER_CLASS)
    if rows["label"].nunique() < 2:
        return None
    return train([encode_passages(t) for t in rows["text"]], rows["label"].to_numpy(float))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Documents -> (doc_id, score, n_passages, attention): the last is the largest weight of a passage."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    if model is None:
        return ids.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_passages"), F.lit(0.0).alias("attention"))

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in part["text"]:
                x = (encode_passages(text) - model.mean) / model.spread
                out = _forward(model.params, x, np.zeros(1, int))
                rows.append((float(out["p"][0]), len(x), float(out["attention"].max())))
            scores, passages, attention = zip(*rows) if rows else ((), (), ())
            yield pd.DataFrame({"doc_id": part["doc_id"], "score": scores, "n_passages": passages, "attention": attention})

    return ids.mapInPandas(batches, "doc_id long, score double, n_passages long, attention double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document.

    Fitted on the labels whose ids are not held out (crc32 remainder 2 of 4); labels
    without a document, null labels and repeated rows do no harm. Without examples
    of both kinds every score is 0. A null or empty text is scored as one passage
    without words. A score needs nothing but the text.
    """
    return score(docs, fit(docs, labels)).select(
        "doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )

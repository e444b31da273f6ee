"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic and one on ordinary text: both
hold the strings that are common in all text, the toxic one adds strings that mark
toxic documents, and the ordinary one, by the same rule, those that mark ordinary
documents; the shorter one is filled up to the same length. A window
of text that the toxic dictionary packs into fewer bytes than the ordinary one
speaks like toxic text. Windows are single words, since a saving of a few bytes is
lost in longer ones; every window is followed by a string that both dictionaries
hold, so that zstandard never falls back to storing it plain, and savings can be
compared. A document's savings are counted above thresholds that are calibrated on
the labelled sample, and logistic weights turn the counts into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import whole_text
from .labelled import remainder, sample

#: Labelled documents of each kind that the model is fitted on, at most.
TRAIN_PER_CLASS = 3_000
#: Strings in the dictionaries: those common in all text, and those that mark one kind.
COMMON, MARKS = 800, 1_200
#: Standard deviations by which a marking string must be more usual in documents of its kind.
SIGNIFICANT = 5.0
LEVEL = 9
WINDOW_BYTES = 64
#: Windows whose saving a Python worker remembers.
REMEMBERED = 300_000
ANCHOR = bytes((37 * k) % 128 + 128 for k in range(64))
TAIL = ANCHOR + bytes(range(1, 9))
#: Thresholds of a model: savings, in bytes, from which a window counts.
THRESHOLDS = 6


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    thresholds: tuple[int, ...]
    mean: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]


def windows(text: str) -> list[bytes]:
    """Lower-cased words with a space on both sides; very long words are cut, none is left out."""
    out = []
    for word in text.lower().split():
        raw = word.encode()
        out += [b" " + raw[k:k + WINDOW_BYTES] + b" " for k in range(0, len(raw), WINDOW_BYTES)]
    return out


def _strings(text: str) -> set[bytes]:
    found = set()
    for window in set(windows(text)):
        found.add(window)
        found.update(window[:k] for k in range(6, min(10, len(window) - 1)))
    return found


def train_dictionaries(texts: list[str], toxic: list[int]) -> tuple[bytes, bytes]:
    seen = (Counter(), Counter())
    docs = (toxic.count(0), toxic.count(1))
    for text, label in zip(texts, toxic):
        seen[label].update(_strings(text))

    def lean(s: bytes) -> float:
        return deviations(seen[1][s], seen[0][s], docs[1], docs[0])

    def marks(label: int) -> bytes:
        sign = 1 if label else -1
        found = sorted((-sign * lean(s), s) for s, n in seen[label].items() if n >= 3)
        return b"".join(reversed([s for z, s in found if -z > SIGNIFICANT][:MARKS]))

    common = [s for n, s in sorted((-n, s) for s, n in seen[0].items() if n >= 3) if abs(lean(s)) < 1.5][:COMMON]
    shared = b"".join(reversed(common))
    added = (marks(0), marks(1))
    length = max(map(len, added))
    ordinary, toxic_bytes = (shared + bytes(length - len(own)) + own + ANCHOR for own in added)
    return toxic_bytes, ordinary


def deviations(a: int, b: int, of_a: int, of_b: int) -> float:
    """Standard deviations by which a share of a in of_a is above one of b in of_b."""
    p = (a + b) / (of_a + of_b)
    return (a / of_a - b / of_b) / math.sqrt(max(p * (1 - p), 1e-12) * (1 / of_a + 1 / of_b))


def calibrate(saved: list[np.ndarray], toxic: list[int]) -> tuple[int, ...]:
    """The savings from which having a window tells toxic sample documents best from ordinary ones, ascending."""
    most, y = np.array([max(0, int(x.max())) if len(x) else 0 for x in saved]), np.array(toxic)
    told = [(-deviations(int((most[y == 1] >= t).sum()), int((most[y == 0] >= t).sum()), int((y == 1).sum()), int((y == 0).sum())), t)
            for t in range(1, max(1, int(most.max())) + 1)]
    best = sorted(t for _, t in sorted(told)[:THRESHOLDS])
    return tuple(best + best[-1:] * (THRESHOLDS - len(best)))


class Savings:
    """Bytes that the toxic dictionary saves on each window, against the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.packers = [self._packer(d) for d in (ordinary, toxic)]
        self.known: dict[bytes, int] = {}

    @staticmethod
    def _packer(content: bytes) -> zstandard.ZstdCompressor:
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False
        )

    def of(self, text: str) -> np.ndarray:
        known, parts = self.known, windows(text)
        new = list({w for w in parts if w not in known})
        if new:
            if len(known) + len(new) > REMEMBERED:
                known.clear()
                new = list(set(parts))
            lengths = []
            for packer in self.packers:
                packed = packer.multi_compress_to_buffer([w + TAIL for w in new])
                lengths.append([len(packed[k]) for k in range(len(new))])
            known.update(zip(new, (a - b for a, b in zip(*lengths))))
        return np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))


def features(saved: np.ndarray, thresholds: tuple[int, ...]) -> list[float]:
    if not len(saved):
        saved = np.zeros(1, np.int64)
    over = [(saved >= t).sum() for t in thresholds]
    shares = [n / len(saved) for n in over]
    return [float(saved.max()), float(saved.mean()), saved[saved > 0].sum() / len(saved), *shares,
            *(math.sqrt(s) for s in shares[3:]), *(math.log1p(n) for n in (over[1], *over[3:])), math.sqrt(len(saved)) / 10]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Newton steps on standardised columns; returns mean, spread and weights, the last one the constant."""
    mean, spread = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + ridge * len(y) * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + (ridge * len(y) + 1e-6) * np.eye(len(w))
        w -= np.linalg.solve(bend, slope)
    return mean, spread, w


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from a bounded sample of the labelled documents; None without examples of both kinds."""
    rows = sample(docs, labels, "toxic", 5, 0, TRAIN_PER_CLASS)
    if rows["label"].nunique() < 2:
        return None
    texts, toxic = rows["text"].tolist(), rows["label"].tolist()
    toxic_bytes, ordinary = train_dictionaries(texts, toxic)
    savings = Savings(toxic_bytes, ordinary)
    saved = [savings.of(t) for t in texts]
    thresholds = calibrate(saved, toxic)
    x = np.array([features(s, thresholds) for s in saved])
    y = np.array(toxic, float)
    mean, spread, weights = fit_logistic(x, y)
    return Model(toxic_bytes, ordinary, thresholds, *(tuple(map(float, v)) for v in (mean, spread, weights)))


@lru_cache(maxsize=2)
def _savings(toxic: bytes, ordinary: bytes) -> Savings:
    return Savings(toxic, ordinary)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Documents -> (doc_id, score). A null or empty text has no window, and so the score of no saving."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    if model is None:
        return ids.select("doc_id", F.lit(0.0).alias("score"))

    return ids.select("doc_id", judge(model)("text").alias("score"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per document.

    Fitted on the labels whose ids are not held out (crc32 remainder 0 of 5); labels
    without a document, null labels and repeated rows do no harm. Without examples
    of both kinds every score is 0. A score needs nothing but the text.
    """
    return score(docs, fit(docs, labels)).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns."""
    model = fit(docs, labels)
    if model is None:
        return docs
    return docs.where(judge(model)(whole_text()) < 0.5)


def judge(model: Model):
    """The score of a text as a column function over Arrow batches."""
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        savings = _savings(model.toxic, model.ordinary)
        mean, spread, weights = (np.array(v) for v in (model.mean, model.spread, model.weights))
        for part in texts:
            x = np.array([features(savings.of(text), model.thresholds) for text in part]).reshape(len(part), len(mean))
            z = np.c_[(x - mean) / spread, np.ones(len(x))] @ weights
            yield pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        # The worker stays for later stages, which have no use for the windows.
        savings.known.clear()

    return F.pandas_udf(scores, "double")

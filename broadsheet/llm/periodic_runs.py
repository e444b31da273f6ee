"""Periodic runs of words by internal pattern matching.

A run of period q, four times as long as that, holds a block that begins at a multiple
of C / 2 and is C words long, C being the power of two above q (4 at least), and that
block comes again just q words later, inside the run. As q is the run's smallest
period, the block does not come any sooner: two overlapping occurrences are the first
terms of a progression whose difference is q. So for every length C the blocks at
multiples of C / 2 ask for their next occurrence in the neighbouring window, and
distances below C are the candidate periods, one per block.

Equal blocks are ranges of the suffix array; the next occurrence is the least value
above the block's own place in such a range, which a wavelet tree over the array
answers in one step per bit. A candidate is then extended word by word in both
directions, which leaves maximal runs only.

Documents are read in batches. A word counts as another word in each document, so
nothing matches across documents, and copies of documents cost no more than others.
All steps of a batch are array operations.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bind import bind
from .common import SPACED_WORD, by_bytes, whole_text, words

#: Least number of words in a run, and how often it holds its period.
LEAST, TIMES = 6, 4
#: Bytes of text that share one suffix array; a longer text has its own.
BATCH_BYTES = 1 << 20
WORD = re.compile(SPACED_WORD)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class WaveletTree:
    """Least value above a bound within a range of an array that holds 0..n-1 once each."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = int(len(values)).bit_length()
        self.zeros = []  # per bit: number of zeros before each place
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            self.zeros.append(np.r_[0, np.cumsum(~ones)].astype(np.int32))
            values = np.r_[values[~ones], values[ones]]

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range are below the bound."""
        count = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[low], zeros[high]
            right = (bound >> bit & 1).astype(bool)
            count += np.where(right, b - a, 0)
            low, high = np.where(right, zeros[-1] + low - a, a), np.where(right, zeros[-1] + high - b, b)
        return count

    def ranked(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of the given rank (from 0) in each range."""
        value = np.zeros(len(low), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[low], zeros[high]
            right = rank >= b - a
            value |= right.astype(np.int64) << bit
            rank = np.where(right, rank - (b - a), rank)
            low, high = np.where(right, zeros[-1] + low - a, a), np.where(right, zeros[-1] + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
        """Least value above ``above`` in each range, -1 where there is none."""
        rank = self.below(low, high, above + 1)
        found = rank < high - low
        out = np.full(len(low), -1, np.int64)
        out[found] = self.ranked(low[found], high[found], rank[found])
        return out


def repeated_blocks(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple]]:
    """Suffix array by doubling, as far as suffixes are alike, and the blocks that occur more than once.

    Returns the array's places that matter, in order, as text positions, and per
    block length C the blocks at multiples of C / 2: (C, positions, range starts, range ends).
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64), []
    order = np.argsort(symbols)
    ranked = symbols[order]
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    starts = np.flatnonzero(new)
    group = np.empty(n + 1, np.int64)
    group[order] = np.repeat(starts, np.diff(np.r_[starts, n]))
    group[n] = -1
    kept, blocks, size = np.empty(0, np.int64), [], 1
    while True:
        at = np.flatnonzero(~(new & np.r_[new[1:], True]))  # places whose suffix is like another so far
        if not len(at):
            return order[kept], blocks
        if size == 4:
            kept = at
        if size >= 4:
            heads = np.flatnonzero(new[at])
            ends = np.repeat(np.r_[heads[1:], len(at)], np.diff(np.r_[heads, len(at)]))
            low, high = np.searchsorted(kept, group[order[at]]), np.searchsorted(kept, at[ends - 1]) + 1
            aligned = order[at] % (size // 2) == 0
            blocks.append((size, order[at][aligned], low[aligned], high[aligned]))
        if 2 * size > max(longest // 2, 4):
            return order[kept], blocks
        suffixes = order[at]
        own, after = group[suffixes], group[np.minimum(suffixes + size, n)]
        by = np.argsort(own * (n + 2) + after + 1)
        suffixes, own, after = suffixes[by], own[by], after[by]
        order[at] = suffixes
        head = np.r_[True, (own[1:] != own[:-1]) | (after[1:] != after[:-1])]
        new[at] = head
        heads = np.flatnonzero(head)
        group[suffixes] = np.repeat(at[heads], np.diff(np.r_[heads, len(at)]))
        size *= 2


def candidates(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, period) of blocks whose next occurrence overlaps them at a distance of their length class."""
    array, blocks = repeated_blocks(symbols, longest)
    if not blocks:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    positions = np.sort(array)
    tree = WaveletTree(np.searchsorted(positions, array))
    at, periods = [], []
    for size, place, low, high in blocks:
        following = tree.successor(low, high, np.searchsorted(positions, place))
        distance = np.where(following >= 0, positions[following] - place, size)
        fits = (distance < size) & (distance >= (1 if size == 4 else size // 2))
        at.append(place[fits])
        periods.append(distance[fits])
    return np.concatenate(at), np.concatenate(periods)


def find_runs(symbols: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs, in order, for symbols of documents that share none.

    ``bounds`` are the documents' starts and the end of the last.
    """
    at, period = candidates(symbols, int(np.diff(bounds).max(initial=0)))
    doc = np.searchsorted(bounds, at, "right") - 1
    by = np.lexsort((at, period, doc))
    at, period, doc = at[by], period[by], doc[by]
    heads = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (period[1:] != period[:-1])]) if len(at) else at
    found = []
    for a, b in zip(heads, np.r_[heads[1:], len(at)]):
        d, q = int(doc[a]), int(period[a])
        text = symbols[bounds[d]:bounds[d + 1]]
        breaks = np.flatnonzero(text[q:] != text[:-q])
        nearest = np.searchsorted(breaks, np.unique(at[a:b] - bounds[d]))
        for k in np.unique(nearest).tolist():
            start = int(breaks[k - 1]) + 1 if k else 0
            length = (int(breaks[k]) if k < len(breaks) else len(text) - q) - start + q
            if length >= max(LEAST, TIMES * q):
                found.append((d, start, length, q))
    return sorted(found, key=lambda r: (r[0], r[1], r[3]))


def read_batch(texts: list[str]) -> tuple[list[list[dict]], list[str]]:
    """Runs and collapsed text of each text."""
    split = [WORD.findall(text) for text in texts]
    bounds = np.cumsum([0, *map(len, split)])
    codes: dict[str, int] = {}
    for word in chain.from_iterable(split):
        if word not in codes:
            codes[word] = len(codes)
    flat = np.fromiter(map(codes.__getitem__, chain.from_iterable(split)), np.int64, bounds[-1])
    own = flat + np.repeat(np.arange(len(split)), np.diff(bounds)) * max(len(codes), 1)
    runs: list[list[dict]] = [[] for _ in split]
    for d, start, length, q in find_runs(own, bounds):
        runs[d].append({"start": start, "length": length, "period": q})
    for d, of_doc in enumerate(runs):
        if of_doc:
            gone = np.zeros(len(split[d]) + 1, np.int64)
            for r in of_doc:
                gone[r["start"] + r["period"]] += 1
                gone[r["start"] + r["length"]] -= 1
            split[d] = [w for w, g in zip(split[d], np.cumsum(gone).tolist()) if not g]
    return runs, [" ".join(ws) for ws in split]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Documents -> (doc_id, runs, collapsed), one row per document.

    ``runs`` lists start, length and period of every run by start, then period;
    ``collapsed`` is the words that are left, joined by single spaces, when every run keeps
    its first period only. A null or empty text has neither. Rows are taken one by one, so
    repeated rows, null ids and other columns do not matter.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
        for part in by_bytes(parts, size=BATCH_BYTES):
            runs, collapsed = read_batch(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(runs, pa.list_(fields)), pa.array(collapsed, pa.string())], ["doc_id", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        batches, f"doc_id long, runs {RUNS}, collapsed string")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by the checksum of its id, repeats words from some place on.

    With h the checksum, g = h div 10 and n words, word i from a = g % n on becomes word
    a + (i - a) % p, p = 1 + (n - a) div (3 + g % 8). Documents without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(all_words: Column) -> Column:
        n = F.size(all_words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        copied = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(all_words, place(i).cast("int")))
        return F.when(n > 0, F.array_join(copied, " ")).otherwise("")

    text = whole_text()
    return docs.select("doc_id", F.when(h % 10 == 0, bind(words(text, SPACED_WORD), repeated)).otherwise(text).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """Runs of the documents with planted periods.

    (doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256), one row per document; the
    four after n_runs describe the longest run, of equals the one with the smallest start, then period, and are null without one.
    """
    found = periodic_runs(with_planted_periods(docs))
    ranked = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.array_max(ranked))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

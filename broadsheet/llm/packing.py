"""Token ids packed into fixed rows by best-fit decreasing.

Documents are dealt to shards by the hash of their id and text, and frequent equal
rows evenly over all shards, so no key binds its rows to one shard; each shard packs
its own. A document is its byte-level BPE ids and an end mark; what is longer than a row is
split into whole rows and a rest, so no id is lost. Pieces go, longest first, into
the fullest row that still has room, which a segment tree over the free capacities
finds. A packed row holds the id matrix row, the cumulative segment lengths, and
position ids that begin anew in every segment.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from .common import by_bytes, whole_text

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END, PAD = 50256, 50256
ROW_IDS = 2048
#: Text per shard, a row counting as so many bytes besides its text.
SHARD_BYTES = 1 << 24
ROW_BYTES = 64


class Tokenizer:
    """The rank file's own encoding."""

    def __init__(self, ranks: str) -> None:
        with open(ranks, "rb") as lines:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.library = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(array("H", self.library.encode_ordinary(text)), np.uint16)


@lru_cache(maxsize=2)
def tokenizer(ranks: str) -> Tokenizer:
    return Tokenizer(ranks)


class Rows:
    """Open rows by free capacity; a segment tree over capacities tells which are in use."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.used = bytearray(2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.capacity, self.count = capacity, 0

    def _mark(self, free: int, on: int) -> None:
        node = free + self.leaves
        self.used[node] = on
        while node > 1:
            node >>= 1
            self.used[node] = self.used[2 * node] | self.used[2 * node + 1]

    def _least(self, size: int) -> int | None:
        """Smallest capacity of at least ``size`` that an open row has."""
        node = size + self.leaves
        while not self.used[node]:
            while node & 1:  # a right child: go up until there is something on the right
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.used[2 * node] else 2 * node + 1
        return node - self.leaves

    def put(self, size: int) -> tuple[int, int]:
        """Row and offset for a piece."""
        free = self._least(size)
        if free is None:
            row, free = self.count, self.capacity
            self.count += 1
        else:
            row = self.open[free].pop()
            if not self.open[free]:
                self._mark(free, 0)
        left = free - size
        if left:
            if not self.open[left]:
                self._mark(left, 1)
            self.open[left].append(row)
        return row, self.capacity - free


def split(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, size) of each piece: as many whole rows as fit, then the rest."""
    pieces = -(-sizes // capacity)
    doc = np.repeat(np.arange(len(sizes)), pieces)
    start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
    return doc, start, np.minimum(sizes[doc] - start, capacity)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and offset of each piece, placed longest first, equal ones in order."""
    rows = Rows(capacity)
    row, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for k in np.argsort(-sizes, kind="stable").tolist():
        row[k], offset[k] = rows.put(int(sizes[k]))
    return row, offset


def tokens(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(doc_id, key, copies, ids) for (doc_id, key, copies, text): the ids and the end mark, as little-endian 16-bit numbers."""
    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = tokenizer(ranks), np.array([END], np.uint16)
        for part in by_bytes(parts):
            ids = [np.r_[own.encode(t), end].tobytes() for t in part.column("text").to_pylist()]
            kept = ["doc_id", "key", "copies"]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), pa.array(ids, pa.binary())], [*kept, "ids"])

    return docs.select("doc_id", "key", "copies", "text").mapInArrow(encode, "doc_id long, key long, copies long, ids binary")


def dealt(docs: DataFrame, ranks: str = RANKS) -> DataFrame:
    """(shard, doc_id, copies, ids): rows by the hash of id and text, frequent equal rows as copies over all shards, a task to a shard.

    Rows count as frequent from a quarter of a shard on, so their keys are few.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    by_key = rows.groupBy("key").agg(F.sum(F.octet_length("text") + ROW_BYTES).alias("n"))
    frequent = F.when(F.col("n") > SHARD_BYTES // 4, F.col("key"))
    whole = by_key.agg(F.sum("n").alias("n"), F.collect_list(frequent).alias("frequent")).first()
    shards = max(1, -(-(whole["n"] or 0) // SHARD_BYTES))

    def placed(encoded: DataFrame, turn) -> DataFrame:
        return encoded.withColumn("shard", F.pmod(F.pmod("key", F.lit(shards)) + turn, F.lit(shards)).cast("int")).select("shard", "doc_id", "copies", "ids")

    once = F.lit(1).cast("long").alias("copies")
    if not whole["frequent"] or shards == 1:
        return placed(tokens(rows.select("*", once), ranks), F.lit(0)).repartitionById(shards, "shard")
    hot = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in whole["frequent"]], "key long"))
    many = rows.join(hot, "key", "left_semi").groupBy("doc_id", "key", "text").agg(F.count("*").alias("copies"))
    turns = tokens(many, ranks).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.least("copies", F.lit(shards)) - 1)))
    share = F.floor(F.col("copies") / shards) + (F.col("turn") < F.col("copies") % shards).cast("long")
    few = placed(tokens(rows.join(hot, "key", "left_anti").select("*", once), ranks), F.lit(0))
    return few.unionByName(placed(turns.withColumn("copies", share), F.col("turn"))).repartitionById(shards, "shard")


PACKED = "shard int, row int, ids binary, cu_seqlens array<int>, position_ids binary, doc_ids array<long>, starts array<long>"


def pack(docs: DataFrame, capacity: int = ROW_IDS, ranks: str = RANKS) -> DataFrame:
    """Documents -> packed rows: (shard, row, ids, cu_seqlens, position_ids, doc_ids, starts).

    ``ids`` and ``position_ids`` are rows of the matrices, ``capacity`` little-endian
    16-bit numbers padded at the end; segment k lies between entries k and k + 1 of
    ``cu_seqlens`` and holds the ids of document ``doc_ids[k]`` from ``starts[k]``
    on. An empty or null text is one end mark. Documents without an id stay apart as
    segments; rows that repeat an id are packed each. Other columns are not read. The same input gives the same rows.
    """
    if capacity > 65536:
        raise ValueError("position ids are 16-bit numbers")

    def fill(group: pd.DataFrame) -> pd.DataFrame:
        group = group.loc[group.index.repeat(group["copies"])].sort_values(["doc_id", "ids"], na_position="last")
        ids = [np.frombuffer(raw, np.uint16) for raw in group["ids"]]
        names = [None if pd.isna(i) else int(i) for i in group["doc_id"]]
        doc, start, size = split(np.fromiter(map(len, ids), np.int64, len(ids)), capacity)
        row, offset = best_fit(size, capacity)
        by = np.lexsort((offset, row))
        heads = np.flatnonzero(np.r_[True, np.diff(row[by]) != 0])
        out = []
        for a, b in zip(heads, np.r_[heads[1:], len(by)]):
            at = by[a:b]
            line, places = np.full(capacity, PAD, np.uint16), np.zeros(capacity, np.uint16)
            for k in at:
                line[offset[k]:offset[k] + size[k]] = ids[doc[k]][start[k]:start[k] + size[k]]
                places[offset[k]:offset[k] + size[k]] = np.arange(size[k])
            out.append((int(group["shard"].iat[0]), int(row[at[0]]), line.tobytes(), np.r_[0, np.cumsum(size[at])].tolist(),
                        places.tobytes(), [names[d] for d in doc[at]], start[at].tolist()))
        return pd.DataFrame(out, columns=["shard", "row", "ids", "cu_seqlens", "position_ids", "doc_ids", "starts"])

    return dealt(docs, ranks).groupBy("shard").applyInPandas(fill, PACKED)


def write_packed(docs: DataFrame, folder: str, capacity: int = ROW_IDS) -> None:
    """Write the packed matrices as Parquet files, a row per sequence."""
    pack(docs, capacity).write.mode("overwrite").parquet(folder)


def packed_rows(docs: DataFrame) -> DataFrame:
    """(shard, row, n_tokens, n_segments, doc_ids, starts, cu_seqlens, ids_sha256, positions_sha256), one row per packed row."""
    return pack(docs).select(
        "shard", "row", F.element_at("cu_seqlens", -1).cast("long").alias("n_tokens"), F.size("doc_ids").cast("long").alias("n_segments"),
        "doc_ids", "starts", "cu_seqlens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("position_ids", 256).alias("positions_sha256"),
    )

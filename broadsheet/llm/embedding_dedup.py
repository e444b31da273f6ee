"""Near-duplicate vectors by Euclidean p-stable hashing with exact cosine checks.

Vectors are scaled to length one, so that a cosine is a Euclidean distance.
Gaussian projections, shifted and cut into steps of WIDTH, form a bucket name of
``k`` numbers in each of several tables; near vectors often share all of them. The
number of projections grows with the logarithm of the input, which keeps buckets
small, and the number of tables follows from the wanted recall at the threshold.
Vectors that share a bucket are compared in double precision.

Equal vectors are one vector with a count, however many there are. Buckets above
CHUNK rows are cut into chunks that meet two by two, so no bucket is bound to one
task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..operators.components import clusters
from ..session import materialise

#: Smallest cosine of a link.
COSINE = 0.95
#: Step of the quantised projections, in units of vector length.
WIDTH = 1.5
#: Probability that a pair at the threshold shares a bucket of some table.
RECALL = 0.98
CHUNK = 2048
SEED = 11


def _together(distance: float) -> float:
    """Probability that two vectors at this distance fall into the same step of one projection."""
    r = WIDTH / distance
    tail = 0.5 * math.erfc(r / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def plan(rows: int) -> tuple[int, int]:
    """(projections per table, tables): unrelated vectors, at right angles, meet about eight others per table."""
    far, near = _together(math.sqrt(2)), _together(math.sqrt(2 - 2 * COSINE))
    k = max(4, math.ceil(math.log(max(rows, 9) / 8) / -math.log(far)))
    return k, math.ceil(math.log(1 - RECALL) / math.log(1 - near**k))


@lru_cache(maxsize=4)
def _projections(dims: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((SEED, dims))
    return rng.normal(size=(dims, tables * k)), rng.uniform(0, WIDTH, tables * k)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def different_vectors(vectors: DataFrame) -> DataFrame:
    """(embedding, id, size): usable vectors, each once, with the smallest id and the number of its rows."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
        .where(F.exists("embedding", lambda x: x != 0))
        .groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    )


def buckets(different: DataFrame, k: int, tables: int) -> DataFrame:
    """(t, bucket, id): a row per vector and table."""
    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for dims, group in part.groupby(part["embedding"].map(len)):
                x = np.stack(group["embedding"].to_list()).astype(float)
                x /= _lengths(x / np.abs(x).max(1, keepdims=True))[:, None] * np.abs(x).max(1, keepdims=True)
                directions, shifts = _projections(int(dims), k, tables)
                steps = np.floor((x @ directions + shifts) / WIDTH).astype(np.int64).reshape(len(x), tables, k)
                with np.errstate(over="ignore"):
                    name = np.full((len(x), tables), int(dims), np.uint64)
                    for j in range(k):
                        name = (name ^ steps[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                        name ^= name >> np.uint64(29)
                yield pd.DataFrame({
                    "t": np.tile(np.arange(tables, dtype=np.int32), len(x)), "bucket": name.view(np.int64).ravel(),
                    "id": np.repeat(group["id"].to_numpy(), tables),
                })

    return different.select("id", "embedding").mapInPandas(hashed, "t int, bucket long, id long")


def _meetings(placed: DataFrame) -> DataFrame:
    """(t, bucket, x, y, first, id): rows of each pair of chunks that meets; ``first`` marks those of chunk x."""
    size = placed.groupBy("t", "bucket").agg(F.count("*").alias("rows")).where("rows > 1")
    shared = placed.join(size, ["t", "bucket"]).withColumn("chunks", F.ceil(F.col("rows") / CHUNK).cast("int"))
    own = F.pmod(F.xxhash64("id"), "chunks").cast("int")
    return shared.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "t", "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        (F.col("own") <= F.col("other")).alias("first"), "id",
    )


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / (_lengths(x)[:, None] * _lengths(y)[None, :]) >= COSINE


def links(different: DataFrame, k: int, tables: int) -> DataFrame:
    """Pairs (a, b) of different vectors found with a cosine of COSINE or more, each once."""
    met = _meetings(materialise(buckets(different, k, tables), "buckets")).join(different.select("id", "embedding"), "id")
    key = ["t", "bucket", "x", "y"]
    sorted_runs = met.repartition(*key).sortWithinPartitions(*key)

    def compare(run: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, group in run.groupby(run["embedding"].map(len)):
            ids, first = group["id"].to_numpy(), group["first"].to_numpy()
            v = np.stack(group["embedding"].to_list()).astype(float)
            v /= np.abs(v).max(1, keepdims=True)
            same = run["x"].iat[0] == run["y"].iat[0]
            left = np.arange(len(ids)) if same else np.flatnonzero(first)
            right = np.arange(len(ids)) if same else np.flatnonzero(~first)
            for start in range(0, len(left), 512):
                at = left[start:start + 512]
                i, j = np.nonzero(_near(v[at], v[right]))
                a, b = ids[at[i]], ids[right[j]]
                use = a < b if same else a != b
                yield np.minimum(a, b)[use], np.maximum(a, b)[use]

    def found(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for part in parts:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            starts = np.flatnonzero((part[key] != part[key].shift()).any(axis=1))
            yield pairs_of(part, starts[:-1], starts[1:])
            rest = part.iloc[starts[-1]:]
        if rest is not None:
            yield pairs_of(rest, [0], [len(rest)])

    def pairs_of(part: pd.DataFrame, starts, ends) -> pd.DataFrame:
        got = [p for a, b in zip(starts, ends) if b - a > 1 for p in compare(part.iloc[a:b])]
        a, b = (np.concatenate([p[side] for p in got]) if got else np.empty(0, np.int64) for side in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    return sorted_runs.select(*key, "first", "id", "embedding").mapInPandas(found, "a long, b long").distinct()


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """Vectors -> (vec_id, n_links, component_id, kept), one row per vector.

    Null vectors, zero vectors and those with a null or non-finite component are
    linked with nothing, as are rows without an id; vectors of different length are
    not compared. Equal vectors are all linked with each other and share their
    links. Other columns are not read.
    """
    different = materialise(different_vectors(vectors), "vectors")
    k, tables = plan(different.count())
    pairs = materialise(links(different, k, tables), "vector-links")
    comps = clusters(pairs.select(F.lit(0).alias("scope"), "a", "b")).select("id", F.col("cluster_id").alias("component"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(different.select(F.col("id").alias("b"), "size"), "b").groupBy(F.col("a").alias("id")).agg(F.sum("size").alias("others"))
    named = materialise(different.join(linked, "id", "left").join(comps, "id", "left").select(
        F.col("embedding").alias("vector"), (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component"),
    ), "vector-groups")
    member = F.col("vec_id").isNotNull() & (F.col("embedding") == F.col("vector"))
    return vectors.select("vec_id", "embedding").join(named, member, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"),
    )

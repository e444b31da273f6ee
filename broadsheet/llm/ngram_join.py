"""Self-join of documents on the Jaccard similarity of their word n-gram sets.

Sets are joined tile by tile. Each set puts its rarest shingles, as many as a
similar set could all lack at most, into tiles of (shingle, size band); similar sets
share a tile, as their sizes lie in the same band or in neighbouring ones. Before
two sets are compared, a bound from above is taken from hashed bitmaps, whose bits
tell whether an odd number of elements fell on them. Elements that both sets have
cancel out, so each bit in which they differ stands for a different element, however
full the bitmaps are, and the overlap is at most (n + m - differing bits) / 2. What
passes is intersected as sorted arrays, made for those sets only.

Rarity comes from document counts of all shingles in 2**BUCKET_BITS hash buckets, a
table of fixed size; any order finds all links, this one keeps tiles small. Equal sets are
one set from the start. In each tile all sets are first compared with one leader, so
crowds of copies are joined at one comparison each; from then on only pairs whose
sets are not connected yet are left. Small tiles compare these directly. The rows of
crowded tiles are cut into chunks, those of the tile's largest component and the
others apart; pairs of chunks are compared by bitmaps, and only sets that a bitmap
leaves are fetched, once for each pair of chunks. A crowd of texts that are all just
below the threshold still costs its pairs. The join gives the components of the
link graph, not all its links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.components import clusters
from ..operators.skew import without
from ..session import discard, intermediate, materialise
from .common import SPACED_WORD, lower_ascii, whole_text, words

BUCKET_BITS = 20
BITMAP_WORDS = 32
#: Bits of the bitmap of ids that keeps most other texts from being moved to their sets.
FILTER_BITS = 23
#: Tiles with more rows than this are compared in blocks.
CROWD = 128
#: Rows in a chunk of a crowded tile.
CHUNK = 2048
#: Bytes of set arrays in a chunk, unless a single set is larger.
CHUNK_BYTES = 1 << 24


@dataclass(frozen=True)
class Spec:
    """Shingles of ``width`` words; a link needs num * union <= den * intersection."""

    width: int = 4
    num: int = 85
    den: int = 100

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1


def word_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, w): the hashes of a document's words in order."""
    return docs.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.transform(words(lower_ascii(whole_text()), SPACED_WORD), lambda w: F.xxhash64(w)).alias("w"),
    )


def shingles(w: np.ndarray, width: int) -> np.ndarray:
    """Sorted different shingle hashes; with fewer words than ``width`` the whole sequence is one."""
    if not len(w):
        return np.empty(0, np.uint64)
    w = w.astype(np.uint64)
    k = min(width, len(w))
    with np.errstate(over="ignore"):
        h = np.full(len(w) - k + 1, 0x243F6A8885A308D3 + k, np.uint64)
        for j in range(k):
            h = (h ^ w[j:len(w) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
    return np.unique(h)


def _sets(part: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    lists = part.column("w")
    flat, cuts = np.asarray(lists.values), np.asarray(lists.offsets)
    for a, b in zip(cuts, cuts[1:]):
        yield shingles(flat[a:b].view(np.uint64), width)


def bucket_counts(hashed: DataFrame, width: int) -> np.ndarray:
    """Documents per hash bucket of their shingles: 2**BUCKET_BITS numbers, whatever the input."""
    rows, size = 64, 1 << BUCKET_BITS
    each = size // rows

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for part in parts:
            for s in _sets(part, width):
                np.add.at(total, (s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        # A byte each: what exceeds 255 follows in further rows, so that no count is cut.
        while total.any():
            low = np.minimum(total, 255)
            total -= low
            data = [part.tobytes() for part in low.astype(np.uint8).reshape(rows, each)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows, dtype=np.int32)), pa.array(data, pa.binary())], ["part", "counts"])
            if (total > 0).sum() < each:
                at = np.flatnonzero(total)
                pairs = np.stack([at, total[at]], axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([pairs.tobytes()], pa.binary())], ["part", "counts"])
                break

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for part in parts:
            for k, counts in zip(part["part"], part["counts"]):
                if k >= 0:
                    total[k] = total.get(k, 0) + np.frombuffer(counts, np.uint8).astype(np.int64)
                else:
                    for at, n in np.frombuffer(counts, np.int64).reshape(-1, 2):
                        k, j = divmod(int(at), each)
                        total.setdefault(k, np.zeros(each, np.int64))
                        total[k][j] += n
        yield pd.DataFrame({"part": list(total), "counts": [t.tobytes() for t in total.values()]})

    shape = "part int, counts binary"
    summed = hashed.mapInArrow(count, shape).repartition("part").mapInPandas(add, shape)
    out = np.zeros(size, np.int64)
    for row in summed.collect():  # a few hundred rows of 16,384 numbers
        out[row["part"] * each:(row["part"] + 1) * each] += np.frombuffer(row["counts"], np.int64)
    # Only the order matters: ranks of the different counts keep the table small.
    return np.minimum(np.unique(out, return_inverse=True)[1], 65_535).astype(np.uint16)


def features(hashed: DataFrame, counts: np.ndarray, spec: Spec) -> DataFrame:
    """(doc_id, n, key, rare, bits): set size, identity of the set, its rarest shingles, its bitmap."""
    def describe(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            n, keys, rare, bits = [], [], [], []
            for s in _sets(part, spec.width):
                n.append(len(s))
                keys.append(blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                p = spec.prefix(len(s)) if len(s) else 0
                seen = counts[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                rare.append(s[np.lexsort((s, seen))[:p]].view(np.int64))
                odd = np.bincount((s % np.uint64(64 * BITMAP_WORDS)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int32()), pa.array(keys, pa.binary()), pa.array(rare, longs), pa.array(bits, longs)],
                ["doc_id", "n", "key", "rare", "bits"],
            )

    return hashed.mapInArrow(describe, "doc_id long, n int, key binary, rare array<bigint>, bits array<bigint>")


def tiles(prefixes: DataFrame, spec: Spec) -> DataFrame:
    """(token, band, id, n, guest): rows of the tiles that hold more than one set.

    A set is at home in its own size band and a guest in the next larger one. A token's rows move once to find
    the tokens that sets share and once to stay with them; sizes travel along.
    """
    postings = prefixes.select(F.explode("rare").alias("token"), "id", "n")
    shared = postings.groupBy("token").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a <> b").select("token")
    found = materialise(postings.join(shared, "token"), "postings")
    band = F.floor(F.log(F.col("n")) / float(np.log(spec.den / spec.num))).cast("int")
    # A tile is live if a set is at home in it and another one, at home or a guest, is there too: read off the
    # smallest and largest id of every token and band.
    homes = found.groupBy("token", band.alias("own")).agg(F.min("id").alias("a"), F.max("id").alias("b"))
    places = F.array(F.struct(F.lit(0).alias("up"), F.lit(False).alias("guest")), F.struct(F.lit(1).alias("up"), F.lit(True).alias("guest")))
    live = homes.select("token", "own", "a", "b", F.explode(places).alias("at")).groupBy("token", (F.col("own") + F.col("at.up")).alias("band")).agg(
        F.min("a").alias("a"), F.max("b").alias("b"), F.min("at.guest").alias("g")).where("a <> b AND NOT g").select("token", "band")
    live = materialise(live, "live")
    rows = found.select("token", band.alias("own"), "id", "n", F.explode(places).alias("at")).select(
        "token", (F.col("own") + F.col("at.up")).alias("band"), "id", "n", "at.guest"
    )
    return rows.join(live, ["token", "band"])


def _live(rows: DataFrame, unit: str) -> DataFrame:
    """Rows of tiles that hold more than one ``unit``, not all of them guests."""
    live = rows.groupBy("token", "band").agg(F.min(unit).alias("a"), F.max(unit).alias("b"), F.min("guest").alias("g")).where("a <> b AND NOT g")
    return rows.join(live.select("token", "band"), ["token", "band"])


def _sized(pairs: DataFrame, spec: Spec) -> DataFrame:
    """Pairs (a, n_a, b, n_b) whose sizes allow a link, each once, the smaller id first."""
    fits = (spec.num * F.greatest("n_a", "n_b") <= spec.den * F.least("n_a", "n_b")) & (F.col("a") != F.col("b"))
    return pairs.where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def leader_pairs(rows: DataFrame, turn: int, spec: Spec) -> DataFrame:
    """Each row of a tile with one of the sets at home there."""
    dice = F.xxhash64("id", F.lit(turn))
    leader = rows.where("NOT guest").groupBy("token", "band").agg(F.min(F.struct(dice, "id", "n")).alias("lead"))
    led = rows.join(leader, ["token", "band"])
    return _sized(led.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("lead.id").alias("b"), F.col("lead.n").alias("n_b")), spec)


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, spec: Spec) -> DataFrame:
    """Pairs (a, b) that are links: bitmaps bound the overlap first, sorted arrays of the sets they leave decide."""
    small = sets.select("id", "n", "bits")
    known = pairs
    for side in "ab":
        known = known.join(small.select(F.col("id").alias(side), F.col("n").alias("n_" + side), F.col("bits").alias("bits_" + side)), side)
    differ = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    most = F.floor((F.col("n_a") + F.col("n_b") - differ) / 2)
    passed = materialise(known.where(spec.den * most >= spec.num * (F.col("n_a") + F.col("n_b") - most)).select("a", "b"), "bounded")
    if passed.isEmpty():
        return passed
    left = passed.select(F.col("a").alias("id")).unionByName(passed.select(F.col("b").alias("id"))).distinct()
    arrays = materialise(_arrays(docs, left, spec), "set-arrays")
    for side in "ab":
        passed = passed.join(arrays.select(F.col("id").alias(side), F.col("set").alias("set_" + side)), side)

    def exact(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hit = []
            for x, y in zip(part.column("set_a"), part.column("set_b")):
                hit.append(_linked(*(np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y)), spec))
            yield part.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return passed.select("a", "b", "set_a", "set_b").mapInArrow(exact, "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, spec: Spec) -> bool:
    """Exact intersection of two sorted arrays against the threshold."""
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return spec.den * both >= spec.num * (len(x) + len(y) - both)


def _meetings(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(token, band, x, y, chunk, ids, ns, comps, guests, bits): the chunks of crowded tiles that meet, one row each.

    Two sets of different components are not both in the tile's largest one, so
    chunks of the other rows meet each other and those of the largest component.
    Sets in a tile are of about one size, and a chunk holds so many that their
    arrays stay within CHUNK_BYTES.
    """
    tile = ["token", "band"]
    by_part = rows.groupBy(*tile, "comp").agg(F.count("*").alias("c"), F.max("n").alias("n"))
    main = by_part.groupBy(*tile).agg(
        F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("rows"),
        F.greatest(F.lit(1), F.least(F.lit(CHUNK), F.floor(F.lit(CHUNK_BYTES) / (8 * F.max("n"))))).alias("each"),
    ).select(
        *tile, F.col("main.comp").alias("main"), F.ceil(F.col("main.c") / F.col("each")).alias("of_main"),
        F.ceil((F.col("rows") - F.col("main.c")) / F.col("each")).alias("of_rest"),
    )
    dice = F.xxhash64("id")
    chunk = F.when(F.col("comp") == F.col("main"), F.col("of_rest") + F.pmod(dice, "of_main")).otherwise(F.pmod(dice, "of_rest")).cast("int")
    packed = materialise(rows.join(main, tile).withColumn("chunk", chunk).join(sets.select("id", "bits"), "id").groupBy(
        *tile, "of_rest", "of_main", "chunk"
    ).agg(
        F.collect_list("id").alias("ids"), F.collect_list("n").alias("ns"), F.collect_list("comp").alias("comps"),
        F.collect_list("guest").alias("guests"), F.flatten(F.collect_list("bits")).alias("bits"),
    ), "chunks")
    last = F.when(F.col("chunk") < F.col("of_rest"), F.col("of_rest") + F.col("of_main")).otherwise(F.col("of_rest")) - 1
    return packed.withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int")))).select(
        *tile, F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "ids", "ns", "comps", "guests", "bits"
    )


def _bounded(i: int, n: np.ndarray, guest: np.ndarray, bits: np.ndarray, at: np.ndarray, spec: Spec) -> np.ndarray:
    """Those of the rows ``at`` whose size and bitmap allow a link with row i."""
    at = at[~(guest[at] & guest[i]) & (spec.num * np.maximum(n[at], n[i]) <= spec.den * np.minimum(n[at], n[i]))]
    most = (n[at] + n[i] - np.bitwise_count(bits[at] ^ bits[i]).sum(1, dtype=np.int64)) // 2
    return at[spec.den * most >= spec.num * (n[at] + n[i] - most)]


def _crowd_links(rows: DataFrame, sets: DataFrame, docs: DataFrame, spec: Spec) -> DataFrame:
    """Links from crowded tiles, chunk against chunk: bitmaps first, then the sets that bitmaps leave.

    A group never holds more than two chunks. A row needs one link to each other
    component at most, so it is compared until it has one; components that a pair of
    chunks has joined count as one from then on.
    """
    key = ["token", "band", "x", "y"]

    def bound(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        ids, n, comp, guest, bits = (np.concatenate(group[c].to_list()) for c in ("ids", "ns", "comps", "guests", "bits"))
        n, guest, bits = n.astype(np.int64), guest.astype(bool), bits.view(np.uint64).reshape(-1, BITMAP_WORDS)
        first = len(group["ids"].iat[0])
        needed = np.zeros(len(ids), bool)
        for i in range(first):
            at = np.arange(first if len(group) > 1 else i + 1, len(ids))
            at = _bounded(i, n, guest, bits, at[comp[at] != comp[i]], spec)
            needed[at] = True
            needed[i] |= len(at) > 0
        at = np.flatnonzero(needed)
        out = {c: np.repeat(group[c].iat[0], len(at)) for c in key}
        return pd.DataFrame(out | {
            "id": ids[at], "n": n[at], "comp": comp[at], "guest": guest[at], "first": at < first,
            "bits": pd.Series([row.view(np.int64) for row in bits[at]], dtype=object),
        })

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["first", "id"], ascending=[False, True])
        ids, n, comp, guest, held = (group[c].to_numpy() for c in ("id", "n", "comp", "guest", "set"))
        comp, bits = comp.copy(), np.stack(group["bits"].to_list()).view(np.uint64)
        first = int(group["first"].sum())
        found: list[tuple[int, int]] = []
        for i in range(first):
            at = np.arange(first if group["x"].iat[0] < group["y"].iat[0] else i + 1, len(ids))
            at = _bounded(i, n, guest, bits, at[comp[at] != comp[i]], spec)
            own = np.frombuffer(held[i], np.uint64)
            for j in at:
                if comp[j] != comp[i] and _linked(own, np.frombuffer(held[j], np.uint64), spec):
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    comp[comp == comp[j]] = comp[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    shape = "token long, band int, x int, y int, id long, n long, comp long, guest boolean, first boolean, bits array<bigint>"
    needed = materialise(_meetings(rows, sets).groupBy(*key).applyInPandas(bound, shape), "chunk-rows")
    if needed.isEmpty():
        return needed.select(F.col("id").alias("a"), F.col("id").alias("b"))
    arrays = _arrays(docs, needed.select("id").distinct(), spec)
    return needed.join(arrays, "id").groupBy(*key).applyInPandas(compare, "a long, b long").distinct()


def _rest_links(rows: DataFrame, sets: DataFrame, docs: DataFrame, spec: Spec) -> DataFrame:
    """Links between different components that share a tile."""
    size = rows.groupBy("token", "band").agg(F.count("*").alias("rows"))
    known = materialise(rows.join(size, ["token", "band"]), "tile-rows")
    few = known.where(F.col("rows") <= CROWD)
    x, y = few.where("NOT guest").alias("x"), few.alias("y")
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")) & (F.col("x.comp") != F.col("y.comp"))
    near = spec.num * F.greatest("x.n", "y.n") <= spec.den * F.least("x.n", "y.n")
    direct = x.join(y, meet & near & (F.col("y.guest") | (F.col("x.id") < F.col("y.id"))))
    pairs = _sized(direct.select(F.col("x.id").alias("a"), F.col("x.n").alias("n_a"), F.col("y.id").alias("b"), F.col("y.n").alias("n_b")), spec)
    crowded = _crowd_links(known.where(F.col("rows") > CROWD).drop("rows"), sets, docs, spec)
    return verified(pairs, sets, docs, spec).unionByName(crowded)


def _grown(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """(id, comp) of all sets with links so far: new links only join components that are still apart."""
    edges = links.select("a", "b")
    if comps is not None:
        for side in "ab":
            named = comps.select(F.col("id").alias(side), F.col("comp").alias("c"))
            edges = edges.join(named, side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    edges = materialise(edges.where("a <> b").distinct(), "joining")
    if comps is not None and edges.isEmpty():
        return comps
    joined = clusters(edges.select(F.lit(0).alias("scope"), "a", "b")).select("id", F.col("cluster_id").alias("comp"))
    if comps is not None:
        joined = materialise(joined, "joined")
        moved = comps.join(joined.select(F.col("id").alias("comp"), F.col("comp").alias("to")), "comp", "left")
        joined = moved.select("id", F.coalesce("to", "comp").alias("comp")).unionByName(joined.join(comps, "id", "left_anti"))
    return materialise(joined, "components")


def _with_components(rows: DataFrame, comps: DataFrame) -> DataFrame:
    return rows.drop("comp").join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _arrays(docs: DataFrame, wanted: DataFrame, spec: Spec) -> DataFrame:
    """(id, set): sorted shingles of the wanted documents.

    A bitmap of hashed ids, of fixed size, is applied where the texts are read; the
    join decides.
    """
    def hashed(column: str):
        return F.pmod(F.xxhash64(column), F.lit(1 << FILTER_BITS))

    bit = F.lit(1 << 15)
    maps = wanted.select(hashed("id").alias("h")).groupBy(F.floor(F.col("h") / bit).alias("part")).agg(
        F.bitmap_construct_agg(F.col("h") % bit).alias("map")
    )
    h = hashed("doc_id")
    byte = F.conv(F.hex(F.substring("map", F.floor((F.col("h") % bit) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = docs.where("doc_id IS NOT NULL").withColumn("h", h).withColumn("part", F.floor(F.col("h") / bit)).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", "h", "part"
    ).join(F.broadcast(maps), "part").where(byte.bitwiseAND(F.expr("shiftleft(1, cast(h % 8 as int))")) != 0)
    kept = likely.join(wanted, F.col("doc_id") == wanted["id"], "left_semi").select("doc_id", "text")

    def store(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([s.tobytes() for s in _sets(part, spec.width)], pa.binary())], ["id", "set"]
            )

    return word_hashes(kept).mapInArrow(store, "id long, set binary").dropDuplicates(["id"])


def similar_sets(docs: DataFrame, spec: Spec = Spec()) -> tuple[DataFrame, DataFrame]:
    """Documents -> (features of all, (id, comp) of the sets with links); a set goes by the smallest id that has it."""
    spark = docs.sparkSession
    with intermediate(spark) as keep:
        hashed = word_hashes(docs)
        described = keep(materialise(features(hashed, bucket_counts(hashed, spec.width), spec), "shingle-sets"))
        whole = described.where("n > 0")
        firsts = whole.groupBy("key").agg(F.min("doc_id").alias("doc_id"))
        # Only the names of copies are moved; the rows of the other sets stay where they lie.
        copies = materialise(whole.select("key", "doc_id").distinct().join(firsts, ["key", "doc_id"], "left_anti"), "copies")
        own = without(whole, copies, ["key", "doc_id"]).withColumnRenamed("doc_id", "id")
        sets = materialise(own.select("id", "n", "bits").dropDuplicates(["id", "n"]), "sets")
        with intermediate(spark) as hold:
            rows = hold(materialise(tiles(own.select("id", "rare", "n"), spec), "tiles"))
        comps = None
        # What a step has read is deleted as soon as its results are written.
        for turn in range(2):
            with intermediate(spark) as hold:
                grown = hold(_grown(comps, verified(leader_pairs(rows, turn, spec), sets, docs, spec)))
                left = hold(materialise(_live(_with_components(rows, grown), "comp"), "tiles"))
            discard(rows)
            comps, rows = grown, left
        with intermediate(spark) as hold:
            comps = hold(_grown(comps, _rest_links(rows, sets, docs, spec)))
        keep(comps)
    return described, comps


def components(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """Documents -> (doc_id, n_shingles, component_id), one row per document.

    A text without words, empty or null, has an empty set and is linked with
    nothing. Rows without an id take part in no group: their component is null and
    their size 0. Rows that repeat an id and its text are one document; an id with
    several texts should not occur, each of its rows follows its own text or, for
    sets of one size, the first. Other columns are not read.
    """
    described, comps = similar_sets(docs, spec)
    firsts = described.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("id"))
    named = _with_components(firsts, comps).select("key", "comp")
    out = described.select("doc_id", "n", "key").join(named, "key", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id")
    )
    nameless = docs.where("doc_id IS NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")
    )
    return out.unionByName(nameless)


def keep_representatives(docs: DataFrame, spec: Spec = Spec()) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns; rows without an id stay."""
    drop = components(docs, spec).where("doc_id <> component_id").select(F.col("doc_id").alias("dropped")).distinct()
    return docs.join(drop, F.col("doc_id") == F.col("dropped"), "left_anti")


# For documents with different ids.
SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM split WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL)
  JOIN sizes na ON na.doc_id = a JOIN sizes nb ON nb.doc_id = b WHERE 100 * shared >= 85 * (na.n + nb.n - shared)
), reach AS (
  SELECT doc_id AS id, doc_id AS root FROM documents UNION
  SELECT e.v, r.root FROM reach r JOIN (SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links) e ON r.id = e.u AND r.root < e.v
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, root AS component_id FROM documents LEFT JOIN sizes USING (doc_id)
JOIN (SELECT id AS doc_id, min(root) AS root FROM reach GROUP BY id) USING (doc_id)
"""

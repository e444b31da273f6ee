"""Exact duplicates through an extendible-hash index on shared files.

A text's key is its 64-bit hash; the key's leading bits name a directory slot.
Buckets that hold too many keys are split on one more bit, which doubles the
directory, until all fit or the deepest level is reached. Entries then move to the owner
task of their bucket; owners hold ranges of buckets, so ranges of keys. An owner takes its
entries bucket by bucket: rows that share a bucket and key form a chain, and their texts
are compared byte for byte (grouping on the text itself), so that two texts with one
key stay two entries. Texts that many rows hold are put together before they move, so an
owner gets one row of each. A document is looked up through its slot, its
bucket and the chain there.

Everything is DataFrame operations. Intermediate tables are Parquet files in the
shared folder: the fingerprints (one narrow row per document) and the index
(one row per different text, in key order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise, metered
from .common import whole_text

#: A bucket is overfull when its different keys exceed the rows / SPLITS, so at most
#: SPLITS buckets of one depth are split, whatever the size of the input.
SPLITS = 1024
#: Deepest directory: 65,536 slots, which also bounds what is broadcast.
MAX_DEPTH = 16
#: Texts with more than this share of the rows are looked up by broadcast; there
#: are fewer than HEAVY of them.
HEAVY = 1000
#: Bytes of text that one owner task gets, on average.
OWNER_BYTES = 1 << 26


def slot(key: str, depth: int):
    return F.shiftrightunsigned(F.col(key), 64 - depth)


def directory(keys: DataFrame, capacity: float) -> DataFrame:
    """Different keys -> (slot, bucket, depth): one row per used slot of the full directory.

    All doublings are read off one count per slot of the deepest directory: a
    slot's bucket is its shortest prefix that is not overfull. ``bucket`` is the
    first slot of the bucket, so buckets are in key order.
    """
    cells = keys.groupBy(slot("key", MAX_DEPTH).alias("slot")).agg(F.count("*").alias("n"))
    depths = F.sequence(F.lit(0), F.lit(MAX_DEPTH))
    nodes = cells.select("slot", "n", F.explode(depths).alias("depth")).withColumn(
        "bucket", F.expr(f"(slot >> ({MAX_DEPTH} - depth)) << ({MAX_DEPTH} - depth)")
    )
    sizes = nodes.groupBy("depth", "bucket").agg(F.sum("n").alias("size"))
    fits = sizes.where((F.col("size") <= capacity) | (F.col("depth") == MAX_DEPTH))
    best = nodes.join(fits.select("depth", "bucket"), ["depth", "bucket"]).groupBy("slot").agg(
        F.min(F.struct("depth", "bucket")).alias("at")
    )
    return best.select("slot", F.col("at.bucket").alias("bucket"), F.col("at.depth").alias("depth"))


def fingerprints(docs: DataFrame) -> DataFrame:
    text = whole_text()
    return docs.select(
        "doc_id", F.xxhash64(text).alias("key"), F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).cast("long").alias("n_bytes"))


def build_index(docs: DataFrame, marks: DataFrame, slots: DataFrame, rows: int, n_bytes: int) -> DataFrame:
    """(owner, bucket, depth, key, chain, text_sha256, group_size, keep_id), one row per different text, on shared files."""
    owners = max(1, -(-n_bytes // OWNER_BYTES))
    owner = F.floor(F.col("bucket") * owners / (1 << MAX_DEPTH)).cast("int")
    keyed = docs.select("doc_id", whole_text().alias("text")).withColumn("key", F.xxhash64("text"))
    frequent = F.broadcast(marks.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > rows / HEAVY).select("key"))
    once = F.lit(1).cast("long").alias("n")
    met = keyed.join(frequent, "key", "left_semi").groupBy("key", "text").agg(F.max("doc_id").alias("doc_id"), F.count("*").alias("n"))
    moving = keyed.join(frequent, "key", "left_anti").select("key", "text", "doc_id", once).unionByName(met)
    place = ["owner", "bucket", "depth", "key"]
    owned = moving.withColumn("slot", slot("key", MAX_DEPTH)).join(F.broadcast(slots), "slot").withColumn("owner", owner).repartitionById(owners, "owner")
    entries = owned.groupBy(*place, "text").agg(F.sum("n").alias("group_size"), F.max("doc_id").alias("keep_id"))
    chains = entries.select(*place, F.sha2("text", 256).alias("text_sha256"), "group_size", "keep_id").groupBy(*place).agg(
        F.array_sort(F.collect_list(F.struct("text_sha256", "group_size", "keep_id"))).alias("chain"))
    index = chains.select(*place, F.posexplode("chain").alias("chain", "e")).select(*place, "chain", "e.*")
    return materialise(index.sortWithinPartitions("bucket", "key"), "index")


def exact_dedup(docs: DataFrame) -> DataFrame:
    """Documents -> (doc_id, keep_id, group_size, kept, text_sha256), one row per document.

    Equal texts form a group, of which the largest doc_id stays. A null text is
    the empty text, and all empty texts are one group. Null ids lose against any
    other id; in a group of null ids only, keep_id is null and the rows are kept.
    Rows that repeat both id and text are one document and share its verdict.
    Other columns, whatever their names, are not read. No rows give no rows.
    """
    marks, seen = metered(fingerprints(docs), "fingerprints", rows=F.count(F.lit(1)), n_bytes=F.sum("n_bytes"))
    rows = seen["rows"]
    slots = materialise(directory(marks.select("key").distinct(), max(1.0, rows / SPLITS)), "directory")
    index = build_index(docs, marks, slots, rows, seen["n_bytes"] or 0).select("bucket", "key", "text_sha256", "keep_id", "group_size")
    entry = ["bucket", "key", "text_sha256"]
    asked = marks.withColumn("slot", slot("key", MAX_DEPTH)).join(F.broadcast(slots), "slot").select("doc_id", *entry)
    heavy = index.where(F.col("group_size") > rows / HEAVY)
    rest = asked.join(F.broadcast(heavy.select(*entry)), entry, "left_anti")
    found = asked.join(F.broadcast(heavy), entry).unionByName(rest.join(index, entry))
    return found.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_distinct(docs: DataFrame) -> DataFrame:
    """Of equal texts one row, with all its columns: that of the largest doc_id.

    Rows that repeat both id and text, and copies of a text that no row has an id for, leave
    one row too, the one whose columns have the smallest hash; they meet in the map-side part of an aggregation.
    """
    keep = materialise(exact_dedup(docs).where("kept").groupBy(
        F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(F.count("*").alias("_n")), "kept")
    marked = docs.withColumn("_mark", F.sha2(whole_text(), 256))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_sha"))
    single = marked.join(keep.where("_n = 1"), same, "left_semi").select(docs.columns)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    repeated = marked.join(keep.where("_n > 1"), same, "left_semi").groupBy("doc_id", "_mark").agg(
        F.min_by(row, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])).alias("_row"))
    return single.unionByName(repeated.select("_row.*"))


SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

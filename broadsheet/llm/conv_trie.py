"""Prefix trie of conversations by van Emde Boas recursion.

Sequences of turns are cut at half of a power-of-two depth. A cut prefix is named
by the smallest conversation that has it. The trie above the cut is built from one
representative per name, weighted by the conversations behind it; the forest below
is built per name from what follows the cut. Both halves are cut again, all
segments of a level in one job, until a segment is a single turn: about log2 of the
longest conversation levels. A segment is compared by the name of its content, a
SHA-256 over the names of its own two halves, so no sequence is ever one row.

Totals travel upward the same way, from the largest cut to the smallest: what the
forests below a cut add up to is grafted on the node at the cut, which then counts
for the trie above it. Each node receives one such graft and is written once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import join_skewed, number_rows
from ..session import materialise

#: The head that is taken over has fewer turns than this, and every GROUP conversations share one.
HEADS, GROUP = 9, 5
#: Conversation ids joined into one string before they are hashed.
IDS_PER_STRING = 10_000


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % HEADS


def named_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, name, n_bytes): turns in order, without their texts.

    Null turns come first, equal ones go by role and then by the name. Null role or
    text is empty; rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("name"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), "role", "name"]
    return materialise(number_rows(turns, ["conv_id"], order, "pos").select("conv_id", "pos", "name", "n_bytes"), "turns")


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, sizes) of the conversations as rebuilt; ``sizes`` is (conv_id, n) and has the turnless ones too.

    Conversation c begins with the first ``head_length(c)`` turns of c - c % GROUP,
    as far as there are any, and goes on with its own turns after that many.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n_own"))
    heads = turns.where(F.col("pos") < HEADS - 1)
    n_head = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("n_base"))
    plan = (
        own.withColumn("head", head_length(F.col("conv_id"))).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP)
        .join(n_head, "base", "left").withColumn("taken", F.least("head", F.coalesce("n_base", F.lit(0))))
    )
    plan = materialise(plan.select("conv_id", "base", "head", "taken", "n_own"), "heads")
    taken = heads.withColumnRenamed("conv_id", "base").join(plan.select("base", "conv_id", "taken"), "base").where("pos < taken")
    rest = join_skewed(turns, plan.select("conv_id", "head", "taken"), ["conv_id"]).where("pos >= head")
    columns = ["conv_id", "pos", "name", "n_bytes"]
    moved = rest.withColumn("pos", F.col("pos") - F.col("head") + F.col("taken"))
    rebuilt = materialise(taken.select(columns).unionByName(moved.select(columns)), "rebuilt")
    sizes = plan.select("conv_id", (F.col("taken") + F.greatest(F.col("n_own") - F.col("head"), F.lit(0))).alias("n"))
    return rebuilt, sizes


def block_names(turns: DataFrame, levels: int) -> list[DataFrame]:
    """Per level j below ``levels``: (conv_id, seg, name) of the segments of 2^j turns that are full."""
    blocks = [turns.select("conv_id", F.col("pos").alias("seg"), "name")]
    for _ in range(1, levels):
        halves = blocks[-1].groupBy("conv_id", F.shiftright("seg", 1).alias("_seg")).agg(
            F.count("*").alias("_n"), F.min_by("name", "seg").alias("_left"), F.max_by("name", "seg").alias("_right"))
        joined = F.unhex(F.sha2(F.concat("_left", "_right"), 256)).alias("name")
        blocks.append(materialise(halves.where("_n = 2").select("conv_id", F.col("_seg").alias("seg"), joined), "blocks"))
    return blocks


def _cut(rows: DataFrame, halves: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Segments of 2^level turns cut in the middle: (segments of half the length, conversations that end at the cut)."""
    even = halves.where(F.col("seg") % 2 == 0).select("conv_id", F.shiftright("seg", 1).alias("seg"), "name")
    both = materialise(rows.join(even, ["conv_id", "seg"], "left"), "halves")
    full = both.where("name IS NOT NULL")
    cuts = full.groupBy("up", "seg", "name").agg(
        F.min("conv_id").alias("cut"), F.sum("weight").alias("_weight"), F.min_by("n", "conv_id").alias("_n"), F.first("cuts").alias("_cuts"))
    cuts = materialise(cuts, "cuts")
    at = F.shiftleft(F.col("seg") * 2 + 1, level - 1)  # turns before the cut
    named = join_skewed(full, cuts.select("up", "seg", "name", "cut"), ["up", "seg", "name"]).withColumn("_at", at)
    double = F.col("seg") * 2
    short = both.where("name IS NULL").select("up", "conv_id", double.alias("seg"), "weight", "n", "cuts", "open")
    above = cuts.select("up", F.col("cut").alias("conv_id"), double.alias("seg"), F.col("_weight").alias("weight"),
                        F.col("_n").alias("n"), F.col("_cuts").alias("cuts"), F.lit(False).alias("open"))
    below = named.where("n > _at").select(
        F.col("cut").alias("up"), "conv_id", (double + 1).alias("seg"), "weight", "n",
        F.concat("cuts", F.array("cut")).alias("cuts"), "open")
    ends = named.where("open AND n = _at").select(F.col("cut").alias("node"), F.col("_at").alias("depth"), F.col("conv_id").alias("member"))
    return materialise(short.unionByName(above).unionByName(below), "segments"), materialise(ends, "ends")


def build(turns: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes below the root, ends, levels).

    Nodes: conv_id, depth, parent_conv_id, n_convs, n_bytes and ``cuts``, the names
    of the cuts above the node, largest segment first, one per bit set in depth - 1.
    Ends: (node, depth, member), the conversations that end at a node, those without turns at depth 0.
    """
    first, longest = sizes.agg(F.min("conv_id"), F.max("n")).first()
    levels = max((longest or 0) - 1, 0).bit_length()
    root = F.lit(first).cast("long")
    rows = sizes.where("n > 0").select(
        root.alias("up"), "conv_id", F.lit(0).cast("long").alias("seg"), F.lit(1).cast("long").alias("weight"), "n",
        F.array().cast("array<bigint>").alias("cuts"), F.lit(True).alias("open"))
    ends = sizes.where("n = 0").select(root.alias("node"), F.lit(0).cast("long").alias("depth"), F.col("conv_id").alias("member"))
    blocks = block_names(turns, levels)
    for level in range(levels, 0, -1):
        rows, ended = _cut(rows, blocks[level - 1], level)
        ends = ends.unionByName(ended)
    single = materialise(rows.join(turns.withColumnRenamed("pos", "seg"), ["conv_id", "seg"]), "single")
    nodes = materialise(
        single.groupBy("up", "seg", "name").agg(
            F.min("conv_id").alias("node"), F.sum("weight").alias("n_convs"), F.first("n_bytes").alias("n_bytes"), F.first("cuts").alias("cuts")),
        "nodes")
    last = join_skewed(single.where("open").withColumnRenamed("conv_id", "member"), nodes.select("up", "seg", "name", "node"), ["up", "seg", "name"])
    ends = ends.unionByName(last.select("node", (F.col("seg") + 1).alias("depth"), "member"))
    return nodes.select(
        F.col("node").alias("conv_id"), (F.col("seg") + 1).alias("depth"), F.col("up").alias("parent_conv_id"), "n_convs", "n_bytes", "cuts",
    ), ends, levels


def subtree_totals(nodes: DataFrame, levels: int, values: list[str]) -> DataFrame:
    """``nodes`` with each of ``values`` summed over the subtree below and including the node."""
    pos = F.col("depth") - 1
    key = ["conv_id", "depth"]
    done = [nodes.where(F.col("depth") % (1 << levels) == 0)] if levels else [nodes]
    for level in range(levels - 1, -1, -1):
        lower = F.shiftright(pos, level) % 2 == 1
        half, whole = 1 << level, 2 << level
        parts = [nodes.where(lower & (F.col("depth") % whole != 0)), *[d.where(lower) for d in done]]
        cut = F.get("cuts", F.bit_count(F.shiftright(pos, level + 1)))
        grafts = [
            p.select(cut.alias("conv_id"), F.shiftleft(F.shiftright(pos, level), level).alias("depth"), *values) for p in parts
        ]
        summed = grafts[0]
        for g in grafts[1:]:
            summed = summed.unionByName(g)
        summed = summed.groupBy(*key).agg(*[F.sum(v).alias("_" + v) for v in values])
        here = nodes.where(F.col("depth") % whole == half).join(summed, key, "left")
        done.append(materialise(here.select(
            *[(F.col(c) + F.coalesce("_" + c, F.lit(0))).alias(c) if c in values else F.col(c) for c in nodes.columns]), "totals"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, depth, ends_sha256): digest of the members of each node in numeric order, joined by commas.

    Members are joined in bounded strings, in order; a digest reads its node's
    strings one after the other, so no node's members are gathered in one row.
    """
    numbered = number_rows(ends, ["node", "depth"], ["member"], "_k")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("member")), lambda i: i.cast("string")), ",")
    strings = numbered.groupBy("node", "depth", F.floor(F.col("_k") / IDS_PER_STRING).alias("part")).agg(joined.alias("ids"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, sha, out = None, None, []
        for batch in batches:
            for node, depth, ids in zip(batch["node"].tolist(), batch["depth"].tolist(), batch["ids"]):
                if (node, depth) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (node, depth), hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            if out:
                yield pd.DataFrame(out, columns=["node", "depth", "ends_sha256"])
                out = []
        if key is not None:
            yield pd.DataFrame([(*key, sha.hexdigest())], columns=["node", "depth", "ends_sha256"])

    ordered = strings.repartition("node", "depth").sortWithinPartitions("node", "depth", "part")
    return ordered.mapInPandas(digest, "node long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations, the root included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    Repeated rows are turns of their own; without conversations there are no nodes;
    other columns are not read. Ids of any sign: c - c % 5 goes toward zero.
    """
    turns, sizes = with_shared_heads(named_turns(conversations))
    nodes, ends, levels = build(turns, sizes)
    children = nodes.groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    counted = nodes.join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "cuts",
        F.col("n_children").isNull().cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    counted = materialise(counted, "counted")
    totals = subtree_totals(counted, levels, ["n_leaves", "saved_tokens"]).drop("cuts")
    whole = sizes.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    below = counted.agg(
        F.count_if(F.col("depth") == 1).alias("n_children"), F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
    zero = F.lit(0).cast("long")
    root = whole.join(F.broadcast(below.withColumn("_one", F.lit(1))), F.lit(1) == F.col("_one")).select(
        "conv_id", zero.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.coalesce("_leaves", F.lit(1)).cast("long").alias("n_leaves"), F.coalesce("_saved", zero).alias("saved_tokens"))
    digests = end_digests(ends).withColumnRenamed("node", "conv_id")
    nothing = hashlib.sha256(b"").hexdigest()
    return totals.unionByName(root).join(digests, ["conv_id", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))


# The CRC is taken bit by bit: 8 steps per digit, -1 marking a step.
SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT conv_id, n, xor(list_reduce(flatten(list_prepend([4294967295], list_transform(string_split(conv_id::VARCHAR, ''),
      lambda d: [ascii(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 9 AS head
  FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)),
plan AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 5 AS base, c.head, least(c.head, coalesce(b.n, 0)) AS taken,
    least(c.head, coalesce(b.n, 0)) + greatest(c.n - c.head, 0) AS n
  FROM heads c LEFT JOIN heads b ON b.conv_id = c.conv_id - c.conv_id % 5),
rebuilt AS (
  SELECT p.conv_id, pos, role, text FROM plan p JOIN turns t ON t.conv_id = p.base AND pos < taken
  UNION ALL SELECT p.conv_id, pos - head + taken, role, text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND pos >= head),
prefixes AS (
  SELECT conv_id, pos + 1 AS depth, octet_length(encode(text)) AS n_bytes,
    list({'role': role, 'text': text}) OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS beginning
  FROM rebuilt UNION ALL SELECT conv_id, 0, 0, [] FROM plan),
path AS (
  SELECT conv_id AS member, depth, min(conv_id) OVER (PARTITION BY depth, beginning) AS conv_id, n_bytes FROM prefixes),
nodes AS (
  SELECT conv_id, depth, count(*) AS n_convs, min(n_bytes) AS n_bytes FROM path GROUP BY ALL),
parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n LEFT JOIN path p ON p.member = n.conv_id AND p.depth = n.depth - 1),
children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL),
counted AS (
  SELECT p.*, coalesce(n_children, 0) AS n_children FROM parents p LEFT JOIN children USING (conv_id, depth)),
totals AS (
  SELECT a.conv_id, a.depth, count(*) FILTER (c.n_children = 0) AS n_leaves, sum((c.n_convs - 1) * c.n_bytes)::BIGINT AS saved_tokens
  FROM counted c JOIN path a ON a.member = c.conv_id AND a.depth <= c.depth GROUP BY ALL),
ends AS (
  SELECT a.conv_id, a.depth, string_agg(a.member::VARCHAR, ',' ORDER BY a.member) AS ids
  FROM path a JOIN plan p ON p.conv_id = a.member AND p.n = a.depth GROUP BY ALL)
SELECT c.conv_id, c.depth, c.parent_conv_id, c.n_convs, c.n_children, t.n_leaves, t.saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM counted c JOIN totals t USING (conv_id, depth) LEFT JOIN ends USING (conv_id, depth)"""

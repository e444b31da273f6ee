"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents by hash. Its target, in words, fixes
an exact quota of block draws: whole passes over a permutation of its blocks, then
the blocks of a last pass up to the target, of which the final one is taken in part.
A binary tree deals these quotas to the output shards: a node hands its left child
a uniform random subset of its draws and its right child the rest, so the children's
quotas per source are a multivariate-hypergeometric draw and add up exactly. Each
leaf then owns a run of its sources' permuted draws, disjoint from all others, and
shuffles its documents locally by hash.

All of it is DataFrame operations. Only source tables, block tables (BLOCKS per
source) and quotas are ever sorted together; documents are joined to their block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.bind import bind
from ..session import materialise
from .common import SPACED_WORD, whole_text

WEIGHTS = (5, 2, 1)
#: The mix holds this share of all words, and a document at most REPEATS times.
SHARE = 1.5
REPEATS = 2
#: Blocks a source is cut into (a divisor of 65,536).
BLOCKS = 512
SEED = "mix-1"


def _hash(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(SEED), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def _block(order: Column) -> Column:
    return F.conv(F.substring(order, 1, 4), 16, 10).cast("long") % BLOCKS


def sized(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, dice, block) and a struct of the columns to carry, per document."""
    dice = _hash(F.col("doc_id"))
    size = F.regexp_count(whole_text(), F.lit(SPACED_WORD)).cast("long")
    carried = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] if carry else []
    return docs.select("doc_id", "source", size.alias("size"), dice.alias("dice"), _block(dice).alias("block"), *carried)


def targets(sizes: DataFrame) -> DataFrame:
    """(source, src, source_size, target): weights by code-point order, no target above REPEATS sizes.

    Resharing until nothing is above its limit ends at one level of words per
    weight: sources whose limit lies below that level get their limit. Sorted by
    limit per weight they come first, so the level is read off running sums.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighed = by_source.withColumn("src", place).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("src") % len(WEIGHTS) + 1).cast("int"))
    ).withColumn("most", REPEATS * F.col("source_size"))
    ranked = Window.orderBy(F.col("most") / F.col("weight"), "src")
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    after = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (SHARE * F.col("all_words") - F.col("full")) / F.col("open")
    levels = (
        weighed.withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("full", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("level", F.when(level <= F.col("most") / F.col("weight"), level))
        .withColumn("level", F.max("level").over(everything))
    )
    return levels.select(
        "source", "src", "source_size",
        F.when(F.col("level") * F.col("weight") < F.col("most"), F.col("level") * F.col("weight"))
        .otherwise(F.col("most").cast("double")).alias("target"),
    )


def block_draws(blocks: DataFrame) -> DataFrame:
    """Blocks with their source's numbers -> (src, block, draw, pass, take, whole): the exact quota of draws.

    ``take`` is the number of words that the draw contributes.
    """
    goal = F.floor(F.col("target") + 0.5)
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("int")
    drawn = (
        blocks.where("words > 0").withColumn("goal", goal).withColumn("passes", passes)
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes"))))
        .withColumn("place", _hash(F.col("src"), F.col("pass"), F.col("block")))
    )
    order = Window.partitionBy("src").orderBy("pass", "place", "block")
    upto = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    left = F.col("goal") - F.coalesce("before", F.lit(0))
    return (
        drawn.withColumn("before", upto).withColumn("draw", F.row_number().over(order) - 1)
        .withColumn("take", F.least("words", left)).where("take > 0")
        .select("src", "block", "draw", "pass", "take", (F.col("take") == F.col("words")).alias("whole"))
    )


def _left_share(node: Column, quotas: Column) -> Column:
    """Quotas of the left child: how many of each source's draws a random half of all draws holds.

    Draws are visited in turn and each is chosen with probability
    wanted / remaining, which picks a uniform subset of exactly the wanted size.
    """
    def one(state, quota):
        def step(s, j):
            roll = F.xxhash64(F.lit(SEED), node, quota["src"], j).bitwiseAND(F.lit(2**53 - 1)) / float(2**53)
            hit = F.when(roll * s["left"] < s["want"], F.lit(1)).otherwise(F.lit(0)).cast("long")
            return F.struct((s["left"] - 1).alias("left"), (s["want"] - hit).alias("want"), (s["n"] + hit).alias("n"))

        start = F.struct(state["left"].alias("left"), state["want"].alias("want"), F.lit(0).cast("long").alias("n"))
        return bind(F.aggregate(F.sequence(F.lit(1).cast("long"), quota["q"]), start, step), lambda end: F.struct(
            end["left"].alias("left"), end["want"].alias("want"),
            F.concat(state["chosen"], F.array(end["n"])).alias("chosen"),
        ))

    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x["q"])
    start = F.struct(total.alias("left"), F.floor(total / 2).alias("want"), F.array().cast("array<long>").alias("chosen"))
    return F.aggregate(quotas, start, one)["chosen"]


def shard_quotas(draws: DataFrame, levels: int) -> DataFrame:
    """(shard, src, q): the leaves of the tree below 2**levels shards."""
    counts = draws.groupBy("src").agg(F.count("*").alias("q"))
    nodes = counts.agg(F.array_sort(F.collect_list(F.struct("src", "q"))).alias("quotas")).select(
        F.lit(1).cast("long").alias("node"), "quotas"
    )
    for _ in range(levels):
        split = nodes.withColumn("chosen", _left_share(F.col("node"), F.col("quotas")))
        left = F.transform("quotas", lambda x, i: F.struct(x["src"].alias("src"), F.get("chosen", i).alias("q")))
        right = F.transform("quotas", lambda x, i: F.struct(x["src"].alias("src"), (x["q"] - F.get("chosen", i)).alias("q")))
        nodes = split.select(F.explode(F.array(
            F.struct((F.col("node") * 2).alias("node"), left.alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
        )).alias("child")).select("child.node", F.filter("child.quotas", lambda x: x["q"] > 0).alias("quotas"))
    return nodes.select((F.col("node") - 2**levels).alias("shard"), F.inline("quotas"))


def mix(docs: DataFrame, levels: int = 4, carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Documents -> (documents with their source's numbers, draws).

    The first has doc_id, source, src, size, source_size, target, dice and block for
    every document; the second one row per document and time it is drawn: doc_id,
    dice, src, size, words (at most size), pass, shard, ``place``, the order within
    the shard, and the columns to carry, as a struct ``carried``. At most one
    document per source is taken in part.
    """
    sizes = materialise(sized(docs), "sized")
    goals = materialise(targets(sizes), "targets")

    def with_goals(rows: DataFrame) -> DataFrame:
        named = goals.withColumnRenamed("source", "goal_source")
        return rows.join(named, F.col("source").eqNullSafe(F.col("goal_source"))).drop("goal_source")

    known = with_goals(sizes)
    blocks = known.groupBy("src", "block").agg(
        F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    draws = materialise(block_draws(blocks), "draws")
    leaves = shard_quotas(draws, levels)
    earlier = Window.partitionBy("src").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    owned = leaves.withColumn("first", F.coalesce(F.sum("q").over(earlier), F.lit(0))).select(
        "src", "shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("q") - 1)).alias("draw")
    )
    dealt = materialise(draws.join(owned, ["src", "draw"]), "dealt")
    wide = with_goals(sized(docs, carry)) if carry else known.withColumn("carried", F.lit(None).cast("string"))
    chosen = wide.where("size > 0").join(dealt, ["src", "block"])
    inside = Window.partitionBy("src", "block").orderBy("dice", "doc_id", "size")
    before = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    partly = chosen.where("NOT whole").withColumn("words", F.least("size", F.col("take") - before)).where("words > 0")
    drawn = chosen.where("whole").withColumn("words", F.col("size")).unionByName(partly)
    return known, drawn.select(
        "doc_id", "dice", "src", "size", "words", "pass", "shard", "carried",
        _hash(F.col("shard"), F.col("pass"), F.col("dice")).alias("place"),
    )


def mixed_sizes(docs: DataFrame) -> DataFrame:
    """Documents -> (doc_id, size, source_size, target, taken), one row per document.

    A null text has size 0, a null source is a source of its own, the last one.
    Sources without a word have target 0. Rows that repeat an id are documents of
    their own with one place in the order, told apart by size. No rows, no result.
    Every run gives the same mix, as all choices are hashes of the ids.
    """
    known, drawn = mix(docs)
    none = known.select("doc_id", "src", "size", "source_size", "target", F.lit(0).cast("long").alias("words"))
    same = ["doc_id", "src", "size"]
    rows = none.groupBy(*same).agg(F.count("*").alias("n"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    took = drawn.groupBy(*same).agg(F.sum("words").alias("taken"))
    hit = rows["doc_id"].eqNullSafe(took["doc_id"]) & (rows["src"] == took["src"]) & (rows["size"] == took["size"])
    per = rows.join(took, hit, "left").select(
        rows["doc_id"], rows["size"], "source_size", "target", "n", F.coalesce("taken", F.lit(0)).alias("all_taken")
    )
    # Repeated rows share their words; the first ones carry the remainder.
    return per.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        "doc_id", "size", "source_size", "target",
        F.expr("all_taken div n + CASE WHEN k <= all_taken % n THEN 1 ELSE 0 END").alias("taken"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, with the columns of the documents: a row per time a document is drawn.

    Documents come whole. Where the mix takes a document in part, which it does once per source at most, that document comes if
    at least half its words are taken, so a source misses its target by half a document at most. Rows come in the
    shards and the order that the tree and the local shuffle give. Null texts have no words and are not
    drawn; rows without id or with a repeated one are drawn like others; no rows give no rows.
    """
    _, drawn = mix(docs, carry=tuple(docs.columns))
    dealt = drawn.where("2 * words >= size").repartition("shard", F.substring("place", 1, 2)).sortWithinPartitions("shard", "place")
    return dealt.select(*[F.col(f"carried.`{c}`").alias(c) for c in docs.columns])


SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS dice
  FROM documents
), cut AS (
  SELECT *, CAST('0x' || substr(dice, 1, 4) AS BIGINT) % {BLOCKS} AS block FROM sizes
), weighed AS (
  SELECT *, (ARRAY{list(WEIGHTS)})[src % {len(WEIGHTS)} + 1] AS weight, {REPEATS} * source_size AS most
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
        FROM cut GROUP BY source)
), sums AS (
  SELECT *, sum(source_size) OVER () AS all_words,
         coalesce(sum(most) OVER (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS closed,
         sum(weight) OVER (ORDER BY most / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM weighed
), found AS (
  SELECT max(CASE WHEN ({SHARE} * all_words - closed)::DOUBLE / free <= most / weight
             THEN ({SHARE} * all_words - closed)::DOUBLE / free END) AS level
  FROM sums
), goals AS (
  SELECT source, src, source_size, CASE WHEN level * weight < most THEN level * weight ELSE most::DOUBLE END AS target
  FROM weighed, found
), known AS (
  SELECT doc_id, src, size, source_size, target, dice, block
  FROM cut JOIN goals ON cut.source IS NOT DISTINCT FROM goals.source
), blocks AS (
  SELECT src, block, CAST(sum(size) AS BIGINT) AS words, CAST(floor(any_value(target) + 0.5) AS BIGINT) AS goal,
         any_value(source_size) AS source_size
  FROM known GROUP BY src, block HAVING sum(size) > 0
), passes AS (
  SELECT *, unnest(generate_series(0, goal // source_size)) AS pass FROM blocks
), runs AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY src
              ORDER BY pass, md5('{SEED}|' || src || '|' || pass || '|' || block), block
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM passes
), draws AS (
  SELECT src, block, least(words, goal - before) AS take, words <= goal - before AS whole FROM runs WHERE goal > before
), part AS (
  SELECT k.*, d.take, d.whole,
         coalesce(sum(size) OVER (PARTITION BY k.src, k.block, d.whole ORDER BY dice, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM known k JOIN draws d ON k.src = d.src AND k.block = d.block
), took AS (
  SELECT doc_id, CAST(sum(CASE WHEN whole THEN size ELSE greatest(0, least(size, take - before)) END) AS BIGINT) AS taken
  FROM part GROUP BY doc_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM known LEFT JOIN took USING (doc_id)
"""

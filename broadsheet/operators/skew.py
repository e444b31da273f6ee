"""Joins and numbering that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

# A key with more rows than this is split over several tasks.
HEAVY_ROWS = 1_000_000


def join_skewed(
    left: DataFrame, right: DataFrame, on: Sequence[str], rows: int | None = None, heavy_rows: int = HEAVY_ROWS
) -> DataFrame:
    """Inner join where ``right`` has a few rows per key and ``left`` may be skewed.

    A key with more than ``heavy_rows`` rows on the left is cut into that many
    parts of about ``heavy_rows``, and its right rows are copied to each part. Only
    the names of such keys are broadcast; there are at most ``rows / heavy_rows``
    of them. With ``rows``, the size of the left side if known, small inputs skip
    the check.
    """
    on = list(on)
    if rows is not None and rows <= heavy_rows:
        return left.join(right, on)
    heavy = (
        left.groupBy(*on).agg(F.count("*").alias("_parts")).where(F.col("_parts") > heavy_rows)
        .withColumn("_parts", F.ceil(F.col("_parts") / heavy_rows).cast("long"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    cut = left.join(F.broadcast(heavy), on, "left").withColumn(
        "_part", F.pmod(F.xxhash64(*left.columns), parts)).drop("_parts")
    copies = right.join(F.broadcast(heavy), on, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")
    return cut.join(copies, [*on, "_part"]).drop("_part")


#: Up to this number of keys are sent to all tasks instead of moving the rows that are held against them.
LISTED = 100_000
#: Bits of the map that larger sets of keys are sent as, whatever the number of keys: 8 MB.
MAP_BITS = 1 << 26
#: Words of 64 bits in a row of the map. The driver holds every map that is sent, and a row costs more than a word.
MAP_ROW = 64
#: Offsets of numbered rows are sent to all tasks up to this number.
FEW = 20_000


def _sifted(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` with ``_maybe``: false only if the key is not in ``keys``; the rows stay where they are."""
    def spot(types) -> Column:
        return F.pmod(F.xxhash64(*[F.col(c).cast(types[c].dataType) for c in on]), F.lit(MAP_BITS))

    word, bit = F.shiftright(spot(rows.schema), 6), F.pmod(spot(rows.schema), F.lit(64)).cast("int")
    place = F.pmod(word, F.lit(MAP_ROW)).cast("int")
    shifted = lambda b: F.call_function("shiftleft", F.lit(1).cast("long"), b)
    words = keys.groupBy(F.floor(word / MAP_ROW).alias("_row"), place.alias("_place")).agg(F.bit_or(shifted(bit)).alias("_bits"))
    bits = words.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_place", "_bits"))).alias("_words")).select(
        "_row", F.transform(F.sequence(F.lit(0), F.lit(MAP_ROW - 1)), lambda i: F.coalesce(F.try_element_at("_words", i), F.lit(0).cast("long"))).alias("_words"))
    marked = rows.withColumn("_row", F.floor(word / MAP_ROW)).join(F.broadcast(bits), "_row", "left")
    hit = F.coalesce(F.get("_words", place).bitwiseAND(shifted(bit)) != 0, F.lit(False))
    return marked.select(*rows.columns, hit.alias("_maybe"))


def among(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` whose key is in ``keys``, as a left semi join, but only rows whose key may be there are moved.

    ``keys`` are read more than once, so they should be a written table.
    """
    on = list(on)
    if keys.count() <= LISTED:
        return rows.join(F.broadcast(keys.select(*on)), on, "left_semi")
    return _sifted(rows, keys, on).where("_maybe").drop("_maybe").join(keys.select(*on), on, "left_semi")


def without(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """``rows`` whose key is not in ``keys``, as a left anti join; see :func:`among`."""
    on = list(on)
    if keys.count() <= LISTED:
        return rows.join(F.broadcast(keys.select(*on)), on, "left_anti")
    sifted = _sifted(rows, keys, on)
    held = sifted.where("_maybe").drop("_maybe").join(keys.select(*on), on, "left_anti").select(*rows.columns)
    return sifted.where("NOT _maybe").drop("_maybe").unionByName(held)


def number_rows(df: DataFrame, within: Sequence[str], order: Sequence[Column | str], name: str) -> DataFrame:
    """0-based position of each row in its ``within`` group, ordered by ``order``.

    Equals ``row_number() - 1`` over that window, but a group may span any number
    of tasks: rows are range-partitioned and sorted, each (group, partition) run
    is counted, and the run's offset is added to the place within it. ``order``
    should make rows unique, so that no tie ends up in one large run.
    """
    within = list(within)
    keys = [F.col(c) for c in within] + [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    stamped = materialise(
        ordered.withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_run", F.shiftright("_at", 33)),
        "ordered", "zstd",
    )
    runs = materialise(stamped.groupBy(*within, "_run").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")), "runs")
    # One row per run: a window partition holds at most as many rows as there
    # are range partitions.
    earlier = Window.partitionBy(*within).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        *[F.col(c).alias("_k_" + c) for c in within],
        F.col("_run").alias("_k_run"),
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_run") == F.col("_k_run")
    for c in within:
        same = same & F.col(c).eqNullSafe(F.col("_k_" + c))
    # A run per group and partition at most; few of them go to the rows and not the rows to them.
    return stamped.join(F.broadcast(offsets) if runs.count() <= FEW else offsets, same).select(
        *df.columns, (F.col("_at") + F.col("_shift")).cast("long").alias(name)
    )

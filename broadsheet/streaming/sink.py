"""Archiving a stream of stories so that a story told before is not told again.

Beside the archive lies an index of what has been told: a row per text and burst of coverage,
with the text's fingerprint and shingles. Every batch probes the index, archives what
is new and adds its own rows. Both tables are kept per batch number and a batch never reads rows of its own
number or later, so one that runs again after a failure finds what it found before
and overwrites just its own files.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import SimilarityConfig
from ..functions.text import fingerprint
from ..operators.similarity import shingles
from ..operators.skew import among, join_skewed, without
from ..session import discard, intermediate, materialise, read_if_there, tidy

DAY_US = 86_400_000_000
#: Earliest texts of a posting that everything in it is compared with first.
LEADERS = 4


def bursts(stories: DataFrame, text: str, at: str, key: str, days: int) -> DataFrame:
    """(fingerprint, first, last_us): each text's coverage, parted where it was quiet for ``days``.

    ``first`` is a struct of the time in microseconds, the key and the other columns of the burst's
    first row. Rows of one text and hour combine before they meet.
    """
    own = [c for c in stories.columns if c != key]
    micros = F.unix_micros(F.col(at).cast("timestamp"))
    hourly = stories.where(F.col(text).isNotNull() & F.col(at).isNotNull()).groupBy(
        fingerprint(F.col(text)).alias("fingerprint"), F.floor(micros / 3_600_000_000).alias("_hour")
    ).agg(F.min(F.struct(micros.alias("us"), F.col(key), *own)).alias("first"), F.max(micros).alias("last_us"))
    by_hour = Window.partitionBy("fingerprint").orderBy("_hour")
    quiet = F.col("first.us") - F.lag("last_us").over(by_hour) >= days * DAY_US
    parted = hourly.withColumn("_opens", F.coalesce(quiet, F.lit(False)).cast("int")).withColumn("_burst", F.sum("_opens").over(by_hour))
    return parted.groupBy("fingerprint", "_burst").agg(F.min("first").alias("first"), F.max("last_us").alias("last_us")).drop("_burst")


def _prefix(grams: Column, config: SimilarityConfig) -> Column:
    """The shingles that two sets at the threshold cannot both miss: the smallest hashes, an order that never changes."""
    n = F.size(grams)
    return F.slice(grams, F.lit(1), (n - F.ceil(n * config.num / config.den) + 1).cast("int"))


def _bands(n: Column, config: SimilarityConfig, reach: int) -> Column:
    """Size bands of sets of ``n`` shingles; similar sets are at most one band apart."""
    place = F.log(n.cast("double")) / math.log(config.den / config.num)
    if not reach:
        return F.array(F.floor(place).cast("int"))
    return F.sequence(F.floor(place - reach - 1e-9).cast("int"), F.floor(place + reach + 1e-9).cast("int"))


def _earlier(told: str, new: str, days: int) -> Column:
    """Whether coverage ``told`` began before story ``new`` and went on until less than ``days`` before it."""
    began, comes = F.col(f"{told}_us"), F.col(f"{new}_us")
    before = (began < comes) | ((began == comes) & (F.col(f"{told}_key") < F.col(f"{new}_key")))
    return before & (F.col(f"{told}_last") > comes - days * DAY_US)


def _similar(probes: DataFrame, told: DataFrame, postings: DataFrame, days: int, config: SimilarityConfig) -> DataFrame:
    """Keys of ``probes`` that are similar to earlier rows of ``told`` which share one of ``postings``."""
    wanted = probes.select(
        F.col("key").alias("new_key"), F.col("us").alias("new_us"), F.col("n").alias("new_n"),
        F.explode(_bands(F.col("n"), config, 1)).alias("band"), "grams",
    ).select("*", F.explode(_prefix(F.col("grams"), config)).alias("gram")).drop("grams")
    sizes = (F.col("told_n") * config.den >= F.col("new_n") * config.num) & (F.col("new_n") * config.den >= F.col("told_n") * config.num)
    met = materialise(join_skewed(wanted, postings, ["band", "gram"]).where(sizes & _earlier("told", "new", days)).select("new_key", "told_key").distinct(), "met")
    # Only sets of texts that meet another one are moved.
    news, olds = (materialise(met.select(F.col(c).alias("key")).distinct(), "meeting") for c in ("new_key", "told_key"))
    both = met.join(among(probes.select("key", "grams", "n"), news, ["key"]).select(F.col("key").alias("new_key"), F.col("grams").alias("_new"), "n"), "new_key").join(
        among(told.select("key", "grams", "n"), olds, ["key"]).select(F.col("key").alias("told_key"), F.col("grams").alias("_told"), F.col("n").alias("m")), "told_key")
    shared = F.size(F.array_intersect("_new", "_told"))
    near = both.where(shared * config.den >= (F.col("n") + F.col("m") - shared) * config.num).select(F.col("new_key").alias("key")).distinct()
    near = materialise(near, "near")
    for done in (met, news, olds):
        discard(done)
    return near


def unseen(batch: DataFrame, known: DataFrame, days: int, config: SimilarityConfig) -> DataFrame:
    """(key) of the rows of ``batch`` whose text, or one at the similarity, is not covered in the ``days`` before by ``known`` or ``batch``.

    ``batch`` is a written table. Both have (key, us, last_us, fingerprint, n, grams). Crowds of near copies are told by the earliest
    texts of their postings; only what is unlike those meets the rest of a posting.
    """
    told_columns = [F.col("key").alias("told_key"), F.col("us").alias("told_us"), F.col("last_us").alias("told_last")]
    same = batch.select(F.col("key").alias("new_key"), F.col("us").alias("new_us"), "fingerprint").join(
        known.select("fingerprint", *told_columns), "fingerprint").where(_earlier("told", "new", days)).select(F.col("new_key").alias("key"))
    # Sets are not written again for what is still open; they are read from the batch.
    same = materialise(same.distinct(), "same")
    open_rows = without(batch, same, ["key"])
    told = known.unionByName(batch)
    postings = materialise(told.where("n > 0").select(
        *told_columns, F.col("n").alias("told_n"), F.get(_bands(F.col("n"), config, 0), F.lit(0)).alias("band"),
        F.explode(_prefix(F.col("grams"), config)).alias("gram")), "postings")
    ranked = postings.withColumn("_place", F.row_number().over(Window.partitionBy("band", "gram").orderBy("told_us", "told_key")))
    leaders = ranked.where(F.col("_place") <= LEADERS).drop("_place")
    probes = open_rows.where("n > 0")
    led = _similar(probes, told, leaders, days, config)
    rest = without(probes, led, ["key"])
    found = _similar(rest, told, postings, days, config)
    return materialise(without(without(open_rows.select("key"), led, ["key"]), found, ["key"]), "fresh")


def archive_unseen(
    batch: DataFrame, batch_id: int, path: str, text: str = "text", key: str = "story_id", at: str = "received_at",
    date_column: str = "digest_date", days: int = 7, config: SimilarityConfig = SimilarityConfig(),
) -> None:
    """One batch of :func:`archive_stories`.

    A story is archived unless a text equal or similar to it was covered in the ``days`` before it, by this batch or an earlier
    one. Rows without text or time are no stories. ``key`` tells rows apart and decides between equal times.
    """
    spark = batch.sparkSession
    # What a batch writes besides the archive and its index is of no use to later ones.
    with intermediate(spark):
        told = bursts(batch, text, at, key, days)
        grams = shingles(F.col("first")[text], config.width)
        told = materialise(told.select(
            F.col("first")[key].alias("key"), F.col("first.us").alias("us"), "last_us", "fingerprint", grams.alias("grams"), "first",
        ).withColumn("n", F.size("grams").cast("long")), "told", "zstd")
        index_columns = ["key", "us", "last_us", "fingerprint", "n", "grams"]
        rows = told.select(index_columns)
        stored = read_if_there(spark, f"{path}/index", "key long, us long, last_us long, fingerprint string, n long, grams array<bigint>, day date, batch_id long")
        if stored is None:
            known = rows.limit(0)
        else:
            first = told.agg(F.min("us")).first()[0]
            horizon = (first or 0) - days * DAY_US
            # The day of a row's last coverage is a folder, so what is long past is not read.
            reach = F.to_date(F.timestamp_micros(F.lit(horizon)))
            known = stored.where((F.col("batch_id") < batch_id) & (F.col("day") >= reach) & (F.col("last_us") > horizon)).select(index_columns)
        fresh = among(told, unseen(rows, known, days, config), ["key"])
        stories = fresh.select(*[F.col("first")[c].alias(c) for c in batch.columns]).withColumn("batch_id", F.lit(batch_id).cast("long"))
        day = F.to_date(F.timestamp_micros("last_us"))

        def put(df: DataFrame, name: str, *parts: str) -> None:
            # Rows of a day are brought together, else every task writes a file for every day; days with many rows still go to several tasks.
            with tidy(spark):
                df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "batch_id").parquet(
                    f"{path}/{name}", compression="zstd")

        put(stories, "stories", date_column)
        put(rows.withColumn("day", day).withColumn("batch_id", F.lit(batch_id).cast("long")), "index", "day")


def archive_stories(stream: DataFrame, path: str, progress: str, **settings) -> None:
    """Archive what is available of a story stream under ``path``/stories, each story once.

    ``settings`` are those of :func:`archive_unseen`. Batches count in their order: a row that comes in a later batch than rows after it
    is judged by what was told until then.
    """
    (
        stream.writeStream.foreachBatch(lambda batch, number: archive_unseen(batch, number, path, **settings))
        .option("checkpointLocation", progress).trigger(availableNow=True).start().awaitTermination()
    )

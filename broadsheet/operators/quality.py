"""How far senders and confidences can be trusted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import CONFIDENCES
from ..session import materialise

#: Weight of each confidence level, from the highest down to 0.
LEVELS = {level: 1 - i / (len(CONFIDENCES) - 1) for i, level in enumerate(CONFIDENCES)}


def source_quality(mail: DataFrame, prior: float = 20.0) -> DataFrame:
    """(sender, n_mails, n_news, confidence, quality): senders by the confidence of what they send.

    ``mail`` has sender, is_news and confidence. A mail scores the weight of its confidence if it is news, else 0.
    ``quality`` is the sender's mean score drawn toward that of all mail as if ``prior`` more mails had the latter, so that
    a few lucky mails make no good source. Levels that are unknown score as the lowest.
    """
    level = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])
    score = F.when(F.col("is_news"), F.coalesce(F.try_element_at(level, F.col("confidence")), F.lit(0.0))).otherwise(0.0)
    by_sender = materialise(mail.groupBy("sender").agg(
        F.count("*").alias("n_mails"), F.count_if("is_news").alias("n_news"), F.sum(score).alias("_score")), "senders")
    mean = by_sender.agg(F.sum("_score") / F.sum("n_mails")).first()[0]
    return by_sender.select(
        "sender", "n_mails", "n_news", (F.col("_score") / F.col("n_mails")).alias("confidence"),
        ((F.col("_score") + prior * F.lit(mean)) / (F.col("n_mails") + prior)).alias("quality"))


def confusion(judged: DataFrame, predicted: str, actual: str) -> DataFrame:
    """(predicted, actual, n, precision, recall): counts by predicted and true category, with the shares of the row and of the column."""
    n = judged.groupBy(F.col(predicted).alias("predicted"), F.col(actual).alias("actual")).agg(F.count("*").alias("n"))
    row, column = Window.partitionBy("predicted"), Window.partitionBy("actual")
    return n.select(
        "predicted", "actual", "n", (F.col("n") / F.sum("n").over(row)).alias("precision"), (F.col("n") / F.sum("n").over(column)).alias("recall"))


def calibrated(judged: DataFrame, score: str, right: str, bins: int = 50) -> DataFrame:
    """(bin, n, n_right, probability): chance of being right by score, never falling as the score rises.

    Scores lie in 0 to 1 and are counted in ``bins`` equal bins. Isotonic regression over the bins: neighbours that fall are pooled.
    A bin's pooled mean is the greatest, over the bins from which it may be reached, of the least mean of
    a stretch that begins there and takes it in; with the counts added up, that is two aggregates over pairs of bins,
    whose number the ``bins`` bound.
    """
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    counted = judged.where(F.col(score).isNotNull() & F.col(right).isNotNull()).groupBy(at.alias("bin")).agg(
        F.count("*").alias("n"), F.count_if(right).alias("n_right"))
    # One row holds all bins, at most ``bins`` of them.
    row = F.array_sort(F.collect_list(F.struct("bin", "n", "n_right"))).alias("all")
    each = counted.agg(row).select("all", F.posexplode("all").alias("i", "b"))
    begun = each.select("i", "b", "all", F.explode(F.sequence(F.lit(0), F.col("i"))).alias("start"))
    stretch = begun.select("i", "b", "all", "start", F.explode(F.sequence(F.col("i"), F.size("all") - 1)).alias("end"))
    part = F.slice("all", F.col("start") + 1, F.col("end") - F.col("start") + 1)
    total = lambda field: F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x[field])
    means = stretch.select("i", "b", "start", (total("n_right") / total("n")).alias("mean"))
    least = means.groupBy("i", "b", "start").agg(F.min("mean").alias("mean"))
    return least.groupBy("i", "b").agg(F.max("mean").alias("probability")).select("b.bin", "b.n", "b.n_right", "probability")


def confident(judged: DataFrame, calibration: DataFrame, score: str, least: float, bins: int = 50) -> DataFrame:
    """Rows of ``judged`` whose calibrated chance of being right is at least ``least``, with it as ``probability``."""
    at = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    table = F.broadcast(calibration.select(F.col("bin").alias("_bin"), "probability"))
    return judged.withColumn("_bin", at).join(table, "_bin").where(F.col("probability") >= least).drop("_bin")

"""Writing digests: dated archive, outbox rows and rendered pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import number_rows

TEXT_PART = "Please open this digest in a mail reader that shows HTML."


def write_archive(df: DataFrame, path: str, date_column: str = "digest_date") -> None:
    """Replace exactly the dates present in ``df``; a repeated run changes nothing.

    Rows of a date are brought together, else every task writes a file for every date; a date with many rows still goes to several tasks.
    """
    (
        df.hint("rebalance", date_column).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .parquet(path)
    )


def outbox(
    digests: DataFrame,
    recipients: DataFrame,
    default_recipient: str,
    on: str = "category",
    recipients_per_message: int = 100,
) -> DataFrame:
    """Messages to send: every digest to its recipients, or to the default one.

    Recipients are joined into one To line per message; a long list is split over
    as many messages as it needs, so no line and no task grows with the list.
    """
    keys = [c for c in digests.columns]
    listed = recipients.select(on, "recipient")
    # An inner join from the long side: its hot categories can be split, or the few digests broadcast.
    addressed = listed.join(digests, on).select(
        *keys, F.coalesce("recipient", F.lit(default_recipient)).alias("recipient")
    ).unionByName(
        digests.join(listed.select(on).distinct(), on, "left_anti").select(*keys, F.lit(default_recipient).alias("recipient"))
    )
    numbered = number_rows(addressed, keys, ["recipient"], "_n")
    batch = F.floor(F.col("_n") / recipients_per_message).cast("long")
    return (
        numbered.groupBy(*keys, batch.alias("message_no"))
        .agg(
            F.array_join(F.array_sort(F.collect_list("recipient")), ", ").alias("to_line"),
            F.count("*").alias("n_recipients"),
        )
        .withColumn("text_part", F.concat(F.col("title"), F.lit("\n\n" + TEXT_PART)))
    )


def write_pages(fragments: DataFrame, path: str, order: list[str], date_column: str = "digest_date") -> None:
    """Rendered fragments as text files, in order within and across a date's files."""
    (
        fragments.repartitionByRange(date_column, *order)
        .sortWithinPartitions(date_column, *order)
        .select(date_column, F.col("html").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column)
        .text(path)
    )

"""Reading exported mail and restricting it to the wanted window and senders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import sender_address
from ..schemas import MESSAGE_EXPORT, STORY_FILE

CORRUPT = "_corrupt_record"


#: Column of the landing table that names a message's day.
DAY = "received_date"


def write_landing(messages: DataFrame, path: str, at: str = "received_at") -> None:
    """Replace the days and accounts present in ``messages`` in the landing table, which has a folder for each.

    Rows are dealt by ranges of account and time, so that one busy account or day is written by many tasks while a
    quiet one stays in one file. Messages without a time go to the folder of no day.
    """
    (
        messages.withColumn(DAY, F.to_date(at)).repartitionByRange("account", DAY, at)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("account", DAY).parquet(path)
    )


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Columnar landing table of exported mail, as :func:`write_landing` lays it out or any other."""
    return spark.read.parquet(path)


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited JSON export; unreadable lines are kept in ``_corrupt_record``."""
    schema = T.StructType(MESSAGE_EXPORT.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def split_corrupt(export: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, quarantine rows) of :func:`read_export`."""
    good = export.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = export.where(F.col(CORRUPT).isNotNull()).select("account", "message_id", CORRUPT)
    return good, bad


def trailing(df: DataFrame, as_of: datetime | Column, days: int = 1, column: str = "received_at") -> DataFrame:
    """Rows newer than ``days`` before ``as_of``; a literal bound reaches the scan, and the folders of a landing table."""
    bound = (as_of if isinstance(as_of, Column) else F.lit(as_of)) - F.make_dt_interval(F.lit(days))
    recent = df.where(F.col(column) > bound)
    return recent.where(F.col(DAY) >= F.to_date(bound)) if DAY in df.columns else recent


def trailing_by_account(landing: DataFrame, clocks: DataFrame, days: int = 1, column: str = "received_at") -> DataFrame:
    """Rows of a landing table newer than ``days`` before their account's own clock: ``clocks`` (account, as_of).

    Accounts without a clock have no rows. The clocks become one row per account and day, which the scan reads before
    it chooses its folders.
    """
    bound = F.col("as_of") - F.make_dt_interval(F.lit(days))
    open_days = clocks.where(F.col("as_of").isNotNull()).select(
        "account", bound.alias("_bound"), F.explode(F.sequence(F.to_date(bound), F.to_date("as_of"))).alias(DAY))
    return landing.join(open_days, ["account", DAY]).where(F.col(column) > F.col("_bound")).drop("_bound")


def sender_list(listed: str, own_address: str = "") -> list[str]:
    """Comma-separated senders plus our own address, first mention kept."""
    names = [part.strip() for part in (*listed.split(","), own_address)]
    return list(dict.fromkeys(name for name in names if name))


def exclude_senders(df: DataFrame, senders: Iterable[str] | DataFrame, column: str = "sender") -> DataFrame:
    """Drop mail of the given addresses, compared without regard to case.

    A configured list becomes a literal set; a table of any size is anti-joined
    and Spark picks the strategy from its size.
    """
    address = sender_address(F.col(column))
    if isinstance(senders, DataFrame):
        excluded = senders.select(F.lower(F.trim(F.col(senders.columns[0]))).alias("_excluded")).distinct()
        return df.join(excluded, address == F.col("_excluded"), "left_anti")
    wanted = sorted({s.lower() for s in senders})
    return df.where(~F.coalesce(address.isin(wanted), F.lit(False))) if wanted else df


def union_accounts(mailboxes: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """All mail of ``{address: (display name, messages)}``, each row tagged.

    The same newsletter in two mailboxes stays two messages.
    """
    tagged = [
        df.withColumn("account", F.lit(address)).withColumn("account_name", F.lit(name))
        for address, (name, df) in mailboxes.items()
    ]
    whole = tagged[0]
    for df in tagged[1:]:
        whole = whole.unionByName(df)
    return whole


def name_accounts(messages: DataFrame, accounts: DataFrame) -> DataFrame:
    """Add ``account_name`` from the accounts dimension to an already tagged table."""
    return messages.join(accounts.select("account", "account_name"), "account", "left")


def read_stories(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Preview file(s) ``{"items": [...]}`` -> one row per story; fields may be absent.

    Files with one object per line can be split over tasks: ``multi_line=False``.
    """
    return spark.read.schema(STORY_FILE).option("multiLine", multi_line).json(path).select(F.inline("items"))

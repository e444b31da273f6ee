"""Choosing the readable body of a multipart message."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.bind import bind
from ..functions.text import decode_b64url, header, html_to_text


def body_from_parts(parts: Column) -> Column:
    """Body text from ``array<struct<part_path, mime, data>>``.

    A part with data hides everything below it. Root data is taken whatever its
    type; otherwise the first non-empty plain part in depth-first order wins, and
    failing that the first html part that yields text. Arrays compare element by
    element, so ordering by ``part_path`` is depth-first order.
    """

    def covers(upper: Column, lower: Column) -> Column:
        depth = F.size(upper["part_path"])
        return (depth < F.size(lower["part_path"])) & (
            F.slice(lower["part_path"], 1, depth) == upper["part_path"]
        )

    def visible(loaded: Column) -> Column:
        return F.filter(loaded, lambda p: ~F.exists(loaded, lambda q: covers(q, p)))

    def first(shown: Column, mime: str, read: Callable[[Column], Column]) -> Column:
        """Text of the first part of the type that has any; null without one."""
        of_type = F.filter(shown, lambda p: p["mime"] == mime)
        texts = F.transform(of_type, lambda p: F.struct(p["part_path"].alias("path"), read(decode_b64url(p["data"])).alias("text")))
        return F.array_min(F.filter(texts, lambda t: t["text"] != ""))["text"]

    def choose(shown: Column) -> Column:
        # A root with data hides all else. Html is only decoded where no plain part has text.
        root = F.get(F.filter(shown, lambda p: F.size(p["part_path"]) == 0), F.lit(0))
        text = decode_b64url(root["data"])
        return F.when(root.isNotNull(), F.when(root["mime"] == "text/html", html_to_text(text)).otherwise(text)).otherwise(
            F.coalesce(first(shown, "text/plain", lambda t: t), first(shown, "text/html", html_to_text)))

    loaded = F.filter(parts, lambda p: F.coalesce(p["data"], F.lit("")) != "")
    return F.coalesce(bind(bind(loaded, visible), choose), F.lit(""))


def select_bodies(parts: DataFrame, key: Sequence[str] = ("account", "message_id")) -> DataFrame:
    """One body per message from the long parts table; one shuffle on the message.

    The group is one mail, whose size the mail system bounds. Parts without data
    are emptied before the shuffle and only keep the message present.
    """
    loaded = F.coalesce(F.col("data"), F.lit("")) != ""
    part = F.when(loaded, F.struct("part_path", "mime", "data"))
    return (
        parts.groupBy(*key)
        .agg(F.collect_list(part).alias("parts"))
        .select(*key, body_from_parts(F.col("parts")).alias("body"))
    )


def to_messages(export: DataFrame) -> DataFrame:
    """Exported mail with nested headers and parts -> flat messages, no shuffle."""
    return export.select(
        "account",
        "message_id",
        "received_at",
        header(F.col("headers"), "Subject").alias("subject"),
        header(F.col("headers"), "From").alias("sender"),
        header(F.col("headers"), "Date").alias("date"),
        body_from_parts(F.col("parts")).alias("body"),
    )

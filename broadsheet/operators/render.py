"""Rendering many digests at once as ordered HTML fragments.

A digest is kept as rows of markup in page order instead of one string, so its
size is not bounded by a row or a task. :func:`broadsheet.sources.archive.write_pages`
writes them out in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import clean_url, display_url, escape_html, is_safe_url
from ..schemas import (
    EMPTY_DIGEST_TEXT, EMPTY_DIGEST_TITLE, EMPTY_SUBCATEGORY, SUMMARY_TITLE, UNKNOWN_SENDER, UNTITLED_CATEGORY,
    UNTITLED_SUBCATEGORY,
)

PAGE_ORDER = ["cat_pos", "sub_pos", "slot_pos", "part", "part_pos", "html"]


def _text(c: Column, default: str = "") -> Column:
    return escape_html(F.coalesce(F.nullif(c, F.lit("")), F.lit(default)))


def _at(cat: Column, sub: Column, slot: Column, part: int, pos: Column, html: Column) -> list[Column]:
    return [
        cat.cast("long").alias("cat_pos"), sub.cast("long").alias("sub_pos"), slot.cast("long").alias("slot_pos"),
        F.lit(part).alias("part"), pos.cast("long").alias("part_pos"), html.alias("html"),
    ]


def story_html(title: Column, summary: Column, key_points: Column) -> Column:
    """Opening of one story block; title and summary arrive escaped."""
    points = F.array_join(F.transform(key_points, lambda p: F.concat(F.lit("<li>"), escape_html(p), F.lit("</li>"))), "")
    listed = F.when(F.size(key_points) > 0, F.concat(F.lit("<ul>"), points, F.lit("</ul>"))).otherwise("")
    return F.concat(
        F.lit("<article><h4>"), F.coalesce(title, F.lit("")), F.lit("</h4><p>"), F.coalesce(summary, F.lit("")),
        F.lit("</p>"), F.coalesce(listed, F.lit("")),
    )


def source_html(subject: Column, sender: Column, account: Column, date: Column) -> Column:
    def optional(c: Column, before: str, after: str = "") -> Column:
        filled = F.coalesce(c, F.lit("")) != ""
        return F.when(filled, F.concat(F.lit(before), escape_html(c), F.lit(after))).otherwise("")

    return F.concat(
        F.lit("<li>"), _text(sender, UNKNOWN_SENDER), optional(subject, " — "),
        optional(account, " (", ")"), optional(date, " • "), F.lit("</li>"),
    )


def url_html(url: Column) -> Column:
    """A link for web addresses; any other scheme is shown as text only."""
    shown = escape_html(display_url(url))
    link = F.concat(F.lit('<li><a href="'), escape_html(clean_url(url)), F.lit('">'), shown, F.lit("</a></li>"))
    return F.when(is_safe_url(url), link).otherwise(F.concat(F.lit("<li>"), shown, F.lit("</li>")))


def render(
    heads: DataFrame, curated: DataFrame, sources: DataFrame | None = None,
    urls: DataFrame | None = None, key: str = "digest_date",
) -> DataFrame:
    """Fragments (key, *PAGE_ORDER) of whole pages.

    ``heads``: one row per digest. ``curated``: one row per slot, with cat_pos,
    sub_pos, slot_pos, category, subcategory, intro, title, summary and
    optionally key_points and ``story_key``. ``sources`` and ``urls`` are long
    tables by ``story_key``.
    """
    low, high = F.lit(-1), F.lit(9_223_372_036_854_775_807)
    zero = F.lit(0)
    head = F.concat(
        F.lit("<!DOCTYPE html><html><body><header><h1>"), escape_html(F.col("title")), F.lit("</h1><p>"),
        F.col("display_date"), F.lit("</p></header>"),
        F.when(F.col("executive_summary") != "", F.concat(
            F.lit(f"<section><h2>{SUMMARY_TITLE}</h2><p>"), F.col("executive_summary"), F.lit("</p></section>")
        )).otherwise(""),
    )
    frames = [
        heads.select(key, *_at(low, low, low, 0, zero, head)),
        heads.select(key, *_at(high, low, low, 0, zero, F.lit("</body></html>"))),
    ]
    empty = heads.join(curated.select(key).distinct(), key, "left_anti")
    frames.append(empty.select(key, *_at(zero, low, low, 0, zero, F.lit(
        f"<section><h2>{EMPTY_DIGEST_TITLE}</h2><p>{EMPTY_DIGEST_TEXT}</p></section>"
    ))))
    per_category = curated.groupBy(key, "cat_pos").agg(F.min("category").alias("category"))
    frames.append(per_category.select(key, *_at(F.col("cat_pos"), low, low, 0, zero, F.concat(
        F.lit("<section><h2>"), _text(F.col("category"), UNTITLED_CATEGORY), F.lit("</h2>")
    ))))
    frames.append(per_category.select(key, *_at(F.col("cat_pos"), high, low, 0, zero, F.lit("</section>"))))
    per_sub = curated.where(F.col("sub_pos").isNotNull()).groupBy(key, "cat_pos", "sub_pos").agg(
        F.min("subcategory").alias("subcategory"), F.min("intro").alias("intro"), F.count("title").alias("_n")
    )
    intro = F.when(F.coalesce("intro", F.lit("")) != "", F.concat(F.lit("<p>"), F.col("intro"), F.lit("</p>"))).otherwise("")
    none = F.when(F.col("_n") == 0, F.lit(f"<p>{EMPTY_SUBCATEGORY}</p>")).otherwise("")
    frames.append(per_sub.select(key, *_at(F.col("cat_pos"), F.col("sub_pos"), low, 0, zero, F.concat(
        F.lit("<div><h3>"), _text(F.col("subcategory"), UNTITLED_SUBCATEGORY), F.lit("</h3>"), intro, none
    ))))
    frames.append(per_sub.select(key, *_at(F.col("cat_pos"), F.col("sub_pos"), high, 0, zero, F.lit("</div>"))))

    place = ["cat_pos", "sub_pos", "slot_pos"]
    told = curated.where(F.col("title").isNotNull())
    points = F.col("key_points") if "key_points" in curated.columns else F.lit(None).cast("array<string>")
    cat, sub, slot = (F.col(c) for c in place)
    frames.append(told.select(key, *_at(cat, sub, slot, 0, zero, story_html(F.col("title"), F.col("summary"), points))))
    frames.append(told.select(key, *_at(cat, sub, slot, 1, zero, F.lit("<footer><ul>"))))
    frames.append(told.select(key, *_at(cat, sub, slot, 4, zero, F.lit("</ul></footer></article>"))))
    if sources is not None:
        listed = told.select(key, *place, "story_key").join(sources, "story_key")
        frames.append(listed.select(key, *_at(cat, sub, slot, 2, F.col("source_pos"), source_html(
            F.col("subject"), F.col("sender"), F.col("account"), F.col("date")
        ))))
    if urls is not None:
        listed = told.select(key, *place, "story_key").join(urls, "story_key")
        frames.append(listed.select(key, *_at(cat, sub, slot, 3, F.col("url_pos"), url_html(F.col("url")))))
    page = frames[0]
    for more in frames[1:]:
        page = page.unionByName(more)
    return page

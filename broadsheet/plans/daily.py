"""One run from exported mail to finished digests."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from ..config import DigestConfig, DigestError, SimilarityConfig
from ..operators import digest as D, render, reports
from ..operators.grouping import Stories, deduplicate
from ..operators.scoring import classify_rules, news_only
from ..operators.skew import join_skewed
from ..operators.stories import extract_stories, place
from ..schemas import LAYOUT
from ..session import materialise, metered
from ..sources import archive
from ..sources.messages import exclude_senders, trailing


@dataclass
class Run:
    """Tables of one run; ``funnel`` carries the outcome as ``status`` and ``message``."""

    stories: DataFrame  # one row per story, numbered by idx
    sources: DataFrame  # story_key, source_pos, subject, sender, account, date
    urls: DataFrame  # story_key, url_pos, url
    digest: DataFrame  # title, summary and stamps
    digest_items: DataFrame  # one row per filled slot
    metrics: DataFrame
    totals: DataFrame
    funnel: DataFrame

    def pages(self) -> DataFrame:
        """The digest as ordered HTML fragments."""
        return render.render(self.digest, self.digest_items, self.sources, self.urls)


def _members(stories: DataFrame, merged: Stories) -> tuple[DataFrame, DataFrame]:
    """Sources and links of all stories by ``story_key`` (= idx)."""
    # A merged story is named after its first item, as its group is.
    names = stories.where("all_sources IS NULL").select(
        "category", F.col("first_item_id").alias("group_id"), F.col("idx").alias("story_key"))
    fields = ["subject", "sender", "account", "date"]
    sources = join_skewed(merged.sources, names, ["category", "group_id"]).select("story_key", "source_pos", *fields)
    urls = join_skewed(merged.urls, names, ["category", "group_id"]).select("story_key", F.lit(0).alias("url_pos"), "url")
    single = stories.where("all_sources IS NOT NULL").withColumnRenamed("idx", "story_key")
    own = single.select("story_key", F.lit(0).cast("long").alias("source_pos"), F.inline("all_sources")).select(
        "story_key", "source_pos", *fields)
    links = single.select("story_key", F.posexplode("source_urls").alias("url_pos", "url"))
    return sources.unionByName(own), urls.unionByName(links)


def run(
    messages: DataFrame,
    as_of: datetime,
    config: DigestConfig = DigestConfig(),
    similarity: SimilarityConfig = SimilarityConfig(),
    classify: Callable[[DataFrame], DataFrame] = classify_rules,
    extract: Callable[[DataFrame], DataFrame] = extract_stories,
    layout: Callable[[DataFrame], DataFrame] | None = None,
    group: Callable[[DataFrame], DataFrame] | None = None,
    excluded: Iterable[str] = (),
    days: int = 1,
    deliver: Callable[[Run], DataFrame] | None = None,
) -> Run:
    """Digest of the mail received in the ``days`` before ``as_of``.

    ``messages``: account, message_id, received_at, subject, sender, date, body.
    The judgement steps are arguments: ``classify`` adds the classification
    columns, ``extract`` returns items with their provenance, ``group`` proposes groups of the placed
    items (without it similar ones are searched), ``layout`` maps the
    numbered stories to nested layouts (``LAYOUT`` plus ``digest_date``); without
    it, or if it returns none, sections follow the keyword rules. Each is written out before it is used,
    so a provider that costs money is asked once. ``deliver`` gets the finished run and returns the messages
    it made, with ``sent``; see :func:`deliver_to`.
    """
    day = F.lit(as_of.date())
    recent = exclude_senders(trailing(messages, as_of, days), excluded)
    # Stages are counted while they are written.
    n = F.count(F.lit(1))
    judged, mail = metered(classify(recent), "classified", n=n, news=F.count_if("is_news"))
    items, extracted = metered(extract(news_only(judged)).withColumn("digest_date", day), "items", n=n)
    items = D.index_items(items, ["received_at", "source_account", "original_email_id", "item_pos"], name="item_id")
    told, merged = deduplicate(place(items), similarity, group)
    told = told.withColumn("digest_date", day).withColumn("_order", D.taxonomy_position(F.col("category")))
    tie_break = F.coalesce("placement_no", F.lit(0))
    stories, kept = metered(
        D.index_items(told.withColumn("_again", tie_break), ["_order", "first_item_id", "_again"]).drop("_order", "_again"),
        "stories", n=n,
    )
    sources, urls = _members(stories, merged)
    # The section is chosen anew; the placement only scoped the search for copies.
    sectioned = stories.drop("category")
    layouts = None if layout is None else D.require_valid(materialise(layout(sectioned), "layouts"))
    if layouts is not None and not layouts.isEmpty():
        proposed = D.slots(layouts)
        curated = D.with_empty_sections(D.curate(sectioned, proposed, config), proposed)
    elif config.fallback_to_keywords:
        layouts = stories.sparkSession.createDataFrame(
            [(as_of.date(), None, "", None)], "digest_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYOUT))
        proposed = stories.select("digest_date").limit(0)
        curated = D.rule_sections(sectioned)
    else:
        raise DigestError("there is no layout and the keyword fallback is off")
    curated = materialise(curated.withColumn("story_key", F.col("idx")), "digest-items")
    by_name, totals = D.digest_metrics(curated, stories, proposed)
    heads = D.digest_heads(layouts, as_of, config)
    counts = {
        "accounts": messages.select("account").distinct().count(), "total_emails": mail["n"], "news_emails": mail["news"],
        "news_items_extracted": extracted["n"], "after_deduplication": kept["n"], "categories": curated.select("cat_pos").distinct().count(),
    }
    done = Run(stories, sources, urls, heads, curated, by_name, totals, reports.funnel(stories.sparkSession, counts))
    sent = 0
    if deliver is not None:
        _, delivered = metered(deliver(done), "delivered", n=F.count_if("sent"))
        sent = delivered["n"]
    done.funnel = reports.run_status(reports.funnel(stories.sparkSession, {**counts, "sent": sent}))
    return done


def deliver_to(
    path: str, recipients: DataFrame | None = None, default_recipient: str = "editor@example.com",
) -> Callable[[Run], DataFrame]:
    """A last step for :func:`run`: archive, pages and outbox under ``path``; returns the outbox with ``sent``.

    Whatever sends the messages reads the outbox, of which a repeated run replaces its own dates. ``recipients`` has one column, recipient.
    A digest without stories is archived but not sent.
    """
    def step(done: Run) -> DataFrame:
        archive.write_archive(done.digest_items, f"{path}/items")
        archive.write_pages(done.pages(), f"{path}/pages", render.PAGE_ORDER)
        # A run makes the digest of one day.
        day = F.lit(done.digest.first()["digest_date"])
        told = done.digest_items.where("story_key IS NOT NULL").select("digest_date").distinct()
        heads = done.digest.select("digest_date", "title").join(told, "digest_date", "left_semi")
        listed = heads.sparkSession.createDataFrame([], "recipient string") if recipients is None else recipients
        out = archive.outbox(heads, listed.select(day.alias("digest_date"), "recipient"), default_recipient, on="digest_date")
        archive.write_archive(out, f"{path}/outbox")
        return out.withColumn("sent", F.lit(True))

    return step

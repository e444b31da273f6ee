"""Assembling digests: sections, slots, limits, metrics and checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..config import DigestConfig, DigestError
from ..functions.text import SHORT_DATE, apply_tag_policy, digest_stamps, escape_html, fill_title
from ..schemas import DEFAULT_TITLE, RULE_INTRO, RULE_SECTION, TAXONOMY
from ..session import materialise
from .skew import among, number_rows
from .stories import in_taxonomy, keyword_category


def taxonomy_position(category: Column) -> Column:
    return F.array_position(F.array(*[F.lit(c) for c in TAXONOMY]), category).cast("int")


def index_items(items: DataFrame, order: list, within: str = "digest_date", name: str = "idx") -> DataFrame:
    """0-based position of each story in its digest, without one task per digest."""
    return number_rows(items, [within], order, name)


def slots(layouts: DataFrame, key: str = "digest_date") -> DataFrame:
    """Nested layouts -> one row per proposed slot; empty sections keep one row.

    (key, cat_pos, category, sub_pos, subcategory, intro, slot_pos, item_id)
    """
    categories = layouts.select(key, F.posexplode("categories").alias("cat_pos", "c"))
    subs = categories.select(
        key, "cat_pos", "c.category_name", F.posexplode_outer("c.subcategories").alias("sub_pos", "s")
    )
    return subs.select(
        key, "cat_pos", F.col("category_name").alias("category"), "sub_pos",
        F.col("s.subcategory_name").alias("subcategory"), F.col("s.intro_text").alias("intro"),
        F.posexplode_outer("s.item_ids").alias("slot_pos", "item_id"),
    )


def _resolved(items: DataFrame, proposed: DataFrame, config: DigestConfig, key: str) -> DataFrame:
    """Slots within the limit with the ``idx`` they ask for; negative ids count from the end."""
    sizes = items.groupBy(key).agg(F.count("*").alias("_n"))
    taken = proposed.where(F.col("slot_pos") < config.max_items_per_category)
    from_end = F.when(F.col("item_id") < 0, F.col("_n") + F.col("item_id")).otherwise(F.col("item_id"))
    return taken.join(sizes, key).withColumn("idx", from_end).drop("_n", "item_id")


def curate(items: DataFrame, proposed: DataFrame, config: DigestConfig = DigestConfig(), key: str = "digest_date") -> DataFrame:
    """Stories in the slots of an externally proposed layout.

    ``proposed`` has the columns of :func:`slots`; ``items`` is numbered by
    ``idx`` in its digest. The first ``max_items_per_category`` ids of a
    subcategory count before they are checked, so unknown ids use up slots.
    """
    fields = items.withColumn("title", escape_html(F.col("title"))).withColumn("summary", escape_html(F.col("summary")))
    wanted = materialise(_resolved(items, proposed, config, key), "wanted")
    filled = wanted.join(among(fields, wanted, [key, "idx"]), [key, "idx"])
    return filled.withColumn("intro", apply_tag_policy(F.col("intro")))


def lost_slots(items: DataFrame, proposed: DataFrame, config: DigestConfig = DigestConfig(), key: str = "digest_date") -> DataFrame:
    """Per digest, how many slots within the limit name no story."""
    unknown = _resolved(items, proposed, config, key).join(items.select(key, "idx"), [key, "idx"], "left_anti")
    return unknown.groupBy(key).agg(F.count("*").alias("n_lost"))


def with_empty_sections(curated: DataFrame, proposed: DataFrame, key: str = "digest_date") -> DataFrame:
    """Add one row without a story for every proposed section that got none."""
    place = [key, "cat_pos", "sub_pos"]
    sections = proposed.select(*place, "category", "subcategory", apply_tag_policy(F.col("intro")).alias("intro")).distinct()
    used = curated.select(*[F.col(c).alias("_" + c) for c in place]).distinct()
    same = F.lit(True)
    for c in place:
        same = same & F.col(c).eqNullSafe(F.col("_" + c))
    return curated.unionByName(sections.join(used, same, "left_anti"), allowMissingColumns=True)


def unplaced(items: DataFrame, curated: DataFrame, key: str = "digest_date") -> DataFrame:
    """Stories that no slot refers to."""
    return items.join(curated.select(key, "idx").distinct(), [key, "idx"], "left_anti")


def digest_heads(layouts: DataFrame, as_of: datetime, config: DigestConfig = DigestConfig(), key: str = "digest_date") -> DataFrame:
    """Title, summary and time stamps of each digest."""
    now = F.lit(as_of)
    summary = F.when(F.lit(config.enable_executive_summary), apply_tag_policy(F.col("executive_summary"))).otherwise("")
    return layouts.select(
        key,
        fill_title(F.col("newsletter_title"), now).alias("title"),
        F.coalesce(summary, F.lit("")).alias("executive_summary"),
        *digest_stamps(now),
        F.lit(config.theme).alias("theme"),
    )


def rule_sections(items: DataFrame) -> DataFrame:
    """Keyword sections: every story in one category, one subcategory each, no limit."""
    known = F.col("email_primary_category") if "email_primary_category" in items.columns else None
    escaped = items.withColumn(
        "category", keyword_category(F.col("title"), F.col("summary"), known)
    ).withColumn("title", escape_html(F.col("title"))).withColumn("summary", escape_html(F.col("summary")))
    used = in_taxonomy(known) if known is not None else F.lit(False)
    if "idx" in items.columns:
        escaped = escaped.withColumn("slot_pos", F.col("idx"))
    return (
        escaped.withColumn("cat_pos", taxonomy_position(F.col("category")) - 1)
        .withColumn("sub_pos", F.lit(0))
        .withColumn("subcategory", F.lit(RULE_SECTION))
        .withColumn("intro", F.concat(F.lit(RULE_INTRO), F.lower("category"), F.lit(":")))
        .withColumn("by_keyword", ~used)
    )


def rule_title(as_of: Column) -> Column:
    return F.concat(F.lit(DEFAULT_TITLE), F.date_format(as_of, SHORT_DATE))


def with_rule_fallback(curated: DataFrame, items: DataFrame, laid_out: DataFrame, config: DigestConfig = DigestConfig(), key: str = "digest_date") -> DataFrame:
    """Keyword sections for the digests that got no layout, curated slots for the rest."""
    missing = items.join(laid_out.select(key).distinct(), key, "left_anti")
    if not config.fallback_to_keywords:
        if not missing.isEmpty():
            raise DigestError("some digests have no layout and the keyword fallback is off")
        return curated
    return curated.unionByName(rule_sections(missing), allowMissingColumns=True)


def section_top(items: DataFrame, section: list[str], order: list[Column], k: int = 10) -> DataFrame:
    """Best ``k`` stories per section; each task keeps ``k`` before the shuffle."""
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy(*section).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def digest_metrics(
    curated: DataFrame, items: DataFrame, laid_out: DataFrame, key: str = "digest_date"
) -> tuple[DataFrame, DataFrame]:
    """(stories per digest and category name, totals per digest).

    A category name used twice reports its last section, while the total counts
    every section. All stories of a digest count for the path it took: proposed
    layout (``laid_out`` lists those digests) or keyword rules.
    """
    sections = curated.groupBy(key, "cat_pos", "category").agg(F.count("slot_pos").alias("n"))
    by_name = sections.groupBy(key, "category").agg(F.max_by("n", "cat_pos").alias("n_stories"))
    placed = sections.groupBy(key).agg(F.sum("n").alias("total_stories"), F.count("*").alias("n_sections"))
    path = laid_out.select(key).distinct().withColumn("_laid_out", F.lit(True))
    sizes = items.groupBy(key).agg(F.count("*").alias("_n")).join(path, key, "left")
    by_layout = F.coalesce("_laid_out", F.lit(False))
    totals = sizes.join(placed, key, "left").select(
        key,
        F.coalesce("total_stories", F.lit(0)).alias("total_stories"),
        F.coalesce("n_sections", F.lit(0)).alias("n_sections"),
        F.when(by_layout, F.col("_n")).otherwise(0).alias("ai_categorized_count"),
        F.when(by_layout, F.lit(0)).otherwise(F.col("_n")).alias("fallback_categorized_count"),
    )
    return by_name, totals


def violations(layouts: DataFrame, key: str = "digest_date") -> DataFrame:
    """(digest, rule, n): parts a digest must have but lacks, checked level by level."""
    categories = F.coalesce("categories", F.array().cast(layouts.schema["categories"].dataType))
    subs = F.flatten(F.transform(categories, lambda c: F.coalesce(c["subcategories"], F.slice(F.col("_no_subs"), 1, 0))))
    sub_type = layouts.schema["categories"].dataType.elementType["subcategories"].dataType
    checked = layouts.withColumn("_no_subs", F.array().cast(sub_type)).select(
        key,
        F.col("categories").isNull().cast("long").alias("categories_missing"),
        F.size(F.filter(categories, lambda c: c["category_name"].isNull())).cast("long").alias("name_missing"),
        F.size(F.filter(categories, lambda c: c["subcategories"].isNull())).cast("long").alias("subcategories_missing"),
        F.size(F.filter(subs, lambda s: s["item_ids"].isNull())).cast("long").alias("items_missing"),
    )
    long = checked.unpivot(
        key, ["categories_missing", "name_missing", "subcategories_missing", "items_missing"], "rule", "n"
    )
    return long.where("n > 0")


def require_valid(layouts: DataFrame, key: str = "digest_date") -> DataFrame:
    if not violations(layouts, key).isEmpty():
        raise DigestError("the digest layout lacks required parts")
    return layouts

"""From news messages to story items placed into categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.bind import bind
from ..functions.text import escape_html
from ..schemas import CATCH_ALL, FALLBACK_POINT, FALLBACK_TOPIC, KEYWORD_RULES, TAXONOMY

KEY_POINTS = 5
BOILERPLATE = r"(?i)unsubscribe|privacy policy|view in (your )?browser|all rights reserved"

# Columns an item inherits from its message.
PROVENANCE = (
    ("subject", "source_email_subject"),
    ("sender", "source_email_sender"),
    ("date", "source_email_date"),
    ("account", "source_account"),
    ("message_id", "original_email_id"),
    ("primary_category", "email_primary_category"),
    ("secondary_categories", "email_secondary_categories"),
    ("confidence", "email_classification_confidence"),
    ("reason", "email_classification_reason"),
)


def provenance(df: DataFrame) -> list[Column]:
    return [F.col(have).alias(want) for have, want in PROVENANCE if have in df.columns]


def extract_stories(messages: DataFrame) -> DataFrame:
    """Offline default: each body line is one story.

    Blank lines and boilerplate are ignored. A message
    without stories yields no rows. Provenance travels along with the row, so
    there is neither a join nor a shuffle.
    """
    lines = F.filter(
        F.split("body", r"\n"),
        lambda line: line.rlike(r"[^\s\x0b]") & ~line.rlike(BOILERPLATE),
    )
    carried = [c for c in ("received_at",) if c in messages.columns]
    exploded = messages.select("*", F.posexplode(lines).alias("item_pos", "line"))
    sentences = F.split("line", r"\. ")
    urls = F.regexp_extract_all("line", F.lit(r"""(?i)\bhttps?://[^\s"'<>()]+"""), F.lit(0))
    topic = F.col("primary_category") if "primary_category" in messages.columns else F.lit(None).cast("string")
    return exploded.select(
        F.get(sentences, F.lit(0)).alias("title"),
        F.col("line").alias("summary"),
        F.coalesce(topic, F.lit(FALLBACK_TOPIC)).alias("main_topic"),
        F.array_distinct(urls).alias("source_urls"),
        F.slice(sentences, 1, KEY_POINTS).alias("key_points"),
        F.col("item_pos").cast("long").alias("item_pos"),
        *carried,
        *provenance(messages),
    )


def attach_provenance(items: DataFrame, messages: DataFrame, on: Sequence[str] = ("account", "message_id")) -> DataFrame:
    """Provenance for items that arrived separately; equi-join on the message key."""
    on = list(on)
    facts = messages.select(*on, *[c for c in provenance(messages)])
    return items.join(facts, on)


def fallback_items(messages: DataFrame, scored_ok: DataFrame, on: Sequence[str] = ("account", "message_id")) -> DataFrame:
    """One item per message whose extraction failed.

    ``scored_ok`` lists messages that were scored, including those with no
    stories; only messages missing there are failures.
    """
    failed = messages.join(scored_ok.select(*on).distinct(), list(on), "left_anti")
    body = F.coalesce(F.col("body"), F.lit(""))
    return failed.select(
        F.col("subject").alias("title"),
        F.when(F.length(body) > 500, F.concat(F.substring(body, 1, 500), F.lit("..."))).otherwise(body).alias("summary"),
        F.lit(FALLBACK_TOPIC).alias("main_topic"),
        F.array().cast("array<string>").alias("source_urls"),
        F.array(F.lit(FALLBACK_POINT)).alias("key_points"),
        F.lit(0).cast("long").alias("item_pos"),
        *[c for c in ("received_at",) if c in messages.columns],
        *provenance(failed),
    )


def in_taxonomy(c: Column) -> Column:
    return F.coalesce(c.isin(*TAXONOMY), F.lit(False))


def placements(primary: Column, secondary: Column) -> Column:
    """Category slots of one item as ``array<struct<category, is_secondary_category>>``."""

    def slot(category: Column, is_secondary: bool) -> Column:
        return F.struct(category.alias("category"), F.lit(is_secondary).alias("is_secondary_category"))

    extra = F.filter(
        F.coalesce(secondary, F.array().cast("array<string>")),
        lambda c: in_taxonomy(c) & (c != primary),
    )
    return F.when(
        in_taxonomy(primary),
        F.concat(F.array(slot(primary, False)), F.transform(extra, lambda c: slot(c, True))),
    ).otherwise(F.array(slot(F.lit(CATCH_ALL), False)))


def place(items: DataFrame) -> DataFrame:
    """One row per category an item belongs to; a repeated secondary repeats.

    ``placement_no`` counts an item's placements in the same category from 0, so
    that distinct (item, category) pairs are a filter and not a shuffle.
    """
    slots = placements(F.col("email_primary_category"), F.col("email_secondary_categories"))

    def numbered(all_slots: Column) -> Column:
        def earlier(slot: Column, i: Column) -> Column:
            same = F.filter(F.slice(all_slots, F.lit(1), i), lambda s: s["category"] == slot["category"])
            return F.struct(slot["category"].alias("category"), slot["is_secondary_category"].alias("is_secondary_category"),
                            F.size(same).alias("placement_no"))

        return F.transform(all_slots, earlier)

    return items.select("*", F.inline(bind(slots, numbered)))


def placement_summary(placed: DataFrame) -> DataFrame:
    return placed.groupBy("category").agg(
        F.count_if(~F.col("is_secondary_category")).alias("n_primary"),
        F.count_if(F.col("is_secondary_category")).alias("n_secondary"),
        F.count_if(~in_taxonomy(F.col("email_primary_category"))).alias("n_missing"),
    )


def keyword_category(
    title: Column,
    summary: Column,
    known: Column | None = None,
    rules: Sequence[tuple[str, Sequence[str]]] = KEYWORD_RULES,
    word_boundary: bool = False,
) -> Column:
    """Known valid category, else the first category with a keyword hit, else Other.

    Keywords match as substrings of the escaped lower-case fields; pass
    ``word_boundary=True`` to match whole words instead.
    """
    def first_hit(fields: Column) -> Column:
        def hit(keyword: str) -> Column:
            found = F.lit(False)
            for c in (fields["title"], fields["summary"]):
                one = c.rlike(rf"(?U)\b{keyword}\b") if word_boundary else F.contains(c, F.lit(keyword))
                found = found | F.coalesce(one, F.lit(False))
            return found

        choice = None
        for category, keywords in rules:
            matched = F.lit(False)
            for keyword in keywords:
                matched = matched | hit(keyword)
            choice = F.when(matched, category) if choice is None else choice.when(matched, category)
        return choice.otherwise(CATCH_ALL)

    # Both fields are escaped and lower-cased once, not once per keyword.
    both = F.struct(F.lower(escape_html(title)).alias("title"), F.lower(escape_html(summary)).alias("summary"))
    by_keyword = bind(both, first_hit)
    return by_keyword if known is None else F.when(in_taxonomy(known), known).otherwise(by_keyword)


#: Fields of a story that a model is asked for, with what each holds.
STORY_FIELDS = (
    ("title", "text"), ("summary", "text"), ("main_topic", "text"), ("source_urls", "list of text"), ("key_points", "list of text"),
)
BASE_PROMPT = (
    "Below is one mail. List the stories it tells.",
    "Reply in JSON: an object with the list 'items', empty if there are none; every entry has "
    + ", ".join(f"{name} ({kind})" for name, kind in STORY_FIELDS) + ".",
)
#: Category, words that mark it; a caller's own table may hold any other wording.
PROMPT_FOCUS = tuple((category, ", ".join(keywords)) for category, keywords in KEYWORD_RULES)


def prompt_rules(spark: SparkSession) -> DataFrame:
    """One row per keyword rule; Spark knows the size of the local table and broadcasts it."""
    return spark.createDataFrame(list(PROMPT_FOCUS), "category string, focus string")


def route_prompt(messages: DataFrame, rules: DataFrame) -> DataFrame:
    """Instruction text per message: base, the mail's category, and the focus that ``rules`` (category, focus) has for it.

    A null ``is_classified`` flag or false means base instructions only.
    """
    base = "\n".join(BASE_PROMPT)
    topic = F.coalesce("primary_category", F.lit(CATCH_ALL))
    head = F.concat(F.lit("\nThe mail was filed under "), topic, F.lit("."))
    focus = F.concat(F.lit("\nMarks of that category: "), F.col("focus"))
    routed = messages.withColumn("_topic", topic).join(
        rules.withColumnRenamed("category", "_topic"), "_topic", "left"
    )
    extra = F.when(F.col("is_classified"), F.concat(head, F.coalesce(focus, F.lit("")))).otherwise("")
    return routed.select(*messages.columns, F.concat(F.lit(base), F.coalesce(extra, F.lit(""))).alias("instructions"))

"""The judgement steps of a run as calls to a scoring provider: prompts in, checked answers out.

Each function returns a step for :func:`broadsheet.run`. Prompts are bounded, whatever the size of a day. Answers go
through :mod:`.answers` before they are used, and what a step does without a usable answer is stated with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import normalised, truncate
from ..schemas import CONFIDENCES, GROUP_TYPES, TAXONOMY
from ..session import materialise
from .answers import GROUP_ANSWER, GROUPS, ITEM_ANSWER, ITEMS, checked
from .scoring import ScoreProvider, score, validate_classification
from .skew import number_rows
from .stories import fallback_items, prompt_rules, provenance, route_prompt

Step = Callable[[DataFrame], DataFrame]

CLASSIFY_PROMPT = (
    "Does this mail report news? Reply in JSON with is_news (true or false), "
    f"confidence ({', '.join(CONFIDENCES)}), reason (text), primary_category (one of {', '.join(TAXONOMY)}, or null), "
    "secondary_categories (a list of those) and topic_category (text or null)."
)
GROUP_PROMPT = (
    "Each line below is one story as JSON. Find the stories that report the same event. Reply in JSON with a list 'groups'; "
    f"every entry has type ({', '.join(GROUP_TYPES)}), item_ids, group_title and group_summary."
)
#: Stories in one grouping prompt, and characters of one of their fields.
BLOCK_ITEMS, FIELD_CHARS = 40, 2000
#: Places a block's groups can take in the order of all proposals, and blocks of one ordering.
_IN_BLOCK, _BLOCKS = 1 << 16, 1 << 24


def _mail_text(body: Column) -> Column:
    return F.concat(F.lit("\n\nSubject: "), F.coalesce("subject", F.lit("")), F.lit("\nFrom: "), F.coalesce("sender", F.lit("")), F.lit("\n\n"), body)


def classify_with(provider: ScoreProvider, store_path: str, tasks: int | None = None) -> Step:
    """Classification by a model, which sees a long body up to the input bound; a mail without a usable answer is no news."""
    def step(messages: DataFrame) -> DataFrame:
        prompts = messages.withColumn("prompt", F.concat(F.lit(CLASSIFY_PROMPT), _mail_text(truncate(F.col("body")))))
        judged = score(prompts, provider, store_path, tasks).withColumn("_c", validate_classification(F.col("response")))
        fields = ("is_news", "confidence", "reason", "primary_category", "secondary_categories")
        return judged.select(*messages.columns, *[F.col("_c")[f].alias(f) for f in fields])

    return step


def extract_with(provider: ScoreProvider, store_path: str, tasks: int | None = None, rules: DataFrame | None = None) -> Step:
    """Extraction by a model, which sees the whole body; a mail without a usable answer becomes one item of its own.

    A good answer without items is a mail without stories.
    """
    def step(messages: DataFrame) -> DataFrame:
        judged = "primary_category" in messages.columns
        asked = messages.withColumn("is_classified", F.lit(judged))
        if not judged:
            asked = asked.withColumn("primary_category", F.lit(None).cast("string"))
        routed = route_prompt(asked, rules if rules is not None else prompt_rules(messages.sparkSession))
        prompts = routed.withColumn("prompt", F.concat("instructions", _mail_text(F.coalesce("body", F.lit("")))))
        told = materialise(checked(score(prompts, provider, store_path, tasks), ITEMS, ITEM_ANSWER), "told")
        good = told.where("answer IS NOT NULL")
        item = F.posexplode("answer.items").alias("item_pos", "item")
        carried = [c for c in ("received_at",) if c in messages.columns]
        items = good.select("*", item).select(
            "item.title", "item.summary", "item.main_topic", "item.source_urls", "item.key_points",
            F.col("item_pos").cast("long").alias("item_pos"), *carried, *provenance(messages))
        return items.unionByName(fallback_items(told.where("answer IS NULL").select(messages.columns), good.limit(0)))

    return step


def canopies(placed: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(category, ordering, block, n, item_id, title, summary, main_topic): blocks of at most ``block_items`` similar stories.

    The stories of a category are put in order twice, by their normalised title and by the title's words in
    alphabetical order, and each order is cut into blocks. So every story is in two blocks, beside those with
    nearly the same title in the one and those with the same words in the other.
    """
    stories = materialise(
        placed.where("placement_no = 0").select("category", "item_id", "title", "summary", "main_topic", normalised(F.coalesce("title", F.lit(""))).alias("_title")),
        "canopy-items")
    by_words = F.array_join(F.array_sort(F.split("_title", " ")), " ")
    parts = []
    for ordering, key in enumerate((F.col("_title"), by_words)):
        numbered = number_rows(stories.select("category", "item_id", key.alias("_key")), ["category"], ["_key", "item_id"], "_n")
        parts.append(numbered.select(
            "category", F.lit(ordering).alias("ordering"), F.floor(F.col("_n") / block_items).alias("block"), (F.col("_n") % block_items).alias("n"), "item_id"))
    return parts[0].unionByName(parts[1]).join(stories.drop("_title"), ["category", "item_id"])


def group_with(provider: ScoreProvider, store_path: str, tasks: int | None = None, block_items: int = BLOCK_ITEMS) -> Step:
    """Grouping by a model, a bounded block of similar stories at a time: placed items to proposed groups.

    (category, group_pos, item_pos, item_id, type, group_title, group_summary); proposals of different blocks may overlap. An answer that is
    not of the format, has a group without stories or names a story that its block does not hold proposes nothing.
    """
    def step(placed: DataFrame) -> DataFrame:
        cut = lambda c: truncate(F.col(c), FIELD_CHARS).alias(c)
        line = F.to_json(F.struct(F.col("item_id").alias("id"), cut("title"), cut("summary"), cut("main_topic")))
        key = ["category", "ordering", "block"]
        blocks = canopies(placed, block_items).groupBy(*key).agg(
            F.array_sort(F.collect_list(F.struct("n", "item_id", line.alias("line")))).alias("rows"))
        prompts = blocks.select(
            *key, F.transform("rows", lambda r: r["item_id"]).alias("held"),
            F.concat(F.lit(GROUP_PROMPT + "\n\n"), F.array_join(F.transform("rows", lambda r: r["line"]), "\n")).alias("prompt"))
        answers = checked(score(prompts, provider, store_path, tasks), GROUPS, GROUP_ANSWER)
        groups = F.col("answer.groups")
        named = F.flatten(F.transform(groups, lambda g: g["item_ids"]))
        sound = (F.size(F.array_except(named, F.col("held"))) == 0) & ~F.exists(groups, lambda g: F.size(g["item_ids"]) == 0)
        proposed = answers.where(sound).select(*key, F.posexplode("answer.groups").alias("pos", "g"))
        place = ((F.col("ordering") * F.lit(_BLOCKS).cast("long") + F.col("block")) * _IN_BLOCK + F.col("pos")).alias("group_pos")
        return proposed.select(
            "category", place, F.posexplode("g.item_ids").alias("item_pos", "item_id"), "g.type", "g.group_title", "g.group_summary")

    return step

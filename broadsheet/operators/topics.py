"""What stories are about: themes inside a section, terms that spread, topics that change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import RULE_INTRO, RULE_SECTION, TAXONOMY
from ..session import materialise
from .digest import taxonomy_position
from .similarity import words
from .skew import number_rows
from .stories import keyword_category

#: Shorter words say little, and numbers less.
LEAST_LETTERS = 4
SECTION = ("digest_date", "category")


def terms(text: Column) -> Column:
    """Distinct words of at least ``LEAST_LETTERS`` letters and nothing else, lower case, in order of appearance."""
    return F.array_distinct(F.filter(words(text), lambda w: (F.length(w) >= LEAST_LETTERS) & ~w.rlike(r"\p{N}")))


def _weight(inside: Column, everywhere: Column, size: Column) -> Column:
    """Class-based tf-idf: how often a term stands inside a class, against how common it is altogether."""
    return inside * F.log(1 + size / everywhere)


def section_terms(stories: DataFrame, within: tuple[str, ...] = SECTION, outer: str = "digest_date") -> DataFrame:
    """(*within, term, n_inside, n_everywhere, weight): terms of the sections of each ``outer``.

    ``stories`` has ``within``, title and summary. A section's weight for a term is the number of its stories with
    it, times the logarithm of one plus the mean number of terms in a section over the number of stories with it anywhere.
    """
    text = F.concat_ws(" ", "title", "summary")
    inside = stories.select(*within, F.explode(terms(text)).alias("term")).groupBy(*within, "term").agg(F.count("*").alias("n_inside"))
    inside = materialise(inside, "section-terms")
    everywhere = inside.groupBy(outer, "term").agg(F.sum("n_inside").alias("n_everywhere"))
    sections = inside.groupBy(*within).agg(F.sum("n_inside").alias("_n")).groupBy(outer).agg(F.avg("_n").alias("_size"))
    joined = inside.join(everywhere, [outer, "term"]).join(sections, outer)
    return joined.select(*within, "term", "n_inside", "n_everywhere", _weight(F.col("n_inside"), F.col("n_everywhere"), F.col("_size")).alias("weight"))


def _top(ranked: DataFrame, within: list[str], weight: str, term: str, k: int) -> DataFrame:
    order = Window.partitionBy(*within).orderBy(F.desc(weight), F.asc(term))
    return ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cluster_sections(stories: DataFrame, themes: int = 6, least: int = 2, name_terms: int = 2) -> DataFrame:
    """``stories`` (digest_date, category, idx, title, summary) with theme, subcategory and sub_pos.

    A section's themes are its ``themes`` heaviest terms that at least ``least`` of its stories have. A story
    belongs to the heaviest theme among its terms. Every cluster is then a class of its own, named by its ``name_terms`` heaviest
    terms against the section's other clusters; what has no theme is called as the section of the keyword rules. Larger
    clusters come first, the rest last. Equal weights go by the alphabet, so the same stories give the same sections.
    """
    section = list(SECTION)
    chosen = _top(section_terms(stories).where(F.col("n_inside") >= least), section, "weight", "term", themes)
    # At most ``themes`` rows per section, which every story of the section is held against.
    by_section = chosen.groupBy(*section).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_themes"))
    held = stories.join(F.broadcast(by_section), section, "left")
    own = F.filter("_themes", lambda t: F.array_contains(terms(F.concat_ws(" ", "title", "summary")), t["term"]))
    clustered = materialise(held.withColumn("theme", F.get(own, F.lit(0))["term"]).drop("_themes"), "clustered")

    cluster = [*section, "theme"]
    inner = clustered.where("theme IS NOT NULL").withColumn("_section", F.struct(*section))
    named = _top(section_terms(inner, ("_section", "theme"), "_section"), ["_section", "theme"], "weight", "term", name_terms)
    names = named.groupBy("_section", "theme").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_names")).select(
        *[F.col("_section")[c].alias(c) for c in section], "theme",
        F.array_join(F.transform("_names", lambda x: F.initcap(x["term"])), " / ").alias("subcategory"))
    # A section has at most one cluster per theme and the rest.
    sizes = clustered.groupBy(*cluster).agg(F.count("*").alias("_n"))
    order = Window.partitionBy(*section).orderBy(F.col("theme").isNull(), F.desc("_n"), F.asc("theme"))
    heads = sizes.join(names, cluster, "left").select(
        *section, F.coalesce("theme", F.lit("")).alias("_theme"), F.coalesce("subcategory", F.lit(RULE_SECTION)).alias("subcategory"),
        (F.row_number().over(order) - 1).alias("sub_pos"))
    return clustered.withColumn("_theme", F.coalesce("theme", F.lit(""))).join(F.broadcast(heads), [*section, "_theme"]).drop("_theme")


def cluster_layout(title: str = "", max_items: int = 10, **settings) -> Callable[[DataFrame], DataFrame]:
    """A ``layout`` for :func:`broadsheet.run`: keyword categories, each with the clusters of its stories.

    A subcategory names its first ``max_items`` stories, as more are not shown.
    """
    def step(stories: DataFrame) -> DataFrame:
        known = F.col("email_primary_category") if "email_primary_category" in stories.columns else None
        placed = stories.select("digest_date", "idx", "title", "summary", keyword_category(F.col("title"), F.col("summary"), known).alias("category"))
        sections = cluster_sections(placed, **settings)
        place = ["digest_date", "category", "sub_pos", "subcategory"]
        numbered = number_rows(sections.select(*place, "idx"), place, ["idx"], "_slot").where(F.col("_slot") < max_items)
        ids = F.transform(F.array_sort(F.collect_list("idx")), lambda i: i.cast("long"))
        subs = numbered.groupBy(*place).agg(ids.alias("item_ids"))
        one = F.struct("sub_pos", F.struct(
            F.col("subcategory").alias("subcategory_name"), "item_ids", F.concat(F.lit(RULE_INTRO), F.lower("subcategory"), F.lit(":")).alias("intro_text")).alias("s"))
        categories = subs.groupBy("digest_date", "category").agg(F.array_sort(F.collect_list(one)).alias("_subs")).select(
            "digest_date", F.struct(taxonomy_position(F.col("category")).alias("_at"), F.struct(
                F.col("category").alias("category_name"), F.transform("_subs", lambda x: x["s"]).alias("subcategories")).alias("c")).alias("_c"))
        return categories.groupBy("digest_date").agg(F.array_sort(F.collect_list("_c")).alias("_cs")).select(
            "digest_date", F.lit(title).alias("newsletter_title"), F.lit("").alias("executive_summary"),
            F.transform("_cs", lambda x: x["c"]).alias("categories"))

    return step


# ---- terms that spread -----------------------------------------------------

def daily_senders(items: DataFrame, day: str = "digest_date", sender: str = "source_email_sender", lg_k: int | None = None) -> DataFrame:
    """(term, day, senders): who used a term on a day, as a mergeable sketch, or with ``lg_k`` None as distinct rows (term, day, sender).

    A sketch of 2^lg_k slots has a relative error of about 1.04 / sqrt(2^lg_k), and any number of days merges into one of the same size.
    """
    used = items.select(F.explode(terms(F.concat_ws(" ", "title", "summary"))).alias("term"), F.col(day).alias("day"), F.col(sender).alias("sender"))
    if lg_k is None:
        return used.distinct()
    return used.groupBy("term", "day").agg(F.hll_sketch_agg("sender", lg_k).alias("senders"))


def trending(daily: DataFrame, as_of, recent_days: int = 1, base_days: int = 6, least: int = 2) -> DataFrame:
    """(term, n_recent, n_base, burst): terms by how many more senders use them than before.

    ``daily`` is from :func:`daily_senders`, exact or sketched. The recent window is the ``recent_days`` up to and with ``as_of``, the base
    the ``base_days`` before it; ``burst`` is senders a day in the first over one plus senders a day in the second. Terms with
    fewer than ``least`` recent senders are left out.
    """
    back = F.date_diff(F.lit(as_of), F.col("day"))
    recent, base = (back >= 0) & (back < recent_days), (back >= recent_days) & (back < recent_days + base_days)
    if "senders" in daily.columns:
        estimate = lambda inside: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(F.when(inside, F.col("senders")))), F.lit(0))
        counted = daily.where(recent | base).groupBy("term").agg(estimate(recent).alias("n_recent"), estimate(base).alias("n_base"))
    else:
        # Once per term, sender and window, so that no task counts a frequent term's senders alone.
        once = daily.where(recent | base).groupBy("term", "sender").agg(F.max(recent).alias("_r"), F.max(base).alias("_b"))
        counted = once.groupBy("term").agg(F.count_if("_r").alias("n_recent"), F.count_if("_b").alias("n_base"))
    burst = (F.col("n_recent") / recent_days) / (1 + F.col("n_base") / base_days)
    return counted.where(F.col("n_recent") >= least).withColumn("burst", burst)


# ---- topics over time ------------------------------------------------------

def topic_series(items: DataFrame, topic: str, day: str) -> DataFrame:
    """(topic, day, n): stories per topic on every day from the first to the last of the table, days without any included."""
    counted = items.where(F.col(topic).isNotNull() & F.col(day).isNotNull()).groupBy(F.col(topic).alias("topic"), F.col(day).alias("day")).agg(F.count("*").alias("n"))
    counted = materialise(counted, "topic-days")
    first, last = counted.agg(F.min("day"), F.max("day")).first()
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    every = counted.select("topic").distinct().select("topic", F.explode(days).alias("day"))
    return every.join(counted, ["topic", "day"], "left").select("topic", "day", F.coalesce("n", F.lit(0)).alias("n"))


def change_points(series: DataFrame, history: int = 7, drift: float = 1.0, threshold: float = 5.0) -> DataFrame:
    """``series`` with its running median, how far it has drifted from it, and whether it changed there.

    The median is over the ``history`` days before. ``up`` adds up what a day has above it beyond ``drift``, never below 0, ``down`` what it has
    below; ``change`` is 1 or -1 on the day that the sum passes ``threshold``. A topic's days are one window: they grow with
    time and not with mail.
    """
    before = Window.partitionBy("topic").orderBy("day").rowsBetween(-history, -1)
    so_far = Window.partitionBy("topic").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    ordered = Window.partitionBy("topic").orderBy("day")
    # The list holds ``history`` days at most.
    out = series.withColumn("_days", F.array_sort(F.collect_list("n").over(before)))
    size = F.size("_days")
    middle = (F.get("_days", F.floor((size - 1) / 2).cast("int")) + F.get("_days", F.floor(size / 2).cast("int"))) / 2
    out = out.withColumn("median", F.when(size > 0, middle)).drop("_days")
    gap = F.coalesce(F.col("n") - F.col("median"), F.lit(0.0))
    for name, step in (("up", gap - drift), ("down", -gap - drift)):
        # A sum that starts again at 0 whenever it would fall below is the plain sum above its least value so far.
        out = out.withColumn("_sum", F.sum(step).over(so_far))
        out = out.withColumn(name, F.col("_sum") - F.least(F.min("_sum").over(so_far), F.lit(0.0))).drop("_sum")
        passed = (F.col(name) > threshold) & (F.coalesce(F.lag(name).over(ordered), F.lit(0.0)) <= threshold)
        out = out.withColumn(f"_{name}", passed.cast("int"))
    return out.withColumn("change", F.col("_up") - F.col("_down")).drop("_up", "_down")

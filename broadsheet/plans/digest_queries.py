"""Queries over digest assembly, reports, archive and delivery, with their SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import fingerprint
from ..operators import digest as D, render, reports
from ..operators.grouping import deduplicate
from ..operators.skew import among, join_skewed, number_rows
from ..operators.scoring import news_only
from ..operators.stories import extract_stories, in_taxonomy, place
from ..schemas import CATCH_ALL, LAYOUT, TAXONOMY
from ..session import materialise, metered, new_folder
from ..sources import archive
from . import views as V
from .story_queries import TAXONOMY_SQL, keyword_sql, merged_stories
from .text_queries import _ESCAPED, S as TEXT_SQL, nasty_pages
from .views import sql, table

Q: dict = {}
S: dict[str, str] = {}

CLOCK = datetime(2024, 1, 30, 8, 0, 0)


def query(name: str, oracle: str | None = None):
    def add(fn):
        Q[name] = fn
        if oracle:
            S[name] = oracle
        return fn

    return add


# ---- proposed sections ---------------------------------------------------

def proposed_slots(spark, dated: DataFrame) -> DataFrame:
    """A layout over numbered items: by category and idx % 3, with two bad ids.

    Slot 0 asks for the last item (-1), slot 1 for an id that does not exist. The
    third Technology subcategory is a section of its own under the same name.
    """
    primary = F.col("email_primary_category")
    category = F.when(in_taxonomy(primary), primary).otherwise(CATCH_ALL)
    sub = (F.col("idx") % 3).cast("int")
    second = (category == "Technology") & (sub == 2)
    base = dated.select(
        "digest_date", "idx", category.alias("category"),
        F.when(second, 9).otherwise(D.taxonomy_position(category) - 1).alias("cat_pos"),
        F.when(second, 0).otherwise(sub).alias("sub_pos"),
        F.concat(F.lit("sub"), sub.cast("string")).alias("subcategory"),
    )
    section = ["digest_date", "cat_pos", "category", "sub_pos", "subcategory"]
    own = number_rows(base, section, ["idx"], "_n").select(
        *section, (F.col("_n") + 2).alias("slot_pos"), F.col("idx").alias("item_id"))
    first = base.select(*section).distinct()
    bad = first.withColumn("slot_pos", F.lit(0).cast("long")).withColumn("item_id", F.lit(-1).cast("long")).unionByName(
        first.withColumn("slot_pos", F.lit(1).cast("long")).withColumn("item_id", F.lit(1 << 40)))
    return materialise(own.unionByName(bad), "slots").withColumn(
        "intro", F.concat(F.lit("<b onclick='x'>About</b> <u>"), F.col("subcategory"), F.lit("</u>")))


_CURATED = f"""
WITH base AS (SELECT digest_date, idx, CASE WHEN email_primary_category IN {TAXONOMY_SQL} THEN email_primary_category ELSE 'Other' END AS category,
                idx % 3 AS sub FROM dated_items),
 section AS (SELECT *, CASE WHEN category = 'Technology' AND sub = 2 THEN 9
               ELSE list_position(['AI','Economy','Stocks','Private Equity','Politics','Technology','Other'], category) - 1 END AS cat_pos,
               CASE WHEN category = 'Technology' AND sub = 2 THEN 0 ELSE sub END AS sub_pos FROM base),
 proposed AS (SELECT digest_date, cat_pos, category, sub_pos, 'sub' || sub AS subcategory,
                row_number() OVER (PARTITION BY digest_date, cat_pos, sub_pos ORDER BY idx) + 1 AS slot_pos, idx AS item_id FROM section
   UNION ALL SELECT DISTINCT digest_date, cat_pos, category, sub_pos, 'sub' || sub, 0, -1 FROM section),
 sizes AS (SELECT digest_date, count(*) AS n FROM dated_items GROUP BY ALL),
 curated AS (SELECT p.digest_date, p.cat_pos, p.category, p.sub_pos, p.subcategory, p.slot_pos, i.*  EXCLUDE (digest_date),
               '<b>About</b> ' || p.subcategory AS intro
   FROM (SELECT p.*, CASE WHEN item_id < 0 THEN n + item_id ELSE item_id END AS want FROM proposed p JOIN sizes USING (digest_date) WHERE slot_pos < 10) p
   JOIN dated_items i ON i.digest_date = p.digest_date AND i.idx = p.want)
"""


def curated_view(spark, d):
    dated = V.dated_items(spark, d)  # written once where it is numbered
    proposed = proposed_slots(spark, dated)
    return dated, proposed, D.curate(dated, proposed)


@query("curate_digest", sql(_CURATED + f"""
SELECT digest_date, cat_pos, category, sub_pos, subcategory, slot_pos, item_id, {_ESCAPED.format(c='title')} AS title, intro FROM curated""",
    "dated_items"))
def curate_digest(spark: SparkSession, d: str) -> DataFrame:
    _, _, curated = curated_view(spark, d)
    return curated.select(
        "digest_date", F.col("cat_pos").cast("long").alias("cat_pos"), "category", F.col("sub_pos").cast("long").alias("sub_pos"),
        "subcategory", "slot_pos", "item_id", "title", "intro")


@query("unplaced_items", sql(_CURATED + """
SELECT digest_date, idx, item_id FROM dated_items i WHERE NOT EXISTS (SELECT 1 FROM curated c WHERE c.digest_date = i.digest_date AND c.idx = i.idx)""",
    "dated_items"))
def unplaced_items(spark, d):
    dated, _, curated = curated_view(spark, d)
    return D.unplaced(dated, curated).select("digest_date", "idx", "item_id")


@query("lost_slots", sql(_CURATED + """
SELECT digest_date, count(*) AS n_lost FROM (SELECT DISTINCT digest_date, cat_pos, sub_pos FROM section) GROUP BY ALL""", "dated_items"))
def lost_slots(spark, d):
    dated = V.dated_items(spark, d)
    return D.lost_slots(dated, proposed_slots(spark, dated))


@query("digest_metrics", sql(_CURATED + """,
 sections AS (SELECT digest_date, cat_pos, category, count(*) AS n FROM curated GROUP BY ALL),
 by_name AS (SELECT digest_date, category, arg_max(n, cat_pos) AS n_stories FROM sections GROUP BY ALL),
 totals AS (SELECT digest_date, sum(n)::BIGINT AS total_stories FROM sections GROUP BY ALL)
SELECT digest_date, category, n_stories, total_stories, n AS ai_categorized_count, 0 AS fallback_categorized_count
FROM by_name JOIN totals USING (digest_date) JOIN sizes USING (digest_date)""", "dated_items"))
def digest_metrics(spark, d):
    dated, proposed, curated = curated_view(spark, d)
    by_name, totals = D.digest_metrics(curated, dated, proposed)
    return by_name.join(totals.drop("n_sections"), "digest_date")


@query("rule_sections", sql(f"""
SELECT digest_date, item_id, category, list_position(['AI','Economy','Stocks','Private Equity','Politics','Technology','Other'], category) - 1 AS cat_pos,
       'Top Stories' AS subcategory, 'Latest developments in ' || lower(category) || ':' AS intro, by_keyword
FROM (SELECT CAST(received_at AS DATE) AS digest_date, item_id, {keyword_sql('title', 'summary', 'email_primary_category')} AS category,
        email_primary_category IS NULL OR email_primary_category NOT IN {TAXONOMY_SQL} AS by_keyword FROM items)""", "items"))
def rule_sections(spark, d):
    dated = V.items(spark, d).withColumn("digest_date", F.to_date("received_at"))
    return D.rule_sections(dated).select(
        "digest_date", "item_id", "category", F.col("cat_pos").cast("long").alias("cat_pos"), "subcategory", "intro", "by_keyword")


@query("section_topk", sql(r"""
SELECT * FROM (
  SELECT category, first_id, n_stories, row_number() OVER (PARTITION BY category ORDER BY n_stories DESC, first_id) AS rank FROM (
    SELECT category, min(item_id) AS first_id, count(*) AS n_stories FROM placed
    GROUP BY category, sha256(trim(regexp_replace(lower(summary), '\s+', ' ', 'g')))))
WHERE rank <= 10""", "placed"))
def section_topk(spark, d):
    told = V.placed(spark, d).groupBy("category", fingerprint(F.col("summary")).alias("print")).agg(
        F.min("item_id").alias("first_id"), F.count("*").alias("n_stories")).drop("print")
    return D.section_top(told, ["category"], [F.desc("n_stories"), F.asc("first_id")], k=10)


def layouts(spark, d):
    """One nested layout per message, with each required part missing somewhere."""
    doc_id = F.col("doc_id")

    def missing(every, value):
        return F.when(doc_id % every != 0, value)

    sub = F.struct(
        F.lit("Highlights").alias("subcategory_name"), missing(4, F.array(doc_id, doc_id + 1)).alias("item_ids"),
        F.lit("intro").alias("intro_text"))
    category = F.struct(missing(3, F.col("lang")).alias("category_name"), missing(5, F.array(sub, sub)).alias("subcategories"))
    return table(spark, d, "documents").select(
        doc_id.alias("digest_id"),
        missing(7, F.array(category, category)).cast(LAYOUT["categories"].dataType).alias("categories"))


@query("structure_violations", """
SELECT digest_id, rule, n FROM (
  SELECT doc_id AS digest_id, unnest([
    {'rule': 'categories_missing', 'n': (CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END)::BIGINT},
    {'rule': 'name_missing', 'n': CASE WHEN doc_id % 7 <> 0 AND doc_id % 3 = 0 THEN 2 ELSE 0 END},
    {'rule': 'subcategories_missing', 'n': CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 = 0 THEN 2 ELSE 0 END},
    {'rule': 'items_missing', 'n': CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 AND doc_id % 4 = 0 THEN 4 ELSE 0 END}], recursive := true)
  FROM documents) WHERE n > 0""")
def structure_violations(spark, d):
    return D.violations(layouts(spark, d), key="digest_id")


@query("digest_heads", f"""
SELECT k.page_id, 'Tuesday, January 30, 2024 page ' || k.page_id AS title, kept AS executive_summary,
       'Tuesday, January 30, 2024 08:00:00' AS generated_at, 'light' AS theme
FROM ({TEXT_SQL['tag_policy_strip']}) k""")
def digest_heads(spark, d):
    proposed = nasty_pages(spark, d).select(
        "page_id", F.concat(F.lit("[Date] page "), F.col("page_id").cast("string")).alias("newsletter_title"),
        F.col("html").alias("executive_summary"))
    heads = D.digest_heads(proposed, CLOCK, key="page_id")
    return heads.select("page_id", "title", "executive_summary", "generated_at", "theme")


def _source_sql(c: str) -> str:
    return _ESCAPED.format(c=c)


@query("render_digest", sql(_CURATED + f""",
 heads AS (SELECT DISTINCT digest_date FROM dated_items),
 cats AS (SELECT DISTINCT digest_date, cat_pos, category FROM curated),
 subs AS (SELECT DISTINCT digest_date, cat_pos, sub_pos, subcategory, intro FROM curated)
SELECT digest_date, -1 AS cat_pos, -1 AS sub_pos, -1 AS slot_pos, 0 AS part, 0 AS part_pos,
  '<!DOCTYPE html><html><body><header><h1>Daily News Digest - ' || strftime(digest_date, '%B %d, %Y') || '</h1><p>Tuesday, January 30, 2024</p></header>' AS html FROM heads
UNION ALL SELECT digest_date, 9223372036854775807, -1, -1, 0, 0, '</body></html>' FROM heads
UNION ALL SELECT digest_date, cat_pos, -1, -1, 0, 0, '<section><h2>' || category || '</h2>' FROM cats
UNION ALL SELECT digest_date, cat_pos, 9223372036854775807, -1, 0, 0, '</section>' FROM cats
UNION ALL SELECT digest_date, cat_pos, sub_pos, -1, 0, 0, '<div><h3>' || subcategory || '</h3><p>' || intro || '</p>' FROM subs
UNION ALL SELECT digest_date, cat_pos, sub_pos, 9223372036854775807, 0, 0, '</div>' FROM subs
UNION ALL SELECT digest_date, cat_pos, sub_pos, slot_pos, 0, 0, '<article><h4>' || {_source_sql('title')} || '</h4><p>' || {_source_sql('summary')} || '</p><ul><li>' ||
  array_to_string(list_transform(key_points, lambda k: {_source_sql('k')}), '</li><li>') || '</li></ul>' FROM curated
UNION ALL SELECT digest_date, cat_pos, sub_pos, slot_pos, 1, 0, '<footer><ul>' FROM curated
UNION ALL SELECT digest_date, cat_pos, sub_pos, slot_pos, 4, 0, '</ul></footer></article>' FROM curated
UNION ALL SELECT digest_date, cat_pos, sub_pos, slot_pos, 2, 0, '<li>' || {_source_sql('source_email_sender')} ||
  CASE WHEN source_email_subject <> '' THEN ' — ' || {_source_sql('source_email_subject')} ELSE '' END || ' (' || source_account || ') • ' || source_email_date || '</li>' FROM curated
UNION ALL SELECT digest_date, cat_pos, sub_pos, slot_pos, 3, 0, '<li><a href="' || source_urls[1] || '">' || replace(source_urls[1], 'https://', '') || '</a></li>' FROM curated""",
    "dated_items"))
def render_digest(spark, d):
    dated, _, curated = curated_view(spark, d)
    title = D.rule_title(F.col("digest_date").cast("timestamp_ntz"))
    heads = dated.select("digest_date").distinct().select(
        "digest_date", title.alias("title"), F.lit("Tuesday, January 30, 2024").alias("display_date"),
        F.lit("").alias("executive_summary"))
    told = materialise(curated.withColumn("story_key", F.col("item_id")), "curated")
    sources = dated.select(
        F.col("item_id").alias("story_key"), F.lit(0).alias("source_pos"), F.col("source_email_subject").alias("subject"),
        F.col("source_email_sender").alias("sender"), F.col("source_account").alias("account"), F.col("source_email_date").alias("date"))
    urls = dated.select(F.col("item_id").alias("story_key"), F.posexplode("source_urls").alias("url_pos", "url"))
    listed = ["story_key"]
    return render.render(heads, told, among(sources, told, listed), among(urls, told, listed))


# ---- reports -------------------------------------------------------------

@query("classification_summary", sql("""
SELECT 'category' AS kind, primary_category AS name, count(*) AS n FROM classified WHERE is_news AND primary_category IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'confidence', l.level, count(c.message_id) FROM (VALUES ('high'), ('medium'), ('low')) l(level)
LEFT JOIN (SELECT * FROM classified WHERE is_news) c ON c.confidence = l.level GROUP BY ALL""", "classified"))
def classification_summary(spark, d):
    return reports.classification_summary(V.news(spark, d))


def _stages(spark, d) -> tuple[dict[str, int], DataFrame]:
    """Counts of a run's first stages, each gathered while the stage is written."""
    n = F.count(F.lit(1))
    judged, mail = metered(V.classified(spark, d), "classified", n=n, news=F.count_if("is_news"))
    told, items = metered(V.with_ids(extract_stories(news_only(judged))), "news-items", n=n)
    return {
        "accounts": judged.select("account").distinct().count(), "total_emails": mail["n"], "news_emails": mail["news"],
        "news_items_extracted": items["n"],
    }, told


_FUNNEL_SQL = """
SELECT (SELECT count(DISTINCT account) FROM messages) AS accounts, (SELECT count(*) FROM messages) AS total_emails,
  (SELECT count(*) FROM news) AS news_emails, (SELECT count(*) FROM news_items) AS news_items_extracted,
  (SELECT count(DISTINCT (scope, cluster_id)) FROM news_clusters) + (SELECT count(*) FROM news_placed p WHERE NOT EXISTS (
     SELECT 1 FROM news_clusters c WHERE c.scope = p.category AND c.id = p.item_id)) AS after_deduplication,
  (SELECT count(DISTINCT category) FROM news_placed) AS categories, (SELECT count(DISTINCT category) FROM news_placed) AS sent"""


@query("funnel", sql(_FUNNEL_SQL, "messages", "news_clusters", "news_placed", "news_items"))
def funnel(spark, d):
    """Sent is one message to the default address for each category, as there are no recipients."""
    counts, items = _stages(spark, d)
    stories, n = metered(deduplicate(place(items))[0].select("category"), "stories", n=F.count(F.lit(1)))
    digests = stories.distinct().withColumn("title", F.col("category"))
    nobody = spark.createDataFrame([], "category string, recipient string")
    _, sent = metered(archive.outbox(digests, nobody, "editor@example.com"), "outbox", n=F.count(F.lit(1)))
    return reports.funnel(spark, {**counts, "after_deduplication": n["n"], "categories": stories.distinct().count(), "sent": sent["n"]})


@query("run_status", sql(
    f"SELECT status, message FROM (SELECT 'success' AS status, CASE WHEN news_emails = 0 THEN 'No news content found' "
    f"WHEN news_items_extracted = 0 THEN 'No extractable news content' ELSE 'Digest ready' END AS message FROM ("
    f"SELECT (SELECT count(*) FROM news) AS news_emails, (SELECT count(*) FROM news_items) AS news_items_extracted))",
    "news", "news_items"))
def run_status(spark, d):
    counts, _ = _stages(spark, d)
    return reports.run_status(reports.funnel(spark, counts)).select("status", "message")


@query("source_attribution", sql("""
WITH per_story AS (SELECT t.scope, t.cluster_id, i.source_email_sender AS sender, count(*) AS mentions
   FROM item_typed t JOIN items i ON i.item_id = t.id GROUP BY ALL),
 width AS (SELECT scope, cluster_id, count(*) AS n_senders FROM per_story GROUP BY ALL)
SELECT sender, sum(mentions)::BIGINT AS mentions, count(*) AS stories, count(*) FILTER (n_senders > 1) AS shared_stories
FROM per_story JOIN width USING (scope, cluster_id) GROUP BY sender""", "item_typed", "items"))
def source_attribution(spark, d):
    return reports.source_attribution(merged_stories(spark, d).sources, ["category", "group_id"])


@query("stage_progress", """
SELECT event_type, ts, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS done,
       epoch_us(ts) - epoch_us(min(ts) OVER (PARTITION BY event_type)) AS elapsed_us FROM events""")
def stage_progress(spark, d):
    return reports.stage_progress(table(spark, d, "events"), "event_type", "ts", "event_id")


# ---- archive and delivery ------------------------------------------------

@query("archive_roundtrip", sql(
    "SELECT CAST(received_at AS DATE) AS digest_date, count(*) AS n, sum(item_id)::BIGINT AS id_sum FROM items GROUP BY ALL", "items"))
def archive_roundtrip(spark, d):
    """Written twice: the second run replaces its own dates and adds nothing."""
    dated = V.items(spark, d).select("item_id", "title", "summary", F.to_date("received_at").alias("digest_date"))
    path = new_folder(spark, "archive")
    archive.write_archive(dated, path)
    archive.write_archive(dated, path)
    return fitting_sums(spark.read.parquet(path).groupBy("digest_date").agg(
        F.count("*").alias("n"), F.sum(F.col("item_id").cast("decimal(20,0)")).alias("id_sum")), "id_sum")


def fitting_sums(sums: DataFrame, name: str) -> DataFrame:
    """Exact sums in the decimal column ``name`` as bigint, unless one of them is beyond it; then all stay decimals."""
    sums = materialise(sums, "sums")
    short = F.col(name).try_cast("bigint")
    beyond = sums.where(F.col(name).isNotNull() & short.isNull())
    return sums.withColumn(name, short) if beyond.isEmpty() else sums


@query("recipient_outbox", sql("""
WITH digests AS (SELECT DISTINCT category, 'Digest: ' || category AS title FROM placed),
 recipients AS (SELECT c_name AS recipient, CASE c_custkey % 9 WHEN 1 THEN 'Economy' WHEN 2 THEN 'Stocks' WHEN 3 THEN 'Private Equity'
    WHEN 4 THEN 'Politics' WHEN 5 THEN 'Technology' ELSE 'Other' END AS category FROM customer),
 addressed AS (SELECT d.category, title, coalesce(recipient, 'editor@example.com') AS recipient FROM digests d LEFT JOIN recipients r USING (category))
SELECT category, title, message_no, string_agg(recipient, ', ' ORDER BY recipient) AS to_line, count(*) AS n_recipients FROM (
  SELECT *, (row_number() OVER (PARTITION BY category ORDER BY recipient) - 1) // 100 AS message_no FROM addressed) GROUP BY ALL""", "placed"))
def recipient_outbox(spark, d):
    digests = V.placed(spark, d).select("category").distinct().withColumn("title", F.concat(F.lit("Digest: "), F.col("category")))
    position = F.col("c_custkey") % 9
    subscribed = F.when((position >= 1) & (position <= 5), F.get(F.array(*[F.lit(c) for c in TAXONOMY]), position.cast("int")))
    recipients = table(spark, d, "customer").select(
        F.col("c_name").alias("recipient"), F.coalesce(subscribed, F.lit(CATCH_ALL)).alias("category"))
    return archive.outbox(digests, recipients, "editor@example.com").drop("text_part")


# ---- the whole question --------------------------------------------------

@query("top_stories", sql("""
WITH told AS (
  SELECT t.scope AS category, arg_min(title, (received_at, item_id)) AS title, min(group_type) AS group_type, count(*) AS original_count,
         min(item_id) AS first_item_id, min(received_at) AS received_at
  FROM news_typed t JOIN news_items i ON i.item_id = t.id GROUP BY t.scope, t.cluster_id
  UNION ALL
  SELECT category, title, 'unique', 1, item_id, received_at FROM news_placed p
  WHERE NOT EXISTS (SELECT 1 FROM news_clusters c WHERE c.scope = p.category AND c.id = p.item_id)),
 ranked AS (SELECT *, CAST(received_at AS DATE) AS digest_date, row_number() OVER (PARTITION BY CAST(received_at AS DATE), category
              ORDER BY original_count DESC, first_item_id) AS rank FROM (SELECT DISTINCT * FROM told))
SELECT digest_date, category, rank, title, group_type, original_count, first_item_id FROM ranked WHERE rank <= 10""",
    "news_typed", "news_items", "news_placed", "news_clusters"))
def top_stories(spark, d):
    """Top ten stories per day and category from news mail, with duplicates merged."""
    told, _ = deduplicate(place(materialise(V.news_items(spark, d), "news-items")))
    once = told.where(F.coalesce("placement_no", F.lit(0)) == 0)  # a repeated placement is one story
    dated = once.select(
        "category", "title", "group_type", "original_count", "first_item_id", F.to_date("received_at").alias("digest_date"))
    return D.section_top(dated, ["digest_date", "category"], [F.desc("original_count"), F.asc("first_item_id")])

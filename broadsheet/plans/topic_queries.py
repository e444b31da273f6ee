"""Queries over themes, trends and the trust in sources, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import quality, topics
from ..operators.digest import index_items
from ..operators.stories import in_taxonomy
from ..schemas import CATCH_ALL
from . import views as V
from .views import sql, table

Q: dict = {}
S: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        Q[name] = fn
        if oracle:
            S[name] = oracle
        return fn

    return add


def _terms_sql(text: str) -> str:
    return (f"list_distinct(list_filter(string_split_regex(lower({text}), '[^\\p{{L}}\\p{{N}}]+'), "
            f"lambda w: length(w) >= {topics.LEAST_LETTERS} AND NOT regexp_matches(w, '\\p{{N}}')))")


def sectioned(spark, d) -> DataFrame:
    """The day's items in their primary category."""
    category = F.when(in_taxonomy(F.col("email_primary_category")), F.col("email_primary_category")).otherwise(CATCH_ALL)
    told = V.items(spark, d).select(
        F.to_date("received_at").alias("digest_date"), category.alias("category"), "title", "summary", "received_at", "item_id")
    return index_items(told, ["received_at", "item_id"]).select("digest_date", "category", "idx", "title", "summary")


_SECTIONED = f"""
 sectioned AS (SELECT digest_date, idx, CASE WHEN email_primary_category IN {V.TAXONOMY_SQL} THEN email_primary_category ELSE 'Other' END AS category,
   {_terms_sql("title || ' ' || summary")} AS ts FROM dated_items),
 inside AS (SELECT digest_date, category, term, count(*) AS n_inside FROM (SELECT digest_date, category, unnest(ts) AS term FROM sectioned) GROUP BY ALL),
 everywhere AS (SELECT digest_date, term, sum(n_inside)::BIGINT AS n_everywhere FROM inside GROUP BY ALL),
 size AS (SELECT digest_date, avg(n) AS size FROM (SELECT digest_date, category, sum(n_inside) AS n FROM inside GROUP BY ALL) GROUP BY ALL),
 weighed AS (SELECT *, n_inside * ln(1 + size / n_everywhere) AS weight FROM inside JOIN everywhere USING (digest_date, term) JOIN size USING (digest_date))"""


@query("section_terms", sql(f"""WITH {_SECTIONED}
SELECT digest_date, category, term, n_inside, n_everywhere, round(weight, 6) AS weight FROM weighed""", "dated_items"))
def section_terms(spark, d):
    return topics.section_terms(sectioned(spark, d)).withColumn("weight", F.round("weight", 6))


@query("cluster_sections", sql(f"""WITH {_SECTIONED},
 themes AS (SELECT digest_date, category, term, row_number() OVER (PARTITION BY digest_date, category ORDER BY weight DESC, term) AS rank
   FROM weighed WHERE n_inside >= 2 QUALIFY rank <= 6),
 clustered AS (SELECT s.digest_date, s.category, s.idx, s.ts, arg_min(t.term, t.rank) AS theme FROM sectioned s
   LEFT JOIN themes t ON t.digest_date = s.digest_date AND t.category = s.category AND list_contains(s.ts, t.term) GROUP BY ALL),
 c_inside AS (SELECT digest_date, category, theme, term, count(*) AS n FROM (SELECT digest_date, category, theme, unnest(ts) AS term FROM clustered WHERE theme IS NOT NULL) GROUP BY ALL),
 c_everywhere AS (SELECT digest_date, category, term, sum(n)::BIGINT AS everywhere FROM c_inside GROUP BY ALL),
 c_size AS (SELECT digest_date, category, avg(n) AS size FROM (SELECT digest_date, category, theme, sum(n) AS n FROM c_inside GROUP BY ALL) GROUP BY ALL),
 c_named AS (SELECT digest_date, category, theme, term, row_number() OVER (PARTITION BY digest_date, category, theme ORDER BY n * ln(1 + size / everywhere) DESC, term) AS rank
   FROM c_inside JOIN c_everywhere USING (digest_date, category, term) JOIN c_size USING (digest_date, category) QUALIFY rank <= 2),
 names AS (SELECT digest_date, category, theme, string_agg(upper(term[1]) || term[2:], ' / ' ORDER BY rank) AS name FROM c_named GROUP BY ALL),
 sizes AS (SELECT digest_date, category, theme, row_number() OVER (PARTITION BY digest_date, category ORDER BY theme IS NULL, n DESC, theme) - 1 AS sub_pos
   FROM (SELECT digest_date, category, theme, count(*) AS n FROM clustered GROUP BY ALL))
SELECT c.digest_date, c.category, c.idx, c.theme, z.sub_pos, coalesce(n.name, 'Top Stories') AS subcategory
FROM clustered c JOIN sizes z ON z.digest_date = c.digest_date AND z.category = c.category AND z.theme IS NOT DISTINCT FROM c.theme
LEFT JOIN names n ON n.digest_date = c.digest_date AND n.category = c.category AND n.theme = c.theme""", "dated_items"))
def cluster_sections(spark, d):
    """The day's sections parted by content, each part named by its terms."""
    return topics.cluster_sections(sectioned(spark, d)).select("digest_date", "category", "idx", "theme", "sub_pos", "subcategory")


@query("trending_topics", sql(f"""
WITH used AS (SELECT DISTINCT unnest({_terms_sql("title || ' ' || summary")}) AS term, CAST(received_at AS DATE) AS day, source_email_sender AS sender FROM items),
 counted AS (SELECT term, count(DISTINCT sender) FILTER (back < 1) AS n_recent, count(DISTINCT sender) FILTER (back BETWEEN 1 AND 6) AS n_base
   FROM (SELECT *, date_diff('day', day, (SELECT max(day) FROM used)) AS back FROM used) WHERE back < 7 GROUP BY term)
SELECT term, n_recent, n_base, round(n_recent / (1 + n_base / 6), 9) AS burst FROM counted WHERE n_recent >= 2""", "items"))
def trending_topics(spark, d):
    """Terms that more senders use on the last day than on the six before."""
    items = V.items(spark, d).withColumn("digest_date", F.to_date("received_at"))
    newest = V.messages(spark, d).agg(F.max(F.to_date("received_at"))).first()[0]
    return topics.trending(topics.daily_senders(items), newest).withColumn("burst", F.round("burst", 9))


@query("topic_trends", """
WITH counted AS (SELECT event_type AS topic, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
 series AS (SELECT topic, day, coalesce(n, 0) AS n FROM (SELECT topic, day FROM (SELECT DISTINCT topic FROM counted)
   CROSS JOIN (SELECT unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM counted)) LEFT JOIN counted USING (topic, day)),
 middle AS (SELECT *, median(n) OVER (PARTITION BY topic ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS median FROM series),
 summed AS (SELECT *, sum(coalesce(n - median, 0) - 1) OVER w AS up_sum, sum(-coalesce(n - median, 0) - 1) OVER w AS down_sum FROM middle
   WINDOW w AS (PARTITION BY topic ORDER BY day)),
 drifted AS (SELECT *, up_sum - least(min(up_sum) OVER w, 0) AS up, down_sum - least(min(down_sum) OVER w, 0) AS down FROM summed
   WINDOW w AS (PARTITION BY topic ORDER BY day))
SELECT topic, day, n, median, up, down, (up > 5 AND coalesce(lag(up) OVER o, 0) <= 5)::INT - (down > 5 AND coalesce(lag(down) OVER o, 0) <= 5)::INT AS change
FROM drifted WINDOW o AS (PARTITION BY topic ORDER BY day)""")
def topic_trends(spark, d):
    """Daily events per type with days of none, and where they changed."""
    dated = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"))
    return topics.change_points(topics.topic_series(dated, "event_type", "day"))


@query("source_quality", sql("""
WITH scored AS (SELECT sender, is_news, CASE WHEN is_news AND confidence = 'high' THEN 1.0::DOUBLE WHEN is_news AND confidence = 'medium' THEN 0.5 ELSE 0 END AS score FROM classified)
SELECT sender, count(*) AS n_mails, count(*) FILTER (is_news) AS n_news, round(avg(score), 9) AS confidence,
  round((sum(score) + 20 * (SELECT avg(score) FROM scored)) / (count(*) + 20), 9) AS quality FROM scored GROUP BY sender""", "classified"))
def source_quality(spark, d):
    rated = quality.source_quality(V.classified(spark, d))
    return rated.withColumn("confidence", F.round("confidence", 9)).withColumn("quality", F.round("quality", 9))


def judged(spark, d) -> DataFrame:
    """Length-based scores of the labelled documents against their labels."""
    return table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select(
        "lang", (F.least(F.length("text"), F.lit(5000)) / 5000).alias("score"), (F.col("quality") == 1).alias("good"))


_JUDGED = """judged AS (SELECT lang, least(length(text), 5000) / 5000 AS score, quality = 1 AS good FROM documents JOIN labels USING (doc_id))"""


@query("category_analytics", f"""
WITH {_JUDGED}, n AS (SELECT CASE WHEN score >= 0.2 THEN 'long' ELSE 'short' END AS predicted, CASE WHEN good THEN 'good' ELSE 'poor' END AS actual, count(*) AS n FROM judged GROUP BY ALL)
SELECT predicted, actual, n, round(n / sum(n) OVER (PARTITION BY predicted), 9) AS precision, round(n / sum(n) OVER (PARTITION BY actual), 9) AS recall FROM n""")
def category_analytics(spark, d):
    told = judged(spark, d).select(
        F.when(F.col("score") >= 0.2, "long").otherwise("short").alias("predicted"), F.when(F.col("good"), "good").otherwise("poor").alias("actual"))
    return quality.confusion(told, "predicted", "actual").withColumn("precision", F.round("precision", 9)).withColumn("recall", F.round("recall", 9))


@query("confidence_calibration", f"""
WITH {_JUDGED}, bins AS (SELECT least(floor(score * 50), 49)::INT AS bin, count(*) AS n, count(*) FILTER (good) AS n_right FROM judged WHERE good IS NOT NULL GROUP BY ALL),
 stretch AS (SELECT b.bin, b.n, b.n_right, s.bin AS first, sum(m.n_right) / sum(m.n) AS mean FROM bins b JOIN bins s ON s.bin <= b.bin JOIN bins e ON e.bin >= b.bin
   JOIN bins m ON m.bin BETWEEN s.bin AND e.bin GROUP BY b.bin, b.n, b.n_right, s.bin, e.bin)
SELECT bin, n, n_right, round(max(least), 9) AS probability FROM (SELECT bin, n, n_right, first, min(mean) AS least FROM stretch GROUP BY ALL) GROUP BY ALL""")
def confidence_calibration(spark, d):
    """Chance that a score is right, by isotonic regression over its bins."""
    return quality.calibrated(judged(spark, d), "score", "good").withColumn("probability", F.round("probability", 9))

"""Mail entities derived from the given tables, in Spark and in SQL side by side.

Every Spark view has a common table expression of the same name and meaning in
``SQL``; :func:`sql` puts the needed ones in front of a query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.digest import index_items
from ..operators.scoring import news_only
from ..operators.stories import extract_stories, place
from ..schemas import TAXONOMY
from ..session import spread

TAXONOMY_SQL = "(" + ", ".join(f"'{c}'" for c in TAXONOMY) + ")"

# Item ids pack (message, line); a text is shorter than this, so ids never collide.
LINES_PER_MESSAGE = 1 << 31


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


START = "2024-01-01 00:00:00"


def received_at(doc_id: Column) -> Column:
    """Five minutes per message, from 2024-01-01, without a time zone."""
    days = F.floor(doc_id / 288).cast("int")
    minutes = ((doc_id % 288) * 5).cast("int")
    return F.lit(START).cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), minutes)


def message_columns() -> list[Column]:
    when = received_at(F.col("doc_id"))
    return [
        F.concat(F.lit("acct"), (F.col("doc_id") % 2 + 1).cast("string")).alias("account"),
        F.col("doc_id").alias("message_id"),
        F.substring_index("text", "\n", 1).alias("subject"),
        F.concat(F.col("source"), F.lit(" <news@"), F.col("source"), F.lit(".example.com>")).alias("sender"),
        F.date_format(when, "yyyy-MM-dd HH:mm").alias("date"),
        F.col("text").alias("body"),
        when.alias("received_at"),
        F.col("lang"),
    ]


def classification_columns() -> list[Column]:
    doc_id = F.col("doc_id")
    good = F.col("quality") == 1
    # Fixture categories by language.
    by_language = F.create_map(*[F.lit(x) for x in ("en", "Technology", "fr", "Politics", "de", "Economy", "es", "Stocks")])
    primary = (
        F.when(doc_id % 11 == 0, F.lit(None))
        .when(doc_id % 13 == 0, "Sports")
        .otherwise(F.try_element_at(by_language, F.col("lang")))
    )
    secondary = (
        F.when(doc_id % 5 == 0, F.array(F.lit("AI"), F.lit("Technology")))
        .when(doc_id % 7 == 0, F.array(F.lit("Other"), F.lit("Sports"), F.lit("Other")))
        .otherwise(F.array().cast("array<string>"))
    )
    return [
        F.coalesce(good, F.lit(False)).alias("is_news"),
        F.when(good & (F.col("toxic") == 0), "high").when(good, "medium").otherwise("low").alias("confidence"),
        F.when(F.col("quality").isNull(), "Error in analysis").when(good, "News: report")
        .otherwise("Not News: Promotional").alias("reason"),
        primary.alias("primary_category"),
        secondary.alias("secondary_categories"),
    ]


def messages_of(docs: DataFrame) -> DataFrame:
    """Documents, batch or stream, as messages."""
    return docs.select(*message_columns())


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_of(spread(table(spark, sf_dir, "documents")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select(F.col("doc_id").alias("message_id"), *classification_columns())


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).select(*message_columns(), *classification_columns())


def with_ids(items: DataFrame) -> DataFrame:
    sender = F.split_part("source_email_sender", F.lit(" "), F.lit(1))
    address = F.concat(F.lit("https://"), sender, F.lit(".example.com/"), F.col("original_email_id").cast("string"))
    return items.withColumn("item_id", F.col("original_email_id") * LINES_PER_MESSAGE + F.col("item_pos")).withColumn(
        "source_urls", F.array(address)
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(extract_stories(classified(spark, sf_dir)))


def placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place(items(spark, sf_dir))


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    return news_only(classified(spark, sf_dir))


def news_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(extract_stories(news(spark, sf_dir)))


def dated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items numbered by ``idx`` within the digest of their day."""
    dated = items(spark, sf_dir).withColumn("digest_date", F.to_date("received_at"))
    return index_items(dated, ["received_at", "item_id"])


SQL = {
    "messages": ((), """
        SELECT 'acct' || (doc_id % 2 + 1) AS account, doc_id AS message_id,
               split_part(text, chr(10), 1) AS subject,
               source || ' <news@' || source || '.example.com>' AS sender,
               strftime(TIMESTAMP '2024-01-01' + to_minutes(5 * doc_id), '%Y-%m-%d %H:%M') AS date,
               text AS body, TIMESTAMP '2024-01-01' + to_minutes(5 * doc_id) AS received_at, lang
        FROM documents"""),
    "classification": ((), """
        SELECT d.doc_id AS message_id, coalesce(quality = 1, false) AS is_news,
               CASE WHEN quality = 1 AND toxic = 0 THEN 'high' WHEN quality = 1 THEN 'medium' ELSE 'low' END AS confidence,
               CASE WHEN quality IS NULL THEN 'Error in analysis' WHEN quality = 1 THEN 'News: report'
                    ELSE 'Not News: Promotional' END AS reason,
               CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 13 = 0 THEN 'Sports'
                    WHEN lang = 'en' THEN 'Technology' WHEN lang = 'fr' THEN 'Politics'
                    WHEN lang = 'de' THEN 'Economy' WHEN lang = 'es' THEN 'Stocks' END AS primary_category,
               CASE WHEN d.doc_id % 5 = 0 THEN ['AI', 'Technology'] WHEN d.doc_id % 7 = 0 THEN ['Other', 'Sports', 'Other']
                    ELSE CAST([] AS VARCHAR[]) END AS secondary_categories
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""),
    "classified": (("messages", "classification"), """
        SELECT m.*, c.* EXCLUDE (message_id) FROM messages m JOIN classification c ON m.message_id = c.message_id"""),
    "items": (("classified",), rf"""
        SELECT split(line, '. ')[1] AS title, line AS summary, coalesce(primary_category, 'General') AS main_topic,
               ['https://' || split_part(sender, ' ', 1) || '.example.com/' || message_id] AS source_urls,
               split(line, '. ')[1:5] AS key_points, item_pos, received_at,
               subject AS source_email_subject, sender AS source_email_sender, date AS source_email_date,
               account AS source_account, message_id AS original_email_id,
               primary_category AS email_primary_category, secondary_categories AS email_secondary_categories,
               confidence AS email_classification_confidence, reason AS email_classification_reason,
               message_id * {LINES_PER_MESSAGE} + item_pos AS item_id
        FROM (SELECT *, generate_subscripts(lines, 1) - 1 AS item_pos, unnest(lines) AS line
              FROM (SELECT *, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\s\x0b]') AND NOT regexp_matches(x,
                        '(?i)unsubscribe|privacy policy|view in (your )?browser|all rights reserved')) AS lines
                    FROM classified))"""),
    "placed": (("items",), f"""
        SELECT * FROM (
          SELECT items.*, unnest(CASE WHEN email_primary_category IN {TAXONOMY_SQL}
            THEN list_concat([{{'category': email_primary_category, 'is_secondary_category': false}}],
                 list_transform(list_filter(email_secondary_categories, lambda c: c <> email_primary_category AND
                     c IN {TAXONOMY_SQL}),
                     lambda c: {{'category': c, 'is_secondary_category': true}}))
            ELSE [{{'category': 'Other', 'is_secondary_category': false}}] END, recursive := true)
          FROM items)"""),
    # Story pairs at or above 0.8 similarity or with equal normalised text.
    "texts": ((), """SELECT 'all' AS scope, doc_id AS id, text FROM documents"""),
    "item_texts": (("placed",), """
        SELECT DISTINCT category AS scope, item_id AS id, title || ' ' || summary || ' ' || main_topic AS text FROM placed"""),
}


def _similarity_sql(prefix: str, source: str) -> dict:
    """Brute-force similarity over the view ``source`` (scope, id, text)."""
    p = prefix
    return {
        f"{p}prints": ((source,), rf"""
            SELECT scope, id, sha256(trim(regexp_replace(lower(text), '\s+', ' ', 'g'))) AS fingerprint FROM {source}"""),
        f"{p}grams": ((source,), rf"""
            SELECT DISTINCT scope, id, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
            FROM (SELECT scope, id, ws, unnest(range(1, len(ws) - 1)) AS i
                  FROM (SELECT scope, id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS ws
                        FROM {source}))"""),
        f"{p}sizes": ((f"{p}grams",), f"SELECT scope, id, count(*) AS n FROM {p}grams GROUP BY ALL"),
        f"{p}pairs": ((f"{p}grams", f"{p}sizes"), f"""
            SELECT scope, a, b, shared, x.n AS na, y.n AS nb FROM (
              SELECT p.scope AS scope, p.id AS a, q.id AS b, count(*) AS shared
              FROM {p}grams p JOIN {p}grams q ON p.scope = q.scope AND p.gram = q.gram AND p.id < q.id GROUP BY ALL) o
            JOIN {p}sizes x USING (scope) JOIN {p}sizes y USING (scope)
            WHERE x.id = a AND y.id = b AND shared * 10 >= (x.n + y.n - shared) * 8"""),
        f"{p}links": ((f"{p}pairs", f"{p}prints"), f"""
            SELECT scope, a, b FROM {p}pairs UNION
            SELECT scope, min(id) OVER (PARTITION BY scope, fingerprint) AS a, id AS b FROM {p}prints
            QUALIFY a < b"""),
        f"{p}reach": ((f"{p}links",), f"""
            SELECT scope, a AS id, a AS root FROM {p}links UNION SELECT scope, b, b FROM {p}links UNION
            SELECT e.scope, e.v, r.root FROM {p}reach r JOIN (
              SELECT scope, a AS u, b AS v FROM {p}links UNION ALL SELECT scope, b, a FROM {p}links) e
            ON r.scope = e.scope AND r.id = e.u AND r.root < e.v"""),
        f"{p}clusters": ((f"{p}reach",), f"SELECT scope, id, min(root) AS cluster_id FROM {p}reach GROUP BY ALL"),
        f"{p}typed": ((f"{p}clusters", f"{p}prints"), f"""
            SELECT scope, id, cluster_id,
              CASE WHEN min(fingerprint) OVER w = max(fingerprint) OVER w THEN 'duplicate' ELSE 'similar' END AS group_type
            FROM {p}clusters JOIN {p}prints USING (scope, id) WINDOW w AS (PARTITION BY scope, cluster_id)"""),
    }


SQL["news"] = (("classified",), "SELECT * FROM classified WHERE is_news")
SQL["news_items"] = (("news",), SQL["items"][1].replace("FROM classified", "FROM news"))
SQL["news_placed"] = (("news_items",), SQL["placed"][1].replace("items.*", "news_items.*").replace("FROM items", "FROM news_items"))
SQL["news_texts"] = (("news_placed",), SQL["item_texts"][1].replace("FROM placed", "FROM news_placed"))
SQL["dated_items"] = (("items",), """
    SELECT *, row_number() OVER (PARTITION BY digest_date ORDER BY received_at, item_id) - 1 AS idx
    FROM (SELECT *, CAST(received_at AS DATE) AS digest_date FROM items)""")

SQL.update(_similarity_sql("text_", "texts"))
SQL.update(_similarity_sql("news_", "news_texts"))
SQL.update(_similarity_sql("item_", "item_texts"))


def sql(query: str, *views: str) -> str:
    """``query`` preceded by the views it names and everything they build on."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in SQL[name][0]:
            if other != name:
                need(other)
        if name not in ordered:
            ordered.append(name)

    for name in views:
        need(name)
    if not ordered:
        return query
    head = "WITH RECURSIVE " + ",\n".join(f"{n} AS ({SQL[n][1]})" for n in ordered)
    own = query.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if own.startswith(opening):
            return head + ",\n" + own[len(opening):]
    return head + "\n" + own

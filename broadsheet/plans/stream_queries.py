"""Streaming queries driven to completion over the given tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..streaming import jobs, memory, sink
from . import views as V
from .story_queries import _HITS
from .text_queries import _TO_TEXT, b64url
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


def timed(df: DataFrame, at: str = "received_at") -> DataFrame:
    return df.withColumn(at, F.col(at).cast("timestamp"))


def mail(spark, d) -> DataFrame:
    return timed(V.messages(spark, d))


def ordered_events(spark, d) -> DataFrame:
    return timed(table(spark, d, "events").select("user_id", "event_type", "ts"), "ts")


def zoneless(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def exported(spark, d) -> DataFrame:
    """The documents as exported mail: headers, and a tree of parts in which some have no data."""
    doc_id, text = F.col("doc_id"), F.col("text")

    def part(path: list[int], mime: str, data: Column) -> Column:
        return F.struct(F.array(*map(F.lit, path)).cast("array<int>").alias("part_path"), F.lit(mime).alias("mime"), data.alias("data"))

    tree = F.array(
        part([], "multipart/mixed", F.lit(None).cast("string")),
        part([0], "text/plain", F.when(doc_id % 2 == 0, b64url(text))),
        part([1, 0], "text/html", b64url(F.concat(F.lit("<p>"), text, F.lit("</p>")))),
        part([1, 1], "text/plain", F.when(doc_id % 3 == 0, b64url(F.concat(F.lit("alt "), text)))),
    )
    header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
    return table(spark, d, "documents").select(
        F.lit("acct").alias("account"), doc_id.cast("string").alias("message_id"), V.received_at(doc_id).cast("timestamp").alias("received_at"),
        F.array(header("Subject", F.substring_index(text, "\n", 1)), header("From", F.col("source"))).alias("headers"), tree.alias("parts"))


@query("stream_ingest", rf"""
WITH bodies AS (SELECT doc_id, split_part(text, chr(10), 1) AS subject, CASE WHEN doc_id % 2 = 0 THEN text WHEN doc_id % 3 = 0 THEN 'alt ' || text
    ELSE {_TO_TEXT.format(c="'<p>' || text || '</p>'")} END AS body FROM documents),
 judged AS (SELECT doc_id, body, list_sort(s, 'DESC')[1] AS best FROM (SELECT doc_id, body, [{_HITS}] AS s FROM (
   SELECT doc_id, body, ' ' || trim(regexp_replace(lower(subject || chr(10) || body), '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' ' AS t FROM bodies)))
SELECT doc_id::VARCHAR AS message_id, category, line AS summary FROM (
  SELECT doc_id, best.category AS category, unnest(string_split(body, chr(10))) AS line FROM judged WHERE best.hits > 0)
WHERE regexp_matches(line, '[^\s\x0b]') AND NOT regexp_matches(line, '(?i)unsubscribe|privacy policy|view in (your )?browser|all rights reserved')""")
def stream_ingest(spark, d):
    """Exported mail to stories as a stream: body choice, classification and extraction, in two batches."""
    told = jobs.replayed_table(exported(spark, d), "received_at", jobs.ingest, closing=None)
    return told.select(F.col("original_email_id").alias("message_id"), F.col("email_primary_category").alias("category"), "summary")


@query("stream_dedup", sql("SELECT account, message_id, received_at FROM messages", "messages"))
def stream_dedup(spark, d):
    """Every third message is delivered again 40 minutes later, often in a later batch, and comes out once."""
    again = F.when(F.col("message_id") % 3 == 0, F.array(F.lit(0), F.lit(40))).otherwise(F.array(F.lit(0)))
    delivered = mail(spark, d).select("account", "message_id", "received_at", F.explode(again).alias("late")).select(
        "account", "message_id", "received_at", (F.col("received_at") + F.make_dt_interval(mins=F.col("late"))).alias("delivered_at"))
    once = jobs.replayed_table(delivered, "delivered_at", lambda s: jobs.drop_redelivered(s, at="delivered_at"), closing=None)
    return zoneless(once.select("account", "message_id", "received_at"), "received_at")


@query("stream_daily_counts", sql("""
SELECT date_trunc('day', received_at)::TIMESTAMP AS window_start, date_trunc('day', received_at)::TIMESTAMP + INTERVAL 1 DAY AS window_end,
   lang, count(*) AS n FROM messages GROUP BY ALL""", "messages"))
def stream_daily_counts(spark, d):
    told = mail(spark, d).select("received_at", "lang")
    counted = jobs.replayed_table(told, "received_at", lambda s: jobs.window_counts(s, "lang", "received_at"))
    return zoneless(counted, "window_start", "window_end")


@query("sliding_counts", """
SELECT window_end - INTERVAL 24 HOUR AS window_start, window_end, event_type, count(*) AS n
FROM (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP + to_hours(unnest(range(1, 25))) AS window_end FROM events) GROUP BY ALL""")
def sliding_counts(spark, d):
    events = ordered_events(spark, d).select("event_type", "ts")
    counted = jobs.replayed_table(events, "ts", lambda s: jobs.window_counts(s, "event_type", "ts", "1 day", "1 hour"))
    return zoneless(counted, "window_start", "window_end")


@query("sender_sessions", """
WITH marked AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS opens
                FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM marked),
 grouped AS (SELECT user_id, session, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM numbered GROUP BY ALL)
SELECT user_id, session_start, session_end, n FROM grouped""")
def sender_sessions(spark, d):
    events = ordered_events(spark, d).select("user_id", "ts")
    bursts = jobs.replayed_table(events, "ts", lambda s: jobs.sessions(s, "user_id", "ts"))
    return zoneless(bursts, "session_start", "session_end")


def covered(spark, d) -> DataFrame:
    """Every message three times, at fifty minutes per message: again after three days, and after nine quiet ones."""
    later, minutes = F.col("later"), F.col("message_id") * 50
    at = F.lit(V.START).cast("timestamp") + F.make_dt_interval(
        days=later + F.floor(minutes / 1440).cast("int"), mins=(minutes % 1440).cast("int"))
    again = F.explode(F.array(*map(F.lit, COVERED_DAYS))).alias("later")
    return V.messages(spark, d).select("message_id", "body", again).select(
        (F.col("message_id") * 100 + later).alias("story_id"), "body", at.alias("received_at"))


COVERED_DAYS = (0, 3, 12)
_COVERED_SQL = f"""
 covered AS (SELECT doc_id * 100 + later AS story_id, text AS body, TIMESTAMP '2024-01-01' + to_days(later::INT) + to_minutes(50 * doc_id) AS received_at
   FROM documents, (VALUES {', '.join(f'({k})' for k in COVERED_DAYS)}) again(later))"""


@query("story_memory", rf"""WITH {_COVERED_SQL},
 printed AS (SELECT *, sha256(trim(regexp_replace(lower(body), '\s+', ' ', 'g'))) AS fingerprint FROM covered)
SELECT fingerprint, received_at, story_id FROM printed
QUALIFY coalesce(received_at >= lag(received_at) OVER (PARTITION BY fingerprint ORDER BY received_at, story_id) + INTERVAL 7 DAY, true)""")
def story_memory(spark, d):
    """Texts that come after seven quiet days or for the first time, over months of mail in several batches."""
    told = jobs.replayed_table(
        covered(spark, d), "received_at", lambda s: memory.first_coverage(s, "body", ("story_id",)), slices=3)
    return zoneless(told, "received_at")


@query("digest_sink", sql(_COVERED_SQL.replace("covered AS", "WITH covered AS", 1).lstrip() + r""",
 printed AS (SELECT *, story_id // 100 AS doc_id, sha256(trim(regexp_replace(lower(body), '\s+', ' ', 'g'))) AS fingerprint FROM covered),
 near AS (SELECT a, b FROM text_pairs UNION SELECT b, a FROM text_pairs UNION
   SELECT p.doc_id, q.doc_id FROM printed p JOIN printed q USING (fingerprint)),
 latest AS (SELECT x.story_id, max(y.received_at) AS before FROM printed x JOIN near ON a = x.doc_id JOIN printed y ON y.doc_id = b
   WHERE (y.received_at, y.story_id) < (x.received_at, x.story_id) AND y.received_at > x.received_at - INTERVAL 7 DAY GROUP BY ALL)
SELECT story_id, CAST(received_at AS DATE) AS digest_date, received_at FROM printed WHERE story_id NOT IN (SELECT story_id FROM latest)""", "text_pairs"))
def digest_sink(spark, d):
    """Stories archived by date, batch by batch, unless an equal or similar text came in the seven days before."""
    told = covered(spark, d).withColumn("digest_date", F.to_date("received_at"))
    archive = []

    def start(stream: DataFrame, folder: str) -> None:
        sink.archive_stories(stream, f"{folder}/archive", f"{folder}/progress", text="body")
        archive[:] = [f"{folder}/archive/stories"]

    jobs.replay(told, "received_at", start, slices=3, closing=None)
    return zoneless(spark.read.parquet(archive[0]).select("story_id", "digest_date", "received_at"), "received_at")

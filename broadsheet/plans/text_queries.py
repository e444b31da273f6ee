"""Queries over messages, bodies, markup and addresses, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as T
from ..operators.mime import select_bodies
from ..session import materialise, new_folder
from ..sources import messages as M
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


def as_of(df: DataFrame, column: str = "received_at"):
    """The clock of a test run: one scalar."""
    return df.agg(F.max(column)).first()[0]


@query("scan_messages", sql(
    "SELECT account, message_id, subject, sender, date, received_at, md5(body) AS body_md5, length(body) AS n_chars FROM messages",
    "messages"))
def scan_messages(spark: SparkSession, d: str) -> DataFrame:
    return V.messages(spark, d).select(
        "account", "message_id", "subject", "sender", "date", "received_at",
        F.md5("body").alias("body_md5"), F.length("body").cast("long").alias("n_chars"),
    )


@query("trailing_window", sql(
    "SELECT account, message_id, received_at FROM messages WHERE received_at > (SELECT max(received_at) FROM messages) - INTERVAL 1 DAY",
    "messages"))
def trailing_window(spark, d):
    mail = V.messages(spark, d)
    return M.trailing(mail, as_of(mail)).select("account", "message_id", "received_at")


def landing(spark, d) -> str:
    path = new_folder(spark, "landing")
    M.write_landing(V.messages(spark, d).select("account", "message_id", "subject", "received_at"), path)
    return path


@query("landing_window", sql(
    "SELECT account, message_id, received_at, CAST(received_at AS DATE) AS received_date FROM messages "
    "WHERE received_at > (SELECT max(received_at) FROM messages) - INTERVAL 1 DAY", "messages"))
def landing_window(spark, d):
    """The trailing day of a table with a folder per account and day; folders before it are not listed."""
    mail = M.read_messages(spark, landing(spark, d))
    return M.trailing(mail, as_of(mail)).select("account", "message_id", "received_at", "received_date")


@query("account_window", sql("""
SELECT account, message_id, received_at FROM messages m JOIN (
  SELECT account, max(received_at) - CASE account WHEN 'acct1' THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS clock FROM messages GROUP BY account) USING (account)
WHERE received_at > clock - INTERVAL 1 DAY AND CAST(received_at AS DATE) <= CAST(clock AS DATE)""", "messages"))
def account_window(spark, d):
    """The day before each account's own clock; the first account's stopped two days ago."""
    mail = M.read_messages(spark, landing(spark, d))
    late = F.when(F.col("account") == "acct1", F.make_dt_interval(F.lit(2))).otherwise(F.make_dt_interval(F.lit(0)))
    clocks = materialise(mail.groupBy("account").agg(F.max("received_at").alias("as_of")).withColumn("as_of", F.col("as_of") - late), "clocks")
    return M.trailing_by_account(mail, clocks).select("account", "message_id", "received_at")


@query("exclude_senders", sql(
    "SELECT message_id, sender FROM messages WHERE lower(regexp_extract(sender, '<([^<>]*)>', 1)) NOT IN "
    "('news@src0.example.com', 'news@src3.example.com', 'news@src7.example.com')", "messages"))
def exclude_senders(spark, d):
    senders = M.sender_list("NEWS@src0.example.com, , news@src3.example.com,news@src3.example.com", "news@src7.example.com")
    return M.exclude_senders(V.messages(spark, d), senders).select("message_id", "sender")


@query("union_accounts", sql(
    "SELECT account, CASE account WHEN 'acct1' THEN 'Account 1' ELSE 'Account 2' END AS account_name, message_id, subject FROM messages",
    "messages"))
def union_accounts(spark, d):
    mail = V.messages(spark, d)
    boxes = {
        f"acct{i}": (f"Account {i}", mail.where(F.col("account") == f"acct{i}").drop("account")) for i in (1, 2)
    }
    return M.union_accounts(boxes).select("account", "account_name", "message_id", "subject")


_STORY_LINES = r"""
SELECT doc_id AS main_topic, title, summary FROM (
  SELECT doc_id::VARCHAR AS doc_id, unnest(string_split(text, chr(10))) AS summary, md5(text) AS title FROM documents)"""


@query("load_story_json", _STORY_LINES)
def load_story_json(spark, d):
    docs = table(spark, d, "documents")
    story = F.transform(F.split("text", "\n"), lambda line: F.struct(
        F.md5("text").alias("title"), line.alias("summary"), F.col("doc_id").cast("string").alias("main_topic"),
    ))
    path = new_folder(spark, "story-json")
    docs.select(story.alias("items")).write.json(path)
    return M.read_stories(spark, path, multi_line=False).select("title", "summary", "main_topic")


@query("header_pivot", """
SELECT doc_id AS message_id,
  CASE WHEN doc_id % 3 = 0 THEN 'Re: ' || source WHEN doc_id % 4 = 0 THEN 'No Subject' ELSE 'Fwd: ' || lang END AS subject,
  CASE WHEN doc_id % 5 = 0 THEN 'Unknown Sender' ELSE source END AS sender,
  CASE WHEN doc_id % 7 = 0 THEN '' ELSE lang END AS date
FROM documents""")
def header_pivot(spark, d):
    doc_id, source, lang = F.col("doc_id"), F.col("source"), F.col("lang")

    def entry(name, value):
        return F.struct(F.lit(name).alias("name"), value.alias("value"))

    first = F.when((doc_id % 3 != 0) & (doc_id % 4 == 0), entry("subject", F.lit("lower case name"))).otherwise(
        entry("Subject", F.concat(F.lit("Fwd: "), lang)))
    second = F.when(doc_id % 3 == 0, entry("Subject", F.concat(F.lit("Re: "), source))).otherwise(entry("X-Other", source))
    sender = F.when(doc_id % 5 == 0, entry("from", source)).otherwise(entry("From", source))
    date = entry("Date", F.when(doc_id % 7 == 0, F.lit("")).otherwise(lang))
    headers = F.array(first, second, sender, date)
    return table(spark, d, "documents").select(
        doc_id.alias("message_id"), T.header(headers, "Subject").alias("subject"),
        T.header(headers, "From").alias("sender"), T.header(headers, "Date").alias("date"),
    )


def b64url(c):
    """Unpadded base64url of a text column."""
    return F.rtrim(F.translate(F.base64(F.encode(c, "UTF-8")), "+/\r\n", "-_"), F.lit("="))


@query("decode_body", "SELECT doc_id, md5(text) AS body_md5, length(text) AS n_chars FROM documents")
def decode_body(spark, d):
    """Every third body carries characters that are not base64, which decoders skip."""
    data = b64url(F.col("text"))
    stray = F.when(F.col("doc_id") % 3 == 0, F.concat(F.substring("data", 1, 5), F.lit("! .*"), F.expr("substring(data, 6)"), F.lit("~"))).otherwise(F.col("data"))
    docs = table(spark, d, "documents").withColumn("data", data).select("doc_id", stray.alias("data"))
    body = T.decode_b64url(F.col("data"))
    return docs.select("doc_id", F.md5(body).alias("body_md5"), F.length(body).cast("long").alias("n_chars"))


def message_parts(spark, d):
    """Pages as single html parts, documents as multipart trees."""
    docs, pages = table(spark, d, "documents"), table(spark, d, "pages")

    def part(path, mime, data):
        return F.struct(
            F.array(*[F.lit(i) for i in path]).cast("array<int>").alias("part_path"),
            F.lit(mime).alias("mime"), data.alias("data"),
        )

    text, none = F.col("text"), F.lit(None).cast("string")
    tree = F.array(
        part([], "multipart/mixed", none),
        part([0], "text/plain", F.when(F.col("doc_id") % 2 == 0, b64url(text))),
        part([1], "multipart/alternative", none),
        part([1, 0], "text/html", b64url(F.concat(F.lit("<p>"), text, F.lit("</p>")))),
        part([1, 1], "text/plain", F.when(F.col("doc_id") % 3 == 0, b64url(F.concat(F.lit("alt "), text)))),
    )
    of_docs = docs.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("message_id"), F.inline(tree))
    of_pages = pages.select(
        F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("message_id"),
        F.inline(F.array(part([], "text/html", b64url(F.col("html"))))),
    )
    return of_docs.unionByName(of_pages)


_TO_TEXT = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace({c}, '<\s*(br|p|div|li|tr|td)\b[^>]*>', chr(10), 'gi'),
 '<[^>]+>', '', 'g'), '\n\n+', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g')"""


@query("select_body", f"""
SELECT 'd' || doc_id AS message_id, md5(body) AS body_md5, length(body) AS n_chars FROM (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text WHEN doc_id % 3 = 0 THEN 'alt ' || text
    ELSE {_TO_TEXT.format(c="'<p>' || text || '</p>'")} END AS body FROM documents)
UNION ALL
SELECT 'p' || page_id, md5(body), length(body) FROM (SELECT page_id, {_TO_TEXT.format(c='html')} AS body FROM pages)""")
def select_body(spark, d):
    bodies = select_bodies(message_parts(spark, d), ["message_id"])
    return bodies.select("message_id", F.md5("body").alias("body_md5"), F.length("body").cast("long").alias("n_chars"))


@query("html_to_text", f"SELECT page_id, {_TO_TEXT.format(c='html')} AS text FROM pages")
def html_to_text(spark, d):
    return table(spark, d, "pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query("truncate_text", """
SELECT doc_id, md5(CASE WHEN length(text) > 8000 THEN substr(text, 1, 8000) || chr(10) || chr(10) || '[TRUNCATED]' ELSE text END) AS input_md5,
       length(text) > 8000 AS was_cut FROM documents""")
def truncate_text(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(T.truncate(F.col("text"))).alias("input_md5"),
        (F.length("text") > T.TRUNCATE_LIMIT).alias("was_cut"),
    )


_ESCAPED = "replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"


@query("escape_html", f"""
SELECT page_id AS id, {_ESCAPED.format(c='html')} AS escaped FROM pages
UNION ALL SELECT doc_id, {_ESCAPED.format(c='text')} FROM documents""")
def escape_html(spark, d):
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), T.escape_html(F.col("html")).alias("escaped"))
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), T.escape_html(F.col("text")).alias("escaped"))
    return pages.unionByName(docs)


_TAG_LIST = ", ".join(f"'{t}'" for t in T.ALLOWED_TAGS)


@query("tag_policy_audit", rf"""
SELECT tag, tag IN ({_TAG_LIST}) AS allowed, count(*) AS n FROM (
  SELECT lower(unnest(regexp_extract_all(html, '<\s*/?\s*([A-Za-z][A-Za-z0-9]*)', 1))) AS tag FROM pages) GROUP BY ALL""")
def tag_policy_audit(spark, d):
    tags = table(spark, d, "pages").select(F.explode(T.tag_names(F.col("html"))).alias("tag"))
    return tags.groupBy("tag").agg(F.count("*").alias("n")).select(
        "tag", F.col("tag").isin(*T.ALLOWED_TAGS).alias("allowed"), "n")


# Markup put behind each page: script links, both kinds of quotes, unclosed tags, stray characters, brackets in quotes, comments and scripts.
_NASTY = (
    """<a href="javascript:alert(1)" title='a "b"'>x</a>""", "<a href='https://ok.example/?a=1&b=2' rel=nofollow>y</a> & <b",
    """<img src=x onerror=alert(1)>1 < 2 > 0 &amp; &#106; <a href=" &#106;avascript:x">z</a>""", "<a HREF=mailto:a@b.example>m</a><img src=x onerror=",
    """<a title="1 > 0 <b>" data-x=" href='https://no.example'" href=https://ok.example>q</a><p class='>'>r</p>""",
    """<!-- <b>hidden</b> > --><b>shown</b><!-- unclosed <i>""",
    """<script type="a>b">if (a<b) { x = "<p>"; }</script ><STYLE>p > a {}</STYLE><script>open""",
)
_NASTY_SQL = "CASE page_id % 7 " + " ".join(
    f"WHEN {k} THEN '{text.replace(chr(39), chr(39) * 2)}'" for k, text in enumerate(_NASTY)) + " END"


def nasty_pages(spark, d) -> DataFrame:
    """Pages with added markup that a filter must not let through."""
    nasty = F.element_at(F.array(*map(F.lit, _NASTY)), (F.col("page_id") % 7 + 1).cast("int"))
    return table(spark, d, "pages").select("page_id", F.concat("html", nasty).alias("html"))


def _escape_text_sql(c: str) -> str:
    return f"regexp_replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '&amp;(#?[A-Za-z0-9]+;)', '&\\1', 'g')"


_ATTRIBUTES_SQL = """(?:[^<>"'']+|"[^"]*"|''[^'']*'')*"""
_MARKUP_SQL = rf"(?is)<(?:script|style)\b{_ATTRIBUTES_SQL}>.*?</(?:script|style)\s*>|<!--.*?-->|<{_ATTRIBUTES_SQL}>|[^<]+|<"
_NAME_SQL = r"lower(regexp_extract(x, '^[\s/]([-A-Za-z0-9_:]+)', 1))"
_VALUE_SQL = r"""regexp_replace(regexp_replace(x, '^[\s/][-A-Za-z0-9_:]+\s*=\s*', ''), '^["'']|["'']$', '', 'g')"""
_RAW_SQL = rf"regexp_replace(regexp_replace(t, '(?is)^<(?:script|style)\b{_ATTRIBUTES_SQL}>', ''), '(?is)</(?:script|style)\s*>$', '')"


@query("tag_policy_strip", rf"""
SELECT page_id, array_to_string(list_transform(regexp_extract_all(html || {_NASTY_SQL}, '{_MARKUP_SQL}'), lambda t:
  CASE WHEN t = '<' OR NOT starts_with(t, '<') THEN {_escape_text_sql('t')}
       WHEN starts_with(t, '<!--') THEN ''
       WHEN regexp_matches(t, '(?is)^<(?:script|style)\b.*</(?:script|style)\s*>$') THEN {_escape_text_sql(_RAW_SQL)}
       WHEN lower(regexp_extract(t, '^<\s*/?\s*([A-Za-z][A-Za-z0-9]*)', 1)) IN ({_TAG_LIST}) THEN
         '<' || regexp_extract(t, '^<\s*(/?)', 1) || lower(regexp_extract(t, '^<\s*/?\s*([A-Za-z][A-Za-z0-9]*)', 1)) ||
         CASE WHEN regexp_matches(t, '(?i)^<\s*a\b') THEN array_to_string(list_transform(
             regexp_extract_all(t, '[\s/][A-Za-z][-A-Za-z0-9_:]*\s*=\s*(?:"[^"]*"|''[^'']*''|[^\s"''<>]+)'), lambda x:
             CASE WHEN {_NAME_SQL} NOT IN ('href', 'title', 'target', 'rel') THEN ''
                  WHEN {_NAME_SQL} = 'href' AND NOT regexp_matches({_VALUE_SQL}, '(?i)^\s*(?:https?://|mailto:)') THEN ''
                  ELSE ' ' || {_NAME_SQL} || '="' || replace({_escape_text_sql(_VALUE_SQL)}, '"', '&quot;') || '"' END), '')
           ELSE '' END || '>'
       ELSE '' END), '') AS kept FROM pages""")
def tag_policy_strip(spark, d):
    return nasty_pages(spark, d).select("page_id", T.apply_tag_policy(F.col("html")).alias("kept"))


@query("clean_url", r"""
SELECT page_id, trim(url) AS url, replace(replace(replace(trim(url), 'https://', ''), 'http://', ''), 'www.', '') AS shown,
       regexp_matches(trim(url), '(?i)^https?://') AS is_safe, lower(regexp_extract(trim(url), '(?i)^https?://([^/?#:]+)', 1)) AS host
FROM pages""")
def clean_url(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").select(
        "page_id", T.clean_url(url).alias("url"), T.display_url(url).alias("shown"),
        T.is_safe_url(url).alias("is_safe"), T.url_host(url).alias("host"),
    )


@query("extract_urls", r"""
SELECT DISTINCT page_id, found AS url FROM (
  SELECT page_id, unnest(list_concat(list_transform(regexp_extract_all(t, '(?i)\bhref\s*=\s*(?:"[^"]+"|''[^'']+''|[^\s"''<>]+)'),
           lambda x: regexp_replace(regexp_replace(x, '(?i)^href\s*=\s*', ''), '^["'']|["'']$', '', 'g')),
         regexp_extract_all(t, '(?i)\bhttps?://[^\s"''<>()]+'))) AS found
  FROM (SELECT page_id, url || ' ' || html || CASE page_id % 3 WHEN 0 THEN '<a href=''/one''>' WHEN 1 THEN '<a HREF=/two>' ELSE '' END AS t FROM pages))""")
def extract_urls(spark, d):
    """Every third page ends with a link in single quotes, another one with a link without quotes."""
    rest = F.col("page_id") % 3
    more = F.when(rest == 0, "<a href='/one'>").when(rest == 1, "<a HREF=/two>").otherwise("")
    text = F.concat(F.concat_ws(" ", "url", "html"), more)
    return table(spark, d, "pages").select("page_id", F.explode(T.extract_urls(text)).alias("url"))


_TITLES = (*T.DATE_PLACEHOLDERS, None, "")


def digest_titles(spark, d):
    """A proposed title per message, cycling through every placeholder form."""
    title = F.lit(None).cast("string")
    for i, form in enumerate(_TITLES):
        value = F.concat(F.lit("News " + form + " "), F.col("subject")) if form else F.lit(form).cast("string")
        title = F.when(F.col("message_id") % len(_TITLES) == i, value).otherwise(title)
    return V.messages(spark, d).select("message_id", title.alias("title"), "received_at")


_LONG = "strftime(received_at, '%A, %B %d, %Y')"


@query("title_placeholders", sql(f"""
SELECT message_id, CASE message_id % 9
    WHEN 4 THEN 'News {{' || {_LONG} || '}} ' || subject WHEN 5 THEN 'News {{' || {_LONG} || '}} ' || subject
    WHEN 7 THEN 'Daily News Digest - ' || strftime(received_at, '%B %d, %Y')
    WHEN 8 THEN 'Daily News Digest - ' || strftime(received_at, '%B %d, %Y')
    ELSE 'News ' || {_LONG} || ' ' || subject END AS title FROM messages""", "messages"))
def title_placeholders(spark, d):
    return digest_titles(spark, d).select("message_id", T.fill_title(F.col("title"), F.col("received_at")).alias("title"))


@query("digest_timestamps", sql("""
SELECT message_id, strftime(received_at, '%A, %B %d, %Y %H:%M:%S') AS generated_at, strftime(received_at, '%A, %B %d, %Y') AS display_date,
       strftime(received_at, '%H:%M:%S') AS generated_time FROM messages""", "messages"))
def digest_timestamps(spark, d):
    return V.messages(spark, d).select("message_id", *T.digest_stamps(F.col("received_at")))

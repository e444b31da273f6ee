import base64
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import text as T


def values(spark, rows, column, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, v {kind}")
    return [r[0] for r in df.select(column(F.col("v")).alias("x"), "i").orderBy("i").collect()]


def test_header_rules(spark):
    rows = [
        [("Subject", "first"), ("Subject", "last")],
        [("subject", "lower case is another header")],
        [("Subject", "")],
        [],
        None,
    ]
    got = values(spark, rows, lambda c: T.header(c, "Subject"), "array<struct<name: string, value: string>>")
    assert got == ["last", "No Subject", "", "No Subject", "No Subject"]


def test_decode_b64url(spark):
    url_safe = base64.urlsafe_b64encode("ÿ~?>>é".encode()).decode().rstrip("=")
    broken = base64.urlsafe_b64encode(b"ok\xff!").decode()
    got = values(spark, ["aGk", url_safe, broken, "a", None, "aGVs!bG8=", " aG\nk=\r"], T.decode_b64url)
    assert got == ["hi", "ÿ~?>>é", "ok�!", "", "", "hello", "hi"]


def test_html_to_text(spark):
    rows = [
        "a<BR/>b", "<p>x</p>y", "<p>a</p>\n\n\n<p>b</p>", "<script>var t</script>z", "a &amp; b", None, "  x  ",
        "< div class=q>in",
    ]
    got = values(spark, rows, T.html_to_text)
    assert got == ["a\nb", "xy", "a\n\nb", "var tz", "a &amp; b", "", "x", "in"]
    kept = values(spark, ["<script>var t</script>z<STYLE>p{}</STYLE>"], lambda c: T.html_to_text(c, True))
    assert kept == ["z"]


def test_truncate(spark):
    got = values(spark, ["a" * 7999, "a" * 8000, "a" * 8001, None, ""], T.truncate)
    assert [len(g) for g in got] == [7999, 8000, 8000 + len("\n\n[TRUNCATED]"), 0, 0]
    assert got[2].endswith("a\n\n[TRUNCATED]")


def test_escape_order(spark):
    assert values(spark, ["<a href=\"x\">'&'", "&amp;"], T.escape_html) == [
        "&lt;a href=&quot;x&quot;&gt;&#x27;&amp;&#x27;", "&amp;amp;"]


def test_tag_policy(spark):
    rows = [
        "<P onclick=x>a<u>b</u></P><a href=\"http://u\" onclick=\"y\">l</a><br/>1<2",
        "<a href=\"javascript:alert(1)\">x</a>", "<img src=x onerror=alert(1)", "a & b &amp; c > d",
        "<a href='https://u' rel=nofollow title='say \"hi\"'>l</a>", "<a href=\"java&#115;cript:x\">l</a>", "<a <b>c</b>", None,
    ]
    assert values(spark, rows, T.apply_tag_policy) == [
        "<p>ab</p><a href=\"http://u\">l</a><br>1&lt;2", "<a>x</a>", "&lt;img src=x onerror=alert(1)", "a &amp; b &amp; c &gt; d",
        "<a href=\"https://u\" rel=\"nofollow\" title=\"say &quot;hi&quot;\">l</a>", "<a>l</a>", "&lt;a <b>c</b>", "",
    ]


def test_urls(spark):
    rows = [" https://www.a.b/c ", "http://x", "javascript:alert(1)"]
    assert values(spark, rows, T.display_url) == ["a.b/c", "x", "javascript:alert(1)"]
    assert values(spark, rows, T.is_safe_url) == [True, True, False]
    assert values(spark, ["see https://a.b/c, or <a href=\"/d\">"], T.extract_urls) == [["/d", "https://a.b/c,"]]


@pytest.mark.parametrize("title, want", [
    ("On [Date]", "On Tuesday, January 30, 2024"),
    ("On {date}", "On Tuesday, January 30, 2024"),
    ("On {{Date}}", "On {Tuesday, January 30, 2024}"),
    ("", "Daily News Digest - January 30, 2024"),
    (None, "Daily News Digest - January 30, 2024"),
    ("plain", "plain"),
])
def test_titles(spark, title, want):
    now = F.lit(datetime(2024, 1, 30, 8))
    assert values(spark, [title], lambda c: T.fill_title(c, now)) == [want]


def test_markup_states(spark):
    """Brackets in quotes, comments and scripts end nothing, and nothing in there is markup."""
    rows = [
        """<a title="1 > 0 <b>" href='https://ok.example/?a=">"'>q</a>""", "<p class='>'>r</p>", "<!-- <b>x</b> > -->y", "z<!-- open <i>w",
        """<script type="a>b">if (a<b) { x = "<p>"; }</script >t""", "<STYLE>p > a {}</style><script>open <b>b</b>",
        """<a data-x=" href='https://no.example'" href=https://ok.example/>s</a>""", """<a href="https://no.example>t""", "<" * 5 + "b>" + "<" + "x" * 20000,
    ]
    assert values(spark, rows, T.apply_tag_policy)[:8] == [
        """<a title="1 &gt; 0 &lt;b&gt;" href="https://ok.example/?a=&quot;&gt;&quot;">q</a>""", "<p>r</p>", "y", "z&lt;!-- open <i>w",
        """if (a&lt;b) { x = "&lt;p&gt;"; }t""", "p &gt; a {}open <b>b</b>",
        """<a href="https://ok.example/">s</a>""", """&lt;a href="https://no.example&gt;t""",
    ]
    assert values(spark, ["""<a href='/one'><a HREF = /two> <a href="/three">"""], T.extract_urls) == [["/one", "/two", "/three"]]

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import broadsheet
from broadsheet.operators.render import PAGE_ORDER
from broadsheet.schemas import LAYOUT

NOW = datetime(2024, 5, 2, 8)
RATES = "The central bank keeps its inflation target and the market takes it calmly. Analysts expected this."
PARTY = "Congress votes on the new election policy after a long night of debate in the capital."


@pytest.fixture(scope="module")
def mail(spark):
    rows = [
        ("a", "m1", NOW - timedelta(hours=2), "Rates", "n1 <one@x.org>", "d1", RATES + "\n" + PARTY),
        ("b", "m2", NOW - timedelta(hours=1), "Rates again", "n2 <two@x.org>", "d2", RATES),
        ("a", "m3", NOW - timedelta(hours=30), "Old inflation", "n2 <two@x.org>", "d3", RATES),
        ("a", "m4", NOW - timedelta(hours=3), "Me", "me <me@x.org>", "d4", PARTY),
        ("a", "m5", NOW - timedelta(hours=3), "Lunch", "n3 <three@x.org>", "d5", "Shall we go and get food at the corner shop at noon?"),
    ]
    return spark.createDataFrame(
        rows, "account string, message_id string, received_at timestamp, subject string, sender string, date string, body string")


def test_keyword_run(spark, mail):
    out = broadsheet.run(mail, NOW, excluded=["ME@x.org"])
    row = out.funnel.first()
    assert (row.total_emails, row.news_emails, row.news_items_extracted, row.status, row.message) == (3, 2, 3, "success", "Digest ready")
    stories = out.stories.collect()
    # Equal texts under different topics are similar, not duplicate.
    assert [(r.group_type, r.original_count, r.title) for r in stories if r.original_count > 1] == [
        ("similar", 2, "The central bank keeps its inflation target and the market takes it calmly")]
    html = "".join(r.html for r in out.pages().orderBy(*PAGE_ORDER).collect())
    assert html.startswith("<!DOCTYPE html><html><body><header><h1>Daily News Digest - May 02, 2024</h1>")
    assert html.count("n1 &lt;one@x.org&gt; — Rates (a) • d1") >= 1 and "n2 &lt;two@x.org&gt; — Rates again (b) • d2" in html
    assert out.totals.first().fallback_categorized_count == len(stories)


def test_layout_run(spark, mail):
    schema = "digest_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYOUT)

    def layout(stories):
        return spark.createDataFrame(
            [(NOW.date(), "News for {date}", "all <i>quiet</i>", [("Front", [("Main", [0, 99, -1], "intro")])])], schema)

    out = broadsheet.run(mail, NOW, layout=layout)
    assert out.digest.first().title == "News for Thursday, May 02, 2024"
    assert {r.slot_pos for r in out.digest_items.collect()} == {0, 2}
    assert out.metrics.first().n_stories == 2


def test_layout_that_returns_nothing(spark, mail):
    schema = "digest_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYOUT)
    nothing = lambda stories: spark.createDataFrame([], schema)
    out = broadsheet.run(mail, NOW, layout=nothing)
    assert out.digest_items.count() == out.stories.count() > 0
    assert out.totals.first().fallback_categorized_count == out.stories.count()
    with pytest.raises(broadsheet.DigestError):
        broadsheet.run(mail, NOW, broadsheet.DigestConfig(fallback_to_keywords=False), layout=nothing)


def test_no_markup_from_a_layout_runs(spark, mail):
    schema = "digest_date date, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYOUT)
    nasty = '<a href="javascript:alert(1)">x</a><img src=x onerror=alert(1)'

    def layout(stories):
        return spark.createDataFrame(
            [(NOW.date(), "News", nasty, [("Front", [("Main", [0], nasty), ("Empty", [99], nasty)])])], schema)

    html = "".join(r.html for r in broadsheet.run(mail, NOW, layout=layout).pages().collect())
    assert "javascript:" not in html and "<img" not in html


def test_quiet_days(spark, mail):
    out = broadsheet.run(mail, NOW + timedelta(days=30))
    assert out.funnel.first().message == "No news content found"
    assert "No News Items" in "".join(r.html for r in out.pages().collect())
    with pytest.raises(broadsheet.DigestError):
        broadsheet.run(mail, NOW, broadsheet.DigestConfig(fallback_to_keywords=False))


def test_delivery_is_the_last_stage(spark, mail, tmp_path):
    people = spark.createDataFrame([(f"p{i:03}@x.org",) for i in range(150)], "recipient string")
    for _ in range(2):  # a repeated run replaces what it made
        out = broadsheet.run(mail, NOW, deliver=broadsheet.deliver_to(str(tmp_path), people))
    row = out.funnel.first()
    assert (row.sent, row.status, row.message) == (2, "success", "Digest ready")
    sent = spark.read.parquet(str(tmp_path / "outbox"))
    assert sorted(r.n_recipients for r in sent.collect()) == [50, 100]
    assert spark.read.parquet(str(tmp_path / "items")).count() == out.digest_items.count()
    page = "".join(r.value for r in spark.read.text(str(tmp_path / "pages")).collect())
    assert page.count("</html>") == 1
    assert broadsheet.run(mail, NOW + timedelta(days=30), deliver=broadsheet.deliver_to(str(tmp_path), people)).funnel.first().sent == 0

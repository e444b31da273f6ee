from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.config import DigestConfig, DigestError
from broadsheet.operators import digest as D, render, reports
from broadsheet.schemas import LAYOUT


def items(spark, n=12):
    rows = [("d1", i, f"t{i} <b>", f"s{i}", "AI") for i in range(n)]
    return spark.createDataFrame(rows, "digest_date string, idx long, title string, summary string, email_primary_category string")


def layout(spark, categories, title="T [Date]", summary="<u>sum</u> <b>x</b>"):
    schema = "digest_date string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LAYOUT.fields)
    return spark.createDataFrame([("d1", title, summary, categories)], schema)


def test_curation_rules(spark):
    subs = [("sub", list(range(11)), "i<u>n</u>"), ("bad", [50, 1, -1, -50, 1], ""), ("none", [], "x")]
    proposed = D.slots(layout(spark, [("AI", subs), ("Economy", [("e", [3], "")]), ("AI", [("again", [4, 5], "")]), ("Empty", [])]))
    curated = D.curate(items(spark), proposed)
    got = {}
    for r in curated.orderBy("slot_pos").collect():
        got.setdefault((r.category, r.subcategory), []).append(r.idx)
    assert got == {
        ("AI", "sub"): list(range(10)), ("AI", "bad"): [1, 11, 1], ("Economy", "e"): [3], ("AI", "again"): [4, 5]}
    assert {r.intro for r in curated.where("subcategory = 'sub'").collect()} == {"in"}
    assert curated.where("idx = 1").first().title == "t1 &lt;b&gt;"
    two = D.curate(items(spark), proposed, DigestConfig(max_items_per_category=2))
    assert two.where("subcategory = 'bad'").count() == 1  # the unknown id used up a slot
    assert {r.idx for r in D.unplaced(items(spark), curated).collect()} == {10}
    assert D.lost_slots(items(spark), proposed).first().n_lost == 2  # 50 and -50
    whole = D.with_empty_sections(curated, proposed)
    by_name, totals = D.digest_metrics(whole, items(spark), proposed)
    assert {r.category: r.n_stories for r in by_name.collect()} == {"AI": 2, "Economy": 1, "Empty": 0}
    t = totals.first()
    assert (t.total_stories, t.ai_categorized_count, t.fallback_categorized_count) == (16, 12, 0)


def test_heads_and_summary_switch(spark):
    now = datetime(2024, 1, 30, 8, 5, 6)
    head = D.digest_heads(layout(spark, []), now).first()
    assert (head.title, head.executive_summary) == ("T Tuesday, January 30, 2024", "sum <b>x</b>")
    assert (head.generated_at, head.generated_time) == ("Tuesday, January 30, 2024 08:05:06", "08:05:06")
    off = D.digest_heads(layout(spark, []), now, DigestConfig(enable_executive_summary=False)).first()
    assert off.executive_summary == ""


def test_rule_fallback(spark):
    none = D.slots(layout(spark, [])).limit(0)
    stories = items(spark, 3).withColumn("email_primary_category", F.when(F.col("idx") == 0, "Other"))
    curated = D.curate(stories, none)
    filled = D.with_rule_fallback(curated, stories, none)
    assert {(r.idx, r.category, r.subcategory, r.intro) for r in filled.collect()} == {
        (0, "Other", "Top Stories", "Latest developments in other:"), (1, "Other", "Top Stories", "Latest developments in other:"),
        (2, "Other", "Top Stories", "Latest developments in other:")}
    with pytest.raises(DigestError):
        D.with_rule_fallback(curated, stories, none, DigestConfig(fallback_to_keywords=False))


def test_structure_errors(spark):
    with pytest.raises(DigestError):
        D.require_valid(layout(spark, None))
    D.require_valid(layout(spark, [("AI", [("s", [1], "i")])]))


def test_top_k_limits_before_the_shuffle(spark, plan):
    top = D.section_top(items(spark), ["digest_date"], [F.desc("idx")], k=3)
    assert {r.idx for r in top.collect()} == {9, 10, 11}
    assert "WindowGroupLimit" in plan(top)


def page(df):
    rows = df.orderBy("digest_date", *render.PAGE_ORDER).collect()
    return "".join(r.html for r in rows)


def test_rendered_page(spark):
    heads = D.digest_heads(layout(spark, []), datetime(2024, 1, 30))
    proposed = D.slots(layout(spark, [("AI", [("sub", [0], "intro"), ("", [], "")])]))
    curated = D.with_empty_sections(D.curate(items(spark), proposed), proposed)
    told = curated.withColumn("story_key", F.col("idx")).withColumn("key_points", F.array(F.lit("a<b")))
    sources = spark.createDataFrame([(0, 0, "sub", "sen", "acc", None)], "story_key long, source_pos int, subject string, sender string, account string, date string")
    urls = spark.createDataFrame([(0, 0, " https://www.x.y/?a&b"), (0, 1, "javascript:z")], "story_key long, url_pos int, url string")
    html = page(render.render(heads, told, sources, urls))
    for part in (
        "<h1>T Tuesday, January 30, 2024</h1>", "<section><h2>AI</h2><div><h3>sub</h3><p>intro</p>", "<h4>t0 &lt;b&gt;</h4>",
        "<li>a&lt;b</li>", "<li>sen — sub (acc)</li>", '<a href="https://www.x.y/?a&amp;b">x.y/?a&amp;b</a>', "<li>javascript:z</li>",
        "<h3>Highlights</h3><p>No news items available for this subcategory.</p></div></section></body></html>",
    ):
        assert part in html
    assert "No News Items" in page(render.render(heads, told.limit(0), sources, urls))


def test_reports(spark):
    news = spark.createDataFrame([("AI", "high"), ("AI", "low"), (None, "high")], "primary_category string, confidence string")
    got = {(r.kind, r.name): r.n for r in reports.classification_summary(news).collect()}
    assert got == {("category", "AI"): 2, ("confidence", "high"): 2, ("confidence", "medium"): 0, ("confidence", "low"): 1}
    for counts, want in (((0, 0, 0), ("error", "Authentication failed")), ((1, 0, 0), ("success", "No news content found")),
                         ((1, 1, 0), ("success", "No extractable news content")), ((1, 1, 1), ("success", "Digest ready"))):
        row = reports.funnel(spark, dict(zip(("accounts", "news_emails", "news_items_extracted"), counts)))
        r = reports.run_status(row).first()
        assert (r.status, r.message) == want

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import broadsheet
from broadsheet.operators import quality, topics

DAY = date(2024, 5, 2)


def test_sections_by_content(spark):
    rows = [(DAY, "AI", i, "bank rates rise", "the bank raised rates again") for i in range(4)]
    rows += [(DAY, "AI", 10 + i, "robots dance", "robots dance on stage") for i in range(3)]
    rows += [(DAY, "AI", 20, None, None), (DAY, "Other", 0, "alone", "word")]
    stories = spark.createDataFrame(rows, "digest_date date, category string, idx long, title string, summary string")
    first, again = (
        {(r.category, r.idx): (r.theme, r.sub_pos, r.subcategory) for r in topics.cluster_sections(s).collect()} for s in (stories, stories.repartition(5)))
    assert first == again and len(first) == len(rows)
    # Equal weights go by the alphabet: again, bank, raised, rates, rise; dance, robots, stage.
    assert {first["AI", i] for i in range(4)} == {("again", 0, "Again / Bank")}
    assert {first["AI", 10 + i] for i in range(3)} == {("dance", 1, "Dance / Robots")}
    assert first["AI", 20] == (None, 2, "Top Stories") and first["Other", 0] == (None, 0, "Top Stories")


def test_a_run_laid_out_by_content(spark):
    now = datetime(2024, 5, 2, 8)
    body = "\n".join(["The market likes quiet inflation figures"] + [f"Election night number {w} in the capital" for w in ("one", "two", "three")])
    mail = spark.createDataFrame(
        [("a", "m", now - timedelta(hours=1), "s", "n <n@x.org>", "d", body)],
        "account string, message_id string, received_at timestamp, subject string, sender string, date string, body string")
    out = broadsheet.run(mail, now, layout=topics.cluster_layout("News for {date}"))
    items = out.digest_items.collect()
    assert len({(r.cat_pos, r.sub_pos, r.idx) for r in items}) == out.stories.count()
    assert out.digest.first().title == "News for Thursday, May 02, 2024"
    assert out.totals.first().ai_categorized_count == out.stories.count()


def test_sketches_stay_within_their_error(spark):
    rows = [(f"storm {'flood' if i % 3 else ''}", "", DAY - timedelta(days=i % 7), f"s{i % 4000}") for i in range(20000)]
    items = spark.createDataFrame(rows, "title string, summary string, digest_date date, source_email_sender string")
    exact = {r.term: r for r in topics.trending(topics.daily_senders(items), DAY, 2, 5).collect()}
    sketched = {r.term: r for r in topics.trending(topics.daily_senders(items, lg_k=12), DAY, 2, 5).collect()}
    assert exact.keys() == sketched.keys() == {"storm", "flood"}
    for term, r in exact.items():
        for field in ("n_recent", "n_base"):
            assert abs(sketched[term][field] - r[field]) <= 3 * 1.04 / math.sqrt(1 << 12) * r[field]


def test_series_have_every_day_and_show_changes(spark):
    counts = [5] * 10 + [0] + [5] * 4 + [20, 21, 20]
    rows = [("a", DAY + timedelta(days=i)) for i, n in enumerate(counts) for _ in range(n)] + [("b", DAY), (None, DAY), ("a", None)]
    items = spark.createDataFrame(rows, "topic string, day date")
    series = topics.topic_series(items, "topic", "day")
    got = {(r.topic, r.day): r for r in topics.change_points(series).collect()}
    assert len(got) == 2 * len(counts)
    a = [got["a", DAY + timedelta(days=i)] for i in range(len(counts))]
    assert [r.n for r in a] == counts and a[0].median is None and a[10].median == 5
    up = 0.0
    for r in a:
        up = max(0.0, up + (r.n - (r.median if r.median is not None else r.n)) - 1)
        assert r.up == up
    assert [i for i, r in enumerate(a) if r.change == 1] == [15] and not any(r.change < 0 for r in a)


def test_source_quality(spark):
    rows = [("big", True, "high")] * 90 + [("big", False, "low")] * 10 + [("lucky", True, "high"), ("odd", True, "huge"), ("odd", None, None)]
    got = {r.sender: r for r in quality.source_quality(spark.createDataFrame(rows, "sender string, is_news boolean, confidence string"), 20).collect()}
    mean = 91 / 103
    assert got["lucky"].confidence == 1 and got["lucky"].quality == pytest.approx((1 + 20 * mean) / 21)
    assert got["big"].quality > got["odd"].quality and (got["odd"].n_mails, got["odd"].n_news, got["odd"].confidence) == (2, 1, 0)
    assert quality.source_quality(spark.createDataFrame([], "sender string, is_news boolean, confidence string")).count() == 0


def pooled(bins):
    """Pool adjacent violators, step by step."""
    blocks = []
    for n, right in bins:
        blocks.append([n, right, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] > blocks[-1][1] * blocks[-2][0]:
            n, right, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + right, blocks[-1][2] + k]
    return [right / n for n, right, k in blocks for _ in range(k)]


def test_calibration_is_isotonic_regression(spark):
    bins = [(10, 1), (5, 3), (10, 2), (4, 0), (8, 6), (8, 5), (2, 2)]
    rows = [((k + 0.5) / 10, i < right) for k, (n, right) in enumerate(bins) for i in range(n)] + [(None, True), (0.1, None)]
    judged = spark.createDataFrame(rows, "score double, good boolean")
    calibration = quality.calibrated(judged, "score", "good", bins=10)
    got = sorted((r.bin, r.n, r.n_right, r.probability) for r in calibration.collect())
    assert [g[:3] for g in got] == [(k, n, right) for k, (n, right) in enumerate(bins)]
    assert [g[3] for g in got] == pytest.approx(pooled(bins))
    kept = quality.confident(judged, calibration, "score", 0.7, bins=10)
    assert kept.count() == sum(n for (n, _), p in zip(bins, pooled(bins)) if p >= 0.7)


def test_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a"), ("a", "b"), ("b", "b"), ("b", None)], "p string, t string")
    got = {(r.predicted, r.actual): (r.n, r.precision, r.recall) for r in quality.confusion(df, "p", "t").collect()}
    assert got["a", "a"] == (2, pytest.approx(2 / 3), 1) and got["b", "b"] == (1, 0.5, 0.5) and got["b", None] == (1, 0.5, 1)

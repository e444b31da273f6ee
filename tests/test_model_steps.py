import json
from datetime import datetime, timedelta

import pytest

import broadsheet
from broadsheet.operators import model_steps as M
from broadsheet.operators.grouping import proposed_groups

NOW = datetime(2024, 5, 2, 8)
MAIL = "account string, message_id string, received_at timestamp, subject string, sender string, date string, body string"


@pytest.fixture(scope="module")
def mail(spark):
    rows = [
        ("a", "m1", NOW - timedelta(hours=2), "Rates", "n1 <one@x.org>", "d1", "rates stay\nparty votes"),
        ("a", "m2", NOW - timedelta(hours=1), "Broken", "n2 <two@x.org>", "d2", "x" * 600),
        ("b", "m3", NOW - timedelta(hours=1), "Refused", None, "d3", None),
        ("b", "m4", NOW - timedelta(hours=1), "Quiet", "n3 <three@x.org>", "d4", "nothing to tell"),
        ("b", "m5", NOW - timedelta(hours=1), "Advert", "n3 <three@x.org>", "d5", "buy"),
    ]
    return spark.createDataFrame(rows, MAIL)


def classify(prompt):
    if "Refused" in prompt:
        raise RuntimeError("no")
    return json.dumps({"is_news": "Advert" not in prompt, "confidence": "high", "reason": "r", "primary_category": "Economy",
                       "secondary_categories": [], "topic_category": None})


def extract(prompt):
    body = prompt.rsplit("\n\n", 1)[1]
    if body.startswith("x"):
        return '{"items": [{"title": "no summary"}]}'
    lines = [] if body.startswith("nothing") else body.split("\n")
    return json.dumps({"items": [{"title": t, "summary": t, "main_topic": "m", "source_urls": [], "key_points": ["k"]} for t in lines]})


def test_run_with_a_model_at_every_step(spark, mail, tmp_path):
    def group(prompt):
        ids = [json.loads(line)["id"] for line in prompt.split("\n\n", 1)[1].splitlines()]
        return json.dumps({"groups": [{"type": "similar", "item_ids": ids[:2], "group_title": "T", "group_summary": "S"}]})

    provider = lambda call: broadsheet.CallProvider(call, waits=())
    out = broadsheet.run(
        mail, NOW, classify=M.classify_with(provider(classify), str(tmp_path / "c")), extract=M.extract_with(provider(extract), str(tmp_path / "e")),
        group=M.group_with(provider(group), str(tmp_path / "g")))
    row = out.funnel.first()
    # m3 has no classification and so is no news; m2 has no usable items and is told as one; m4 tells nothing.
    assert (row.total_emails, row.news_emails, row.news_items_extracted) == (5, 3, 3)
    stories = {(r.title, r.summary, r.group_type, r.original_count) for r in out.stories.collect()}
    # The two first by title are grouped: the broken mail's own item and one of m1.
    assert stories == {("T", "S", "similar", 2), ("rates stay", "rates stay", "unique", 1)}
    assert {r.sender for r in out.sources.collect()} <= {"n1 <one@x.org>", "n2 <two@x.org>"}


def test_fallback_item_of_a_failed_extraction(spark, mail, tmp_path):
    items = M.extract_with(broadsheet.CallProvider(extract, waits=()), str(tmp_path / "e"))(mail.where("message_id IN ('m1', 'm2', 'm4')")).collect()
    assert sorted((r.original_email_id, r.item_pos, r.title) for r in items) == [("m1", 0, "rates stay"), ("m1", 1, "party votes"), ("m2", 0, "Broken")]
    (whole,) = [r for r in items if r.original_email_id == "m2"]
    assert (whole.main_topic, whole.key_points, whole.source_email_subject) == ("General", ["Content from email body"], "Broken")


PLACED = "category string, item_id long, placement_no int, title string, summary string, main_topic string"


def test_prompts_are_bounded_and_hold_every_story(spark, tmp_path):
    rows = [("AI", i, 0, f"b{i % 9} a", "s" * (5000 if i == 3 else 10), "m") for i in range(95)] + [("AI", 4, 1, "again", "s", "m"), ("Other", 900, 0, None, None, None)]
    placed = spark.createDataFrame(rows, PLACED)
    prompts = []
    blocks = M.canopies(placed, 20).collect()
    for ordering in (0, 1):
        assert sorted(r.item_id for r in blocks if r.ordering == ordering) == [*range(95), 900]
    sizes = {}
    for r in blocks:
        sizes.setdefault((r.category, r.ordering, r.block), []).append(r.n)
    assert all(sorted(n) == list(range(len(n))) and len(n) <= 20 for n in sizes.values()) and len(sizes) == 12

    def measure(prompt):
        return json.dumps({"groups": [{"type": "unique", "item_ids": [json.loads(prompt.splitlines()[-1])["id"]], "group_title": str(len(prompt)), "group_summary": ""}]})

    proposed = M.group_with(broadsheet.CallProvider(measure, waits=()), str(tmp_path / "g"), block_items=20)(placed).collect()
    prompts = [int(r.group_title) for r in proposed]
    assert len(prompts) == 12 and max(prompts) < 20 * 200 + M.FIELD_CHARS + 500


def test_answers_that_name_other_stories_propose_nothing(spark, tmp_path):
    placed = spark.createDataFrame([("AI", i, 0, f"t{i}", "s", "m") for i in range(4)] + [("Other", 9, 0, "x", "s", "m")], PLACED)

    def call(prompt):
        ids = [5] if '"t0"' in prompt else []
        return json.dumps({"groups": [{"type": "similar", "item_ids": ids, "group_title": "", "group_summary": ""}]})

    assert M.group_with(broadsheet.CallProvider(call, waits=()), str(tmp_path / "g"))(placed).count() == 0


def test_overlapping_proposals(spark):
    placed = spark.createDataFrame([(c, i, 0, "t", "s", "m") for c in ("AI", "Other") for i in range(6)], PLACED)
    proposals = spark.createDataFrame(
        [("AI", 0, 0, 3), ("AI", 0, 1, 1), ("AI", 1, 0, 1), ("AI", 1, 1, 2), ("AI", 2, 0, 2), ("AI", 2, 1, 4), ("Other", 0, 0, 1), ("Other", 1, 0, 77)],
        "category string, group_pos long, item_pos int, item_id long").selectExpr("*", "'similar' type", "'g' group_title", "'h' group_summary")
    got = {(r.category, r.group_id, r.item_id, r.item_pos) for r in proposed_groups(placed, lambda p: proposals).collect()}
    assert got == {("AI", 1, 3, 0), ("AI", 1, 1, 1), ("AI", 2, 2, 0), ("AI", 2, 4, 1)}

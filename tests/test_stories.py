import pytest
from pyspark.sql import functions as F

from broadsheet.operators import scoring, stories
from broadsheet.operators.skew import join_skewed, number_rows


def test_extraction_and_fallback(spark):
    body = "\n".join(["short", " \t", "", "A" * 45 + ". Second sentence. Third", "Click here to UNSUBSCRIBE from this newsletter now ok"])
    mail = spark.createDataFrame(
        [("a", 1, "s1", body, "AI"), ("a", 2, "s2", "tiny", None), ("a", 3, "s3", "z" * 600, None)],
        "account string, message_id long, subject string, body string, primary_category string")
    rows = stories.extract_stories(mail).collect()
    assert [(r.original_email_id, r.item_pos, r.title, r.main_topic) for r in rows] == [
        (1, 0, "short", "AI"), (1, 1, "A" * 45, "AI"), (2, 0, "tiny", "General"), (3, 0, "z" * 600, "General")]
    assert rows[1].key_points == ["A" * 45, "Second sentence", "Third"]
    ok = spark.createDataFrame([("a", 1), ("a", 2)], "account string, message_id long")
    (only,) = stories.fallback_items(mail, ok).collect()
    assert (only.title, only.summary, only.main_topic, only.key_points) == ("s3", "z" * 500 + "...", "General", ["Content from email body"])


def test_placement_rules(spark):
    rows = [
        (1, "AI", ["Economy"]), (2, "AI", ["AI"]), (3, "AI", ["Sports"]), (4, "Stocks", ["Other", "Other"]),
        (5, None, ["AI"]), (6, "Sports", ["AI"]), (7, "AI", None),
    ]
    df = spark.createDataFrame(rows, "id int, email_primary_category string, email_secondary_categories array<string>")
    placed = stories.place(df)
    got = sorted((r.id, r.category, r.is_secondary_category, r.placement_no) for r in placed.collect())
    assert got == [
        (1, "AI", False, 0), (1, "Economy", True, 0), (2, "AI", False, 0), (3, "AI", False, 0),
        (4, "Other", True, 0), (4, "Other", True, 1), (4, "Stocks", False, 0),
        (5, "Other", False, 0), (6, "Other", False, 0), (7, "AI", False, 0),
    ]
    summary = {r.category: (r.n_primary, r.n_secondary, r.n_missing) for r in stories.placement_summary(placed).collect()}
    assert summary["Other"] == (2, 2, 2) and summary["AI"] == (4, 0, 0)


def test_keyword_precedence(spark):
    rows = [
        ("nothing here", "x", None, "Other"), ("he said", "x", None, "AI"), ("people", "x", None, "Private Equity"),
        ("x", "Inflation!", None, "Economy"), ("stock market", "x", None, "Economy"), ("ai", "x", "Other", "Other"),
        ("TECH", "x", "Sports", "Technology"), ("x", None, None, "Other"),
    ]
    df = spark.createDataFrame(rows, "title string, summary string, known string, want string")
    got = df.select("want", stories.keyword_category(F.col("title"), F.col("summary"), F.col("known")).alias("got"))
    assert all(r.want == r.got for r in got.collect())
    whole = df.select(stories.keyword_category(F.col("title"), F.col("summary"), word_boundary=True).alias("c"), "title")
    assert {r.title: r.c for r in whole.collect()}["he said"] == "Other"


def test_scores_are_checked(spark):
    full = '{"is_news": true, "confidence": "high", "reason": "r", "primary_category": "AI", "secondary_categories": ["Other"], "topic_category": null}'
    rows = [
        (full, True), ("{oops", False), (full.replace("high", "huge"), False), (full.replace("topic_category", "topic"), False),
        ("", False), (full.replace('"AI"', "null"), True), (None, False), (full.replace('"Other"', '"Sports"'), False),
    ]
    df = spark.createDataFrame(rows, "response string, good boolean")
    for r in df.select("good", scoring.validate_classification(F.col("response")).alias("c")).collect():
        assert (r.c.parse_status == "ok") == r.good
        if not r.good:
            assert (r.c.is_news, r.c.confidence, r.c.primary_category, r.c.secondary_categories) == (False, "low", None, [])


def test_scoring_calls_each_text_once_and_resumes(spark, tmp_path):
    log = str(tmp_path / "calls")

    def call(prompt):
        with open(log, "a") as f:
            f.write(prompt + "\n")
        if prompt == "bad":
            raise RuntimeError("no")
        return "" if prompt == "silent" else prompt.upper()

    requests = spark.createDataFrame([(1, "x"), (2, "x"), (3, "bad"), (4, "silent")], "id int, prompt string")
    store = str(tmp_path / "scores")
    first = {r.id: (r.response, r.status, r.attempts) for r in scoring.score(requests, scoring.CallProvider(call, waits=()), store).collect()}
    assert first == {1: ("X", "ok", 1), 2: ("X", "ok", 1), 3: (None, "fallback", 3), 4: (None, "fallback", 1)}
    calls = open(log).read().split()
    assert calls.count("x") == 1 and calls.count("bad") == 3
    again = scoring.score(requests, scoring.CallProvider(str.upper), store)
    assert {r.id: r.response for r in again.collect()} == {1: "X", 2: "X", 3: "BAD", 4: "SILENT"}


def test_call_window_excludes_its_far_edge(spark):
    rows = [("k", 0.0), ("k", 59.9), ("k", 60.0), ("k", 119.95)]
    calls = spark.createDataFrame(rows, "k string, s double").withColumn("at", F.timestamp_micros((F.col("s") * 1_000_000).cast("long")))
    got = {r.s: (r.calls_in_window, r.over_limit) for r in scoring.rolling_calls(calls, "k", "at", limit=1).collect()}
    assert got == {0.0: (1, False), 59.9: (2, True), 60.0: (2, True), 119.95: (2, True)}


def test_numbering_spans_tasks(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("o"), "id")
    from pyspark.sql import Window
    want = df.withColumn("w", F.row_number().over(Window.partitionBy("g").orderBy("o")) - 1)
    got = number_rows(df, ["g"], ["o"], "n")
    assert want.join(got, ["g", "o", "id"]).where("w <> n").count() == 0 and got.count() == 20_000
    hot = number_rows(df.withColumn("g", F.lit(None).cast("long")), ["g"], ["o"], "n")
    assert hot.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first() == (0, 19_999, 20_000)


def test_skewed_join_equals_join(spark):
    left = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), "id")
    right = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    plain = left.join(right, "k")
    for got in (join_skewed(left, right, ["k"], heavy_rows=500), join_skewed(left, right, ["k"], rows=5_000)):
        assert got.exceptAll(plain).count() == 0 and got.count() == plain.count()


def test_step_down_and_rate(spark, tmp_path):
    def broken(prompt):
        raise RuntimeError("no")

    provider = scoring.CallProvider(broken, waits=(), step_down=(broken, str.upper))
    requests = spark.createDataFrame([(1, "x"), (2, "y")], "id int, prompt string")
    scored = scoring.score(requests, provider, str(tmp_path / "s"), tasks=1, calls_per_minute=6000)
    assert {(r.response, r.attempts, r.status) for r in scored.collect()} == {("X", 3, "ok"), ("Y", 3, "ok")}
    assert provider.at_rate(30).calls_per_minute == 30


class Breaks(scoring.ScoreProvider):
    """Answers everything but fails the task at one prompt."""

    def __init__(self, at):
        self.at = at

    def score(self, batches):
        for batch in batches:
            if self.at in set(batch["prompt"]):
                raise RuntimeError("the task dies")
            yield batch.assign(response="paid", attempts=1, status="ok")[["request_hash", "response", "attempts", "status"]]


def test_a_run_that_breaks_keeps_the_parts_it_has_paid_for(spark, tmp_path):
    requests = spark.createDataFrame([(f"p{i}",) for i in range(40)], "prompt string")
    part = F.pmod(F.xxhash64(F.sha2("prompt", 256)), F.lit(4))
    counts = {r.part: (r.n, r.one) for r in requests.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("prompt").alias("one")).collect()}
    store = str(tmp_path / "s")
    with pytest.raises(Exception, match="the task dies"):
        scoring.score(requests, Breaks(counts[2][1]), store)
    assert spark.read.parquet(store).count() == counts[0][0] + counts[1][0]
    done = scoring.score(requests, scoring.CallProvider(str.upper), store).groupBy("response").count().collect()
    assert sum(r["count"] for r in done) == 40 and {r.response: r["count"] for r in done}["paid"] == counts[0][0] + counts[1][0]

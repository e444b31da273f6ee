"""Steps whose results stay but that once moved, wrote or computed much more."""

from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from broadsheet.operators import similarity
from broadsheet.operators.scoring import classify_rules, news_only
from broadsheet.plans import story_queries
from broadsheet.sources.archive import write_archive
from broadsheet.session import shared_dir
from broadsheet.streaming import jobs
from broadsheet.streaming.sink import archive_unseen


def test_lsh_moves_only_sets_of_stories_that_meet(spark, monkeypatch):
    tables, real = {}, similarity.materialise

    def kept(df, label="table", codec=None):
        tables[label] = real(df, label, codec)
        return tables[label]

    monkeypatch.setattr(similarity, "materialise", kept)
    rows = [("s", i, f"one{i} two{i} three{i} four{i} five{i}") for i in range(20)] + [("s", 20, "one3 two3 three3 four3 five3")]
    links = similarity.lsh_links(spark.createDataFrame(rows, "scope string, id long, text string"))
    assert [(r["a"], r["b"]) for r in links.collect()] == [(3, 20)]
    assert "_h" not in tables["minhash"].columns
    assert sorted(r["id"] for r in tables["meeting-sets"].collect()) == [3, 20]


def test_news_filter_does_not_repeat_the_text(spark, plan, tmp_path):
    path = str(tmp_path / "mail")
    spark.createDataFrame([("a b", "c d")], "subject string, body string").write.parquet(path)
    assert plan(news_only(classify_rules(spark.read.parquet(path)))).count("lower(concat_ws") <= 6


def test_archive_writes_a_file_per_day_and_not_per_task(spark, tmp_path):
    path = str(tmp_path / "archive")
    rows = [(i, f"story number {i} of the day", datetime(2024, 1, 1 + i % 3, 8)) for i in range(240)]
    stories = spark.createDataFrame(rows, "story_id long, text string, received_at timestamp").withColumn("digest_date", F.to_date("received_at"))
    # Otherwise so few rows would end in one task, as many do not.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        archive_unseen(stories.repartition(8), 0, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for table in ("stories", "index"):
        assert len(list(Path(path, table).rglob("*.parquet"))) == 3
    assert spark.read.parquet(f"{path}/stories").count() == 240


def test_dated_archive_writes_a_file_per_day_and_not_per_task(spark, tmp_path):
    rows = spark.range(240).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("digest_date"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_archive(rows.repartition(8), str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list(tmp_path.rglob("*.parquet"))) == 3 and spark.read.parquet(str(tmp_path)).count() == 240


def test_a_batch_of_the_archive_leaves_nothing_else_behind(spark, tmp_path):
    shared = Path(shared_dir(spark).removeprefix("file:"), "broadsheet")
    before = {p.name for p in shared.glob("*")}
    rows = [(i, f"story number {i % 9} of the day", datetime(2024, 1, 1 + i % 3, 8)) for i in range(20)]
    stories = spark.createDataFrame(rows, "story_id long, text string, received_at timestamp").withColumn("digest_date", F.to_date("received_at"))
    archive_unseen(stories, 0, str(tmp_path / "archive"))
    assert {p.name for p in shared.glob("*")} == before
    assert {p.name for p in tmp_path.glob("archive/*")} == {"stories", "index"}


def test_a_replay_keeps_its_rows_once(spark):
    shared = Path(shared_dir(spark).removeprefix("file:"), "broadsheet")
    before = set(shared.glob("*/**/*.parquet"))
    mail = spark.range(100).select("id", F.timestamp_seconds("id").alias("at"))
    jobs.replay(mail, "at", lambda stream, folder: None, slices=3, closing=None)
    written = [str(p) for p in set(shared.glob("*/**/*.parquet")) - before]
    assert spark.read.parquet(*written).count() == 100


def test_merged_items_are_made_once(spark, plan):
    merged = story_queries.merged_stories(spark, "/root/testdata/sf0.001", written=True)
    for table in (merged.stories, merged.urls, merged.accounts):
        assert "documents.parquet" not in plan(table)

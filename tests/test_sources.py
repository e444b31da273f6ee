import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from broadsheet.plans import digest_queries
from broadsheet.sources import archive, messages as M


def test_export_and_quarantine(spark, tmp_path):
    good = {"account": "a", "message_id": "1", "headers": [{"name": "Subject", "value": "s"}], "parts": []}
    (tmp_path / "in.json").write_text(json.dumps(good) + "\n{broken\n")
    ok, bad = M.split_corrupt(M.read_export(spark, str(tmp_path)).cache())
    assert [r.message_id for r in ok.collect()] == ["1"]
    assert [r._corrupt_record for r in bad.collect()] == ["{broken"]


def test_sender_list_and_exclusion(spark):
    senders = M.sender_list(" A@x.org, ,b@x.org,A@x.org", "me@x.org")
    assert senders == ["A@x.org", "b@x.org", "me@x.org"]
    df = spark.createDataFrame(
        [(1, "Ann <a@X.org>"), (2, "b@x.org"), (3, "c@x.org"), (4, None)], "id int, sender string")
    want = {3, 4}
    assert {r.id for r in M.exclude_senders(df, senders).collect()} == want
    as_table = spark.createDataFrame([(s,) for s in senders], "address string")
    assert {r.id for r in M.exclude_senders(df, as_table).collect()} == want


def test_trailing_prunes_partitions(spark, tmp_path, plan):
    rows = [(i, datetime(2024, 1, 1 + i), f"2024-01-{1 + i:02d}") for i in range(9)]
    spark.createDataFrame(rows, "id int, received_at timestamp, day string").write.partitionBy("day").parquet(str(tmp_path / "m"))
    mail = spark.read.parquet(str(tmp_path / "m"))
    recent = M.trailing(mail, datetime(2024, 1, 9), days=2).where("day >= '2024-01-07'")
    assert {r.id for r in recent.collect()} == {7, 8}
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(day" in text and "GreaterThan(received_at" in text


def test_union_keeps_copies(spark):
    box = spark.createDataFrame([("m1",)], "message_id string")
    whole = M.union_accounts({"a@x": ("A", box), "b@x": ("B", box)})
    assert {(r.account, r.account_name, r.message_id) for r in whole.collect()} == {("a@x", "A", "m1"), ("b@x", "B", "m1")}


def test_stories_with_missing_fields(spark, tmp_path):
    path = tmp_path / "s.json"
    path.write_text(json.dumps({"items": [{"title": "t", "summary": "s", "source_urls": ["u"]}, {"title": "t2"}]}, indent=2))
    rows = M.read_stories(spark, str(path)).orderBy("title").collect()
    assert [(r.title, r.summary, r.source_urls, r.original_count) for r in rows] == [("t", "s", ["u"], None), ("t2", None, None, None)]


def test_archive_replaces_its_dates_only(spark, tmp_path):
    path = str(tmp_path / "a")
    day = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "digest_date string, v int")
    archive.write_archive(day, path)
    archive.write_archive(day.where("v = 2").withColumn("v", F.lit(5)), path)
    assert {(str(r.digest_date), r.v) for r in spark.read.parquet(path).collect()} == {("2024-01-01", 1), ("2024-01-02", 5)}


def test_outbox_splits_long_lists(spark):
    digests = spark.createDataFrame([("AI", "T1"), ("Other", "T2")], "category string, title string")
    people = spark.createDataFrame([("AI", f"r{i:03d}") for i in range(250)], "category string, recipient string")
    rows = archive.outbox(digests, people, "me").orderBy("category", "message_no").collect()
    assert [(r.category, r.message_no, r.n_recipients) for r in rows] == [("AI", 0, 100), ("AI", 1, 100), ("AI", 2, 50), ("Other", 0, 1)]
    assert rows[0].to_line.startswith("r000, r001") and rows[3].to_line == "me"


def test_pages_are_written_in_order(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01", i, f"<{i}>") for i in (3, 1, 2)], "digest_date string, pos int, html string")
    archive.write_pages(df, str(tmp_path / "p"), ["pos"])
    files = sorted((tmp_path / "p" / "digest_date=2024-01-01").glob("*.txt"))
    assert "".join(f.read_text() for f in files).split() == ["<1>", "<2>", "<3>"]


def test_landing_table_is_pruned_by_account_and_day(spark, tmp_path, plan):
    rows = [(f"a{i % 2}", i, datetime(2024, 1, 1 + i // 4, i % 4)) for i in range(40)] + [("a0", 99, None)]
    mail = spark.createDataFrame(rows, "account string, message_id long, received_at timestamp")
    path = str(tmp_path / "landing")
    for _ in range(2):  # a repeated load replaces its own folders
        M.write_landing(mail, path)
    landing = M.read_messages(spark, path)
    assert sorted(r.message_id for r in landing.collect()) == sorted(r[1] for r in rows)
    recent = M.trailing(landing, datetime(2024, 1, 10, 3), 1)
    assert {r.message_id for r in recent.collect()} == {36, 37, 38, 39}
    text = plan(recent)
    assert "PartitionFilters: [isnotnull(received_date" in text and ">= 2024-01-09" in text

    clocks = spark.createDataFrame([("a0", datetime(2024, 1, 3, 2)), ("a1", None)], "account string, as_of timestamp")
    own = M.trailing_by_account(landing, clocks)
    # The row just a day old is out, the one at the clock is in, and nothing comes from later days.
    assert {r.message_id for r in own.collect()} == {8, 10}


def test_clocks_prune_folders_at_run_time(spark, tmp_path, plan):
    rows = [(f"a{i % 7}", i, datetime(2024, 1, 1 + i % 28)) for i in range(500)]
    M.write_landing(spark.createDataFrame(rows, "account string, message_id long, received_at timestamp"), str(tmp_path / "m"))
    spark.createDataFrame([(f"a{i}", datetime(2024, 1, 28)) for i in range(7)], "account string, as_of timestamp").write.parquet(str(tmp_path / "clocks"))
    clocks = spark.read.parquet(str(tmp_path / "clocks")).where("account = 'a3'")
    text = plan(M.trailing_by_account(M.read_messages(spark, str(tmp_path / "m")), clocks))
    assert "dynamicpruning" in text


@pytest.mark.parametrize("lines, kind", [(2, "bigint"), (1500, "decimal(30,0)")])
def test_sums_of_a_day_are_exact_beyond_64_bits(spark, tmp_path, lines, kind):
    first = 3_000_000
    spark.createDataFrame([(first, "\n".join(f"line {i}" for i in range(lines)), "en", "a")], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(first, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    told = digest_queries.archive_roundtrip(spark, str(tmp_path))
    assert dict(told.dtypes)["id_sum"] == kind
    assert [(r.n, int(r.id_sum)) for r in told.collect()] == [(lines, sum(first * 2**31 + i for i in range(lines)))]

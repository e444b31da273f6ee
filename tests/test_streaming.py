import random
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from broadsheet.streaming import jobs, memory, progress, sink

SCHEMA = "account string, message_id long, received_at timestamp, body string"
START = datetime(2024, 1, 1)


def feed(spark, tmp_path, batches):
    """One file per batch, read one per trigger in order."""
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(folder / f"b{i}"))
    paths = str(folder / "*")
    return jobs.read_files(spark, paths, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def row(i, hours, body="x"):
    return ("a", i, START + timedelta(hours=hours), body)


def test_redelivery_and_late_rows(spark, tmp_path):
    stream = feed(spark, tmp_path, [[row(1, 0), row(2, 1), row(1, 0)], [row(1, 0), row(3, 100)], [row(4, 99)], [row(5, 1)]])
    out = jobs.run_to_table(jobs.drop_redelivered(stream), "t")
    # late rows are judged by the watermark of the batch before; message 5 is too late
    assert sorted(r.message_id for r in out.collect()) == [1, 2, 3, 4]


def test_daily_counts_close_windows(spark, tmp_path):
    stream = feed(spark, tmp_path, [[row(1, 1), row(2, 2)], [row(3, 26), row(4, 3)], [row(5, 60)], [row(7, 61)], [row(6, 5)]])
    out = jobs.run_to_table(jobs.window_counts(stream, "account", "received_at", delay="2 hours"), "t")
    # message 4 came before the first day closed, message 6 after
    assert {(r.window_start, r.n) for r in out.collect()} == {(START, 3), (START + timedelta(days=1), 1)}


@pytest.fixture
def two_tasks(spark):
    """State is kept per shuffle partition; small feeds need few."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_first_coverage_forgets(spark, tmp_path, two_tasks):
    stream = feed(spark, tmp_path, [[row(i, i / 100, "Same  text") for i in range(50)] + [row(60, 0, "other"), row(59, 1, None)],
                                    [row(61, 5, "same text"), row(62, 24 * 20, "z")], [row(64, 24 * 20, "z")],
                                    [row(63, 24 * 21, "SAME TEXT")], [row(65, 24 * 40, "still open")]])
    out = jobs.run_to_table(memory.first_coverage(stream, "body", ("message_id", "body"), days=7), "t").collect()
    assert sorted((r.message_id, r.body) for r in out) == [(0, "Same  text"), (60, "other"), (62, "z"), (63, "SAME TEXT")]
    assert {r.received_at for r in out if r.message_id in (0, 60)} == {START}


def told_again(rows, days):
    """Rows of texts that were not seen for ``days``, by the definition."""
    last, out = {}, []
    for _, i, at, body in sorted(rows, key=lambda r: (r[2], r[1])):
        if body not in last or at - last[body] >= timedelta(days=days):
            out.append(i)
        last[body] = at
    return out


@pytest.mark.parametrize("slices", [1, 4])
def test_coverage_does_not_depend_on_files(spark, two_tasks, slices):
    rng = random.Random(5)
    rows = [row(i, rng.random() * 24 * 40, rng.choice("abcdefgh")) for i in range(60)]
    mail = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = jobs.replayed_table(mail, "received_at", lambda s: memory.first_coverage(s, "body", ("message_id",), days=5), slices)
    assert sorted(r.message_id for r in out.collect()) == sorted(told_again(rows, 5))


def test_replay_keeps_every_row(spark):
    """Slices in order, equal times together, rows without a time in the first one."""
    rows = [row(i, i // 10) for i in range(50)] + [("a", 99, None, "no time")]
    seen = []
    jobs.replay(spark.createDataFrame(rows, SCHEMA), "received_at", lambda stream, folder: seen.append(
        {r.message_id for r in jobs.run_to_table(stream, "t").collect()}), slices=3, closing=None)
    assert seen[-1] == {*range(50), 99} and len(seen) == 3
    assert 99 in seen[0] and seen[0] < seen[1] < seen[2]
    assert all(len(s - {99}) % 10 == 0 for s in seen)


def similar(a, b, width=3, num=8, den=10):
    grams = [{tuple(ws[i:i + width]) for i in range(len(ws) - width + 1)} for ws in (a.lower().split(), b.lower().split())]
    shared = len(grams[0] & grams[1])
    return a.lower() == b.lower() or (shared > 0 and shared * den >= len(grams[0] | grams[1]) * num)


def test_sink_tells_every_story_once(spark, tmp_path):
    rng = random.Random(8)
    bases = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([2, 20, 40]))] for _ in range(8)]
    rows = []
    for i in range(150):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 6])):
            words[rng.randrange(len(words))] = f"n{rng.randrange(1000)}"
        rows.append((i, START + timedelta(hours=rng.randrange(24 * 30)), " ".join(words).title() if i % 4 else " ".join(words)))
    rows += [(200, START, None), (201, None, "no time here")]
    rows.sort(key=lambda r: (r[1] or START, r[0]))
    want = []
    for k, (i, at, text) in enumerate(rows):
        if text is None or at is None:
            continue
        earlier = [r for r in rows[:k] if None not in r and r[1] > at - timedelta(days=7)]
        if not any(similar(text, t) for _, _, t in earlier):
            want.append(i)
    schema = "story_id long, received_at timestamp, text string"
    cuts = [0, 60, 61, 110, len(rows)]
    batches = [
        spark.createDataFrame(rows[a:b], schema).withColumn("digest_date", F.to_date("received_at")) for a, b in zip(cuts, cuts[1:])]
    path = str(tmp_path / "archive")

    def told():
        return sorted(r.story_id for r in spark.read.parquet(f"{path}/stories").collect())

    for number, batch in enumerate(batches):
        sink.archive_unseen(batch, number, path)
    assert told() == sorted(want) and 20 < len(want) < 130
    for number in (1, 3, 2):  # batches that run again change nothing
        sink.archive_unseen(batches[number], number, path)
    assert told() == sorted(want)


def test_sink_over_a_stream(spark, tmp_path):
    stream = feed(spark, tmp_path, [[row(1, 1, "a b c d"), row(2, 2, "A  b c d"), row(3, 30, "other")], [row(4, 31, "a b c d"), row(5, 24 * 9, "other")]])
    dated = stream.withColumn("digest_date", F.to_date("received_at"))
    for _ in range(2):  # the second run finds nothing new
        sink.archive_stories(dated, str(tmp_path / "out"), str(tmp_path / "progress"), text="body", key="message_id")
    got = spark.read.parquet(str(tmp_path / "out/stories"))
    assert sorted((r.message_id, r.batch_id) for r in got.collect()) == [(1, 0), (3, 0), (5, 1)]


def test_archive_batches(spark, tmp_path):
    stream = feed(spark, tmp_path, [[row(1, 1), row(2, 30)], [row(3, 2)]])
    dated = stream.withColumn("digest_date", F.to_date("received_at"))
    for _ in range(2):  # the second run finds nothing new
        jobs.archive_batches(dated, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got = sorted((str(r.digest_date), r.message_id) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [("2024-01-01", 1), ("2024-01-01", 3), ("2024-01-02", 2)]


def test_stage_progress_of_a_stream(spark, tmp_path):
    listener = progress.StageProgress()
    spark.streams.addListener(listener)
    try:
        stream = feed(spark, tmp_path, [[row(1, 1), row(2, 2)], [row(3, 26)]])
        seen = progress.watched(stream, "mail", n=F.count(F.lit(1)))
        jobs.run_to_table(progress.watched(seen.where("message_id <> 2"), "kept", n=F.count(F.lit(1))), "t")
        for _ in range(50):
            if len(listener.rows) >= 4:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert {(r.stage, r.batch_id, r.n) for r in listener.table(spark).collect()} == {("mail", 0, 2), ("kept", 0, 1), ("mail", 1, 1), ("kept", 1, 1)}


def test_coverage_runs_in_a_session_without_settings(spark, two_tasks):
    """Spark's default state store holds no timers, and a session that get_session did not make has it."""
    ours = spark.conf.get(memory.STATE_STORE)
    spark.conf.set(memory.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        mail = spark.createDataFrame([row(1, 0, "a"), row(2, 1, "A"), row(3, 200, "a")], SCHEMA)
        out = jobs.replayed_table(mail, "received_at", lambda s: memory.first_coverage(s, "body", ("message_id",), days=5), 1)
        assert sorted(r.message_id for r in out.collect()) == [1, 3]
    finally:
        spark.conf.set(memory.STATE_STORE, ours)


def test_coverage_after_the_last_time_that_pandas_knows(spark, two_tasks):
    far = datetime(2309, 5, 1)
    mail = spark.createDataFrame([("a", 1, far, "x"), ("a", 2, far + timedelta(days=1), "X"), ("a", 3, far + timedelta(days=9), "x")], SCHEMA)
    out = jobs.replayed_table(mail, "received_at", lambda s: memory.first_coverage(s, "body", ("message_id",), days=7), 1)
    assert sorted((r.message_id, r.received_at) for r in out.collect()) == [(1, far), (3, far + timedelta(days=9))]

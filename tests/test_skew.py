import re

import pytest
from pyspark.sql import functions as F

from broadsheet.config import SimilarityConfig
from broadsheet.operators import skew
from broadsheet.operators.grouping import passthrough
from broadsheet.operators.similarity import piece_postings, shingle_sets
from broadsheet.session import materialise


@pytest.mark.parametrize("listed", [skew.LISTED, 0])
def test_among_and_without_are_semi_and_anti_joins(spark, monkeypatch, listed):
    """Keys sent as a list and as a map of bits; null and repeated keys on both sides."""
    monkeypatch.setattr(skew, "LISTED", listed)
    monkeypatch.setattr(skew, "MAP_BITS", 1 << 7)
    rows = [("a" if i % 3 else None, i % 40 if i % 7 else None, i) for i in range(200)]
    left = materialise(spark.createDataFrame(rows, "scope string, id long, n long"))
    keys = materialise(spark.createDataFrame([r[:2] for r in rows if (r[1] or 0) % 5 == 1] * 2 + [(None, None), ("b", 1)], "scope string, id long"))
    for got, how in ((skew.among, "left_semi"), (skew.without, "left_anti")):
        want = left.join(keys, ["scope", "id"], how)
        assert sorted(got(left, keys, ["scope", "id"]).collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("listed", [10, 0])
def test_single_items_are_not_moved(spark, plan, monkeypatch, listed):
    """What is in no group passes without a shuffle, however many groups there are."""
    monkeypatch.setattr(skew, "LISTED", listed)
    monkeypatch.setattr(skew, "MAP_BITS", 1 << 7)
    columns = ", ".join(f"source_{c} string" for c in ("email_subject", "email_sender", "email_date", "account"))
    placed = materialise(spark.createDataFrame([("A", i, "s", "n", "d", "x") for i in range(30)], f"category string, item_id long, {columns}"))
    groups = materialise(spark.createDataFrame([("A", 1), ("A", 2)], "category string, item_id long"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        single = passthrough(placed, groups)
        assert sorted(r.item_id for r in single.collect()) == [0, *range(3, 30)]
        told = plan(single).split("== Initial Plan ==")[0].split("(1) Scan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    if listed:
        assert "SortMergeJoin" not in told
    else:
        assert "Union" in told and "BroadcastHashJoin" in told


def test_numbering_moves_rows_once(spark, plan):
    """The offsets of the runs go to the rows, not the rows to the offsets."""
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = skew.number_rows(rows, ["k"], ["id"], "n")
        assert "SortMergeJoin" not in plan(numbered)
        assert {(r.id, r.n) for r in numbered.collect()} == {(i, i // 3) for i in range(1000)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_pieces_are_short(spark, plan):
    """A piece is moved with its story's key and one number, not with six."""
    sets = shingle_sets(spark.createDataFrame([("s", i, " ".join(f"w{j}" for j in range(60))) for i in range(2)], "scope string, id long, text string"))
    moved = re.findall(r"\) Exchange\nInput \[(\d+)\]: \[[^\]]*\bpiece#", plan(piece_postings(sets, SimilarityConfig())))
    assert moved and all(int(columns) <= 4 for columns in moved)


def test_a_map_of_keys_is_sent_in_few_rows(spark, monkeypatch):
    """The driver holds what is sent: a row for many words of the map, and no long list of keys."""
    assert skew.LISTED <= 100_000
    monkeypatch.setattr(skew, "LISTED", 0)
    monkeypatch.setattr(skew, "MAP_BITS", 1 << 16)
    sent, real = [], F.broadcast
    monkeypatch.setattr(skew.F, "broadcast", lambda df: sent.append(df) or real(df))
    rows = spark.range(30_000).select("id")
    keys = materialise(rows.where("id % 3 = 0"))
    assert skew.among(rows, keys, ["id"]).count() == 10_000 and skew.without(rows, keys, ["id"]).count() == 20_000
    # 1,024 words of 64 bits.
    assert max(df.count() for df in sent) <= 16

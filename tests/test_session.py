import os

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import scoring
from broadsheet.session import discard, intermediate, materialise, metered, read_if_there


def there(table):
    return os.path.exists(table._written_to.removeprefix("file:"))


def test_intermediate_tables_go_and_kept_ones_stay(spark):
    with intermediate(spark) as keep:
        gone, outer = materialise(spark.range(3)), materialise(spark.range(4))
        with intermediate(spark) as hold:
            inner, held, kept = materialise(spark.range(5)), hold(materialise(spark.range(6))), hold(materialise(spark.range(7)))
        assert not there(inner) and there(held) and there(kept)
        keep(kept)
        discard(gone)
        assert not there(gone)
    assert not there(outer) and not there(held)
    assert there(kept) and kept.count() == 7
    with pytest.raises(RuntimeError), intermediate(spark):
        lost = materialise(spark.range(1))
        raise RuntimeError
    assert not there(lost)
    assert there(materialise(spark.range(2)))


def test_metrics_of_the_pass_that_writes(spark, plan):
    table, seen = metered(spark.range(10), "numbers", n=F.count(F.lit(1)), odd=F.count_if(F.col("id") % 2 == 1))
    assert (table.count(), seen) == (10, {"n": 10, "odd": 5})
    assert "CollectMetrics" in plan(spark.range(10).observe("m", F.count(F.lit(1)).alias("n")))


def test_only_a_missing_table_is_none(spark, tmp_path):
    assert read_if_there(spark, str(tmp_path / "nothing"), "a int") is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("no")
    with pytest.raises(Exception):
        read_if_there(spark, str(tmp_path / "bad"), "a int").count()


def test_words_weigh_by_their_examples(spark):
    rows = [(1, "rates", "bank", True), (2, "rates", "fund", True), (3, "sale", "buy", False)]
    mail = spark.createDataFrame(rows, "message_id long, subject string, body string, is_news boolean")
    more = spark.createDataFrame([(7, "Rates", None), (8, "SALE buy sale", ""), (9, "unheard", ""), (10, None, None)], "message_id long, subject string, body string")
    got = {r.message_id: (round(r.log_odds, 9), r.is_news) for r in scoring.classify_counts(more, mail).collect()}
    import math

    before = math.log(3 / 2)
    assert got[7] == (round(before + math.log(3 / 4) - math.log(1 / 3), 9), True)
    assert got[8] == (round(before + 2 * (math.log(1 / 4) - math.log(2 / 3)), 9), False)
    assert got[9] == got[10] == (round(before, 9), True)

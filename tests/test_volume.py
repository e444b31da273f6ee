"""How much of a table a step moves and writes."""

from datetime import date

from pyspark.sql import functions as F

from broadsheet import session
from broadsheet.operators import digest as D
from broadsheet.plans import topic_queries
from broadsheet.session import materialise


def test_curate_moves_only_stories_with_a_slot(spark, plan):
    """The items are held against the slots where they lie, before the join that moves them."""
    items = materialise(spark.range(100).select(
        F.lit(date(2024, 1, 1)).alias("digest_date"), F.col("id").alias("idx"), F.lit("t").alias("title"), F.lit("s").alias("summary")))
    slots = spark.createDataFrame(
        [(date(2024, 1, 1), 0, "A", 0, "x", "", 0, 7), (date(2024, 1, 1), 0, "A", 0, "x", "", 1, -1), (date(2024, 1, 1), 0, "A", 0, "x", "", 2, 500)],
        "digest_date date, cat_pos int, category string, sub_pos int, subcategory string, intro string, slot_pos int, item_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        curated = D.curate(items, slots)
        assert "LeftSemi" in plan(curated)
        assert sorted(r.idx for r in curated.collect()) == [7, 99]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sections_are_numbered_on_what_they_read(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "One. Two.\nThree words here", "en", "src", 10)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(session, "new_folder", lambda _, label: f"{tmp_path}/{label}")
    assert topic_queries.sectioned(spark, str(tmp_path)).count() == 2
    assert not {"key_points", "source_urls", "source_email_subject"} & set(spark.read.parquet(f"{tmp_path}/ordered").columns)

"""Plan shapes that must survive changes."""

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.mime import select_bodies
from broadsheet.operators.similarity import _cold_pairs, prefix_postings, shingle_sets
from broadsheet.config import SimilarityConfig
from broadsheet.plans import catalog, text_queries, views as V

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
ALL_PAIRS = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", [
    "extract_stories", "category_placement", "keyword_category", "classify_rules", "validate_scores", "exact_duplicates",
    "select_body", "html_to_text", "tag_policy_strip", "route_prompt", "section_topk", "rolling_call_rate", "top_stories",
])
def test_no_python_and_no_all_pairs(spark, plan, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert not any(node in text for node in PYTHON_NODES + ALL_PAIRS)


def test_scans_read_needed_columns_only(spark, plan):
    assert "ReadSchema: struct<url:string>" in plan(catalog.QUERIES["clean_url"](spark, SF).select("host"))
    text = plan(catalog.QUERIES["placement_summary"](spark, SF))
    assert "source:string" not in text and "toxic" not in text


def test_filters_reach_the_scan(spark, plan):
    mail = V.table(spark, SF, "events").where("event_id > 500").select("event_id")
    assert "PushedFilters: [IsNotNull(event_id), GreaterThan(event_id,500)]" in plan(mail)
    assert "EqualTo(quality,1)" in plan(V.table(spark, SF, "labels").where("quality = 1"))


def test_bodies_need_one_shuffle(spark, plan):
    bodies = select_bodies(text_queries.message_parts(spark, SF), ["message_id"])
    assert plan(bodies).count("Exchange") // 2 <= 1


def test_partial_aggregation_before_shuffles(spark, plan):
    text = plan(catalog.QUERIES["exact_duplicates"](spark, SF))
    assert "partial_count" in text and "partial_min" in text


def test_candidates_join_on_shingles(spark, plan):
    config = SimilarityConfig()
    docs = V.table(spark, SF, "documents").select(F.lit("x").alias("scope"), F.col("doc_id").alias("id"), "text")
    sets = shingle_sets(docs, config)
    postings = prefix_postings(sets, 10_000, config)
    cold = postings.groupBy("scope", "gram").count().where("count between 2 and 100").select("scope", "gram")
    text = plan(_cold_pairs(postings, cold, config))
    assert not any(node in text for node in ALL_PAIRS + PYTHON_NODES)


def test_dimension_is_broadcast(spark, plan):
    assert "BroadcastHashJoin" in plan(catalog.QUERIES["route_prompt"](spark, SF))

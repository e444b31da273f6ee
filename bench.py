"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
cores. Every query is run to completion once after a short warm-up; rows go to
Spark's no-op sink, so that all columns are computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import time

from broadsheet.plans.catalog import QUERIES
from broadsheet.session import get_session

HEADLINE = (
    "top_stories", "dedup_stories", "similar_pairs", "lsh_pairs", "story_clusters", "reconcile_groups",
    "extract_stories", "category_placement", "keyword_category", "exact_duplicates", "classify_rules",
    "validate_scores", "structured_score", "select_body", "html_to_text", "tag_policy_strip", "extract_urls",
    "escape_html", "item_index", "curate_digest", "render_digest", "source_attribution", "funnel",
    "rolling_call_rate", "stage_progress", "recipient_outbox", "archive_roundtrip", "stream_dedup",
    "stream_daily_counts", "sliding_counts", "sender_sessions",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(
        "bench", **{
            "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["scan_messages"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cores": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

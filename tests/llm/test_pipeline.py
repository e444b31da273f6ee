"""The stages one by one against brute force, and the run as a whole."""

import corpus_pipeline
from broadsheet.llm import ngram_join, toxicity
from broadsheet.llm.common import documents, table

from .test_native import near_targets
from .test_similar import brute_groups

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs, counts = documents(spark, SF), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        after = spark.read.parquet(str(tmp_path / str(k)))
        rows = after.collect()
        counts.append(len(rows))
        if k < 4:
            assert after.columns == docs.columns
        if k == 0:
            scores = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels"))).collect()
            assert {r.doc_id for r in rows} == {r.doc_id for r in scores if r.score < 0.5}
        elif k == 1:
            last = {}
            for i in sorted(before):
                last[before[i]] = i
            assert sorted(r.doc_id for r in rows) == sorted(last.values())
        elif k == 2:
            groups = brute_groups(before.items(), ngram_join.Spec(5, 80, 100))
            assert sorted(r.doc_id for r in rows) == sorted(i for i, (_, c) in groups.items() if c == i)
        elif k == 3:
            near_targets(docs, after)
            assert all(before[r.doc_id] == r.text for r in rows)
        docs = after
    assert counts[4] == counts[3] == corpus_pipeline.run(spark, SF).count()

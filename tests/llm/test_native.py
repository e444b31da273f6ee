"""License scan, mixing and exact dedup: SQL on hand rows, properties on the tables."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest

from broadsheet.llm import exact_dedup, license_scan, mixing

PYTHON = ("Python", "Pandas", "Arrow", "ExistingRDD")


def rows(df, columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("operator, sql", [
    (license_scan.license_labels, license_scan.sql()), (exact_dedup.exact_dedup, exact_dedup.SQL), (mixing.mixed_sizes, mixing.SQL),
])
def test_sql_on_odd_rows(odd_docs, operator, sql):
    """Ids and rows are made different first, since the SQL takes ids as keys."""
    docs = odd_docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).cache()
    documents = docs.toPandas()  # noqa: F841 - DuckDB reads it by name
    want = duckdb.sql(sql)
    got = rows(operator(docs), want.columns)
    assert got == Counter(want.fetchall())
    docs.unpersist()


@pytest.mark.parametrize("operator", [license_scan.license_labels, exact_dedup.exact_dedup, mixing.mixed_sizes])
def test_rows_in_rows_out(odd_docs, no_docs, sf_docs, operator, plan):
    out = operator(odd_docs)
    assert out.count() == odd_docs.count()
    assert rows(out.select("doc_id"), ["doc_id"]) == rows(odd_docs, ["doc_id"])
    assert operator(no_docs).count() == 0
    assert not [word for word in PYTHON if word in plan(operator(sf_docs))]


def test_license_places(spark):
    text = "cc by nc by nc, UNDER the mit License; apache license version 2.0 cc BY-NC"
    notice = license_scan.NOTICES[0][1].split()
    gap = " ".join(notice[:8] + ["really"] + notice[8:])
    docs = spark.createDataFrame([(1, text), (2, gap), (3, "licensed under the")], "doc_id long, text string")
    out = {r.doc_id: r for r in license_scan.license_scan(docs).collect()}
    assert (out[1].n_base, out[1].first_word, out[1].last_word) == (4, 0, 14)
    assert out[1].base_labels == "apache-2,cc-by-nc,mit" and out[1].score == 1.0
    assert out[2].base_labels == "" and out[2].labels == "mit" and 0.6 < out[2].score < 1
    assert out[2].spans[0]["first"] == 0 and out[2].spans[0]["last"] == len(notice)
    assert out[3].labels == ""


def test_related_licences_are_told_apart(spark):
    """Every notice gives its own licence and no other, also with a word put in, and so do texts that name one in passing."""
    texts = [(label, text) for label, text in license_scan.NOTICES]
    texts += [(label, " ".join(w[:5] + ["so"] + w[5:])) for label, text in license_scan.NOTICES for w in [text.split()] if len(w) > 12]
    texts += [("gpl-2", "This is licensed under the GNU General Public License version 2 only."), ("", "licensed under the GNU General Public License"),
              ("", "This work is licensed under a Creative Commons license"), ("gpl-3", texts[3][1] + " and again " + texts[3][1])]
    docs = spark.createDataFrame([(i, f"see below {t.upper()} thanks") for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.license_labels(docs).collect()}
    assert {texts[i]: found for i, found in got.items() if found != texts[i][0]} == {}


def test_scattered_words_are_no_notice(spark):
    w = dict(license_scan.NOTICES)["unlicense"].split()
    near = " ".join(" ".join(w[t:t + 3]) + " x y" for t in range(len(w) - 2))
    docs = spark.createDataFrame([(1, near), (2, " ".join(w))], "doc_id long, text string")
    assert {r.doc_id: r.labels for r in license_scan.license_labels(docs).collect()} == {1: "", 2: "unlicense"}


def test_equal_keys_are_told_apart_by_their_text(spark, monkeypatch):
    """All texts get one key: the chain must still hold every text of its own."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, "")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(docs).collect()}
    assert got == {1: (3, 2, False), 3: (3, 2, True), 2: (2, 1, True), 4: (5, 2, False), 5: (5, 2, True)}


def test_directory_splits_overfull_buckets(spark):
    keys = spark.range(4000).selectExpr("xxhash64(id) AS key")
    slots = exact_dedup.directory(keys, 50)
    assert slots.count() <= 4000
    sizes = keys.withColumn("slot", exact_dedup.slot("key", exact_dedup.MAX_DEPTH)).join(slots, "slot").groupBy("bucket").count()
    top = sizes.selectExpr("max(`count`) AS most", "sum(`count`) AS n", "count(*) AS buckets").first()
    assert top["most"] <= 50 and top["n"] == 4000 and top["buckets"] > 80


def test_keep_distinct_has_all_columns(odd_docs):
    kept = exact_dedup.keep_distinct(odd_docs)
    assert kept.columns == odd_docs.columns
    assert rows(kept, ["doc_id"]) == Counter({(k,): 1 for k in (1, 4, 6, 8, 9, 10, 11, 12, None, 3)})


def test_keep_distinct_leaves_one_row_of_a_text(spark, no_docs):
    docs = spark.createDataFrame(
        [(None, "t", "a"), (None, "t", "b"), (None, "t", "b"), (5, "u", "x"), (5, "u", "y"), (4, "u", "z"), (None, "u", "w"), (7, None, "n"), (None, "", "m")],
        "doc_id long, text string, source string")
    kept = [tuple(r) for r in exact_dedup.keep_distinct(docs).collect()]
    assert sorted(kept, key=str) == sorted((tuple(r) for r in exact_dedup.keep_distinct(docs.repartition(5)).collect()), key=str)
    assert {(i, t) for i, t, _ in kept} == {(None, "t"), (5, "u"), (7, None)} and len(kept) == 3
    assert exact_dedup.keep_distinct(no_docs).count() == 0


def test_tree_deals_every_draw_once(sf_docs):
    known, drawn = mixing.mix(sf_docs, levels=3)
    got = drawn.groupBy("src").agg({"words": "sum"}).withColumnRenamed("sum(words)", "n")
    goal = known.select("src", "target", "source_size").distinct()
    for r in goal.join(got, "src").collect():
        assert abs(r.n - r.target) <= 1
    assert drawn.where("words > size").count() == 0
    assert drawn.groupBy("doc_id", "pass").count().where("`count` > 1").count() == 0
    assert 1 < drawn.select("shard").distinct().count() <= 8
    assert rows(drawn, ["doc_id", "shard", "place"]) == rows(mixing.mix(sf_docs, levels=3)[1], ["doc_id", "shard", "place"])


def test_quotas_are_uniform_subsets(spark):
    """Halves of the root differ from half of a source by no more than a hypergeometric draw would."""
    draws = spark.sql("SELECT src, explode(sequence(1, 200 * (src + 1))) AS draw FROM (SELECT explode(sequence(0, 4)) AS src)")
    leaves = mixing.shard_quotas(draws, 1).collect()
    for src in range(5):
        q = [r.q for r in leaves if r.src == src]
        assert sum(q) == 200 * (src + 1) and max(abs(2 * x - sum(q)) for x in q) < 5 * sum(q) ** 0.5


def near_targets(docs, out):
    """Each source's words in the mix against its target: half a document off at most."""
    def sizes(d):
        by = {}
        for r in d.select("source", "text").collect():
            by.setdefault(r.source, []).append(len(re.findall(mixing.SPACED_WORD, r.text or "")))
        return by

    have, got = sizes(docs), sizes(out)
    goal = {r.source: r.target for r in mixing.targets(mixing.sized(docs)).collect()}
    for source, n in have.items():
        assert abs(sum(got.get(source, [])) - goal[source]) <= max(n) / 2 + 1


def test_mixed_documents_of_odd_rows(odd_docs, no_docs):
    near_targets(odd_docs, mixing.mixed_documents(odd_docs))
    assert mixing.mixed_documents(no_docs).count() == 0 and mixing.mixed_documents(no_docs).schema == no_docs.schema


def test_mixed_documents(sf_docs):
    out = mixing.mixed_documents(sf_docs)
    assert out.columns == sf_docs.columns and out.schema == sf_docs.schema
    near_targets(sf_docs, out)
    whole = {(r.doc_id, r.text) for r in sf_docs.collect()}
    assert all((r.doc_id, r.text) in whole for r in out.collect())
    assert max(Counter(r.doc_id for r in out.select("doc_id").collect()).values()) <= 2


def test_sha(spark):
    docs = spark.createDataFrame([(1, "é")], "doc_id long, text string")
    assert exact_dedup.exact_dedup(docs).first().text_sha256 == hashlib.sha256("é".encode()).hexdigest()

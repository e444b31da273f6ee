"""Toxicity and quality: held-out accuracy, odd rows, no labels."""

import numpy as np
import pandas as pd
import pytest

from broadsheet.llm import mil_quality, toxicity
from broadsheet.llm.common import documents, table

SF = "/root/testdata/sf0.01"


def area(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)


@pytest.mark.parametrize("operator, label, least", [(toxicity.toxicity, "toxic", 0.85), (mil_quality.quality, "quality", 0.95)])
def test_held_out(spark, operator, label, least):
    labels = table(spark, SF, "labels")
    out = operator(documents(spark, SF), labels).toPandas()
    assert len(out) == 1000 and out["score"].between(0, 1).all()
    cut = 0.5 if label == "toxic" else 0.7
    assert (out["predicted"] == (out["score"] >= cut)).all()
    both = out[out["held_out"]].merge(labels.toPandas(), on="doc_id")
    assert area(both["score"].to_numpy(), both[label].to_numpy()) > least


@pytest.mark.parametrize("operator", [toxicity.toxicity, mil_quality.quality])
def test_odd_rows(spark, odd_docs, no_docs, operator):
    labels = table(spark, SF, "labels")
    fitted = documents(spark, SF).select("doc_id", "text").where("doc_id > 20")
    both = fitted.unionByName(odd_docs.select("doc_id", "text"))
    out = operator(both, labels)
    assert out.count() == both.count() and out.where("score IS NULL").count() == 0
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in operator(odd_docs, none).collect()} == {(0.0, 0)}
    assert operator(no_docs, labels).count() == 0


def test_scores_need_only_the_text(spark):
    labels = table(spark, SF, "labels")
    docs = documents(spark, SF)
    model = toxicity.fit(docs, labels)
    moved = docs.selectExpr("doc_id + 1000 AS doc_id", "text")
    a = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    b = {r.doc_id - 1000: r.score for r in toxicity.score(moved, model).collect()}
    assert a == b
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(s < 0.5 for s in a.values())


def test_gradients():
    """Slopes of the attention network against finite differences."""
    rng = np.random.default_rng(0)
    x, starts, y = rng.normal(size=(9, mil_quality.FEATURES)), np.array([0, 2, 5]), np.array([1.0, 0.0, 1.0])
    f, h, g = mil_quality.FEATURES, mil_quality.HIDDEN, mil_quality.GATE
    w = {k: rng.normal(size=s) * np.full(s, 0.2) for k, s in {"encode": (f, h), "encode_0": (h,), "v": (h, g), "u": (h, g), "a": (g,), "out": (h,), "out_0": ()}.items()}
    weight = np.array([1.0, 2.0, 1.0])

    def loss(params):
        p = mil_quality._forward(params, x, starts)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    slopes = mil_quality._slopes(w, x, starts, y, weight)
    for k in w:
        at = tuple(rng.integers(0, n) for n in w[k].shape)
        up, down = ({**w, k: np.array(w[k])} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        assert abs((loss(up) - loss(down)) / 2e-5 - slopes[k][at]) < 1e-6


def test_passages_of_any_text():
    for text in ("", "  ", "a", "é\n" * 100, "x" * 10_000, "\x00 \x01"):
        rows = mil_quality.encode_passages(text)
        assert rows.shape == (max(1, -(-len(text.split(None)) // mil_quality.PASSAGE_WORDS)), mil_quality.FEATURES)
        assert np.isfinite(rows).all()


def test_windows_hold_all_words():
    text = "Aé " + "b" * 200 + " c"
    assert b"".join(w[1:-1] for w in toxicity.windows(text)) == text.lower().replace(" ", "").encode()


def test_both_dictionaries_hold_strings_of_their_kind():
    texts = [f"the common words {'vilest' if k % 2 else 'gardening'} here {k}" for k in range(200)]
    toxic = [k % 2 for k in range(200)]
    own, ordinary = toxicity.train_dictionaries(texts, toxic)
    assert b" vilest " in own and b" vilest " not in ordinary
    assert b" gardening " in ordinary and b" gardening " not in own
    assert len(own) == len(ordinary)
    savings = toxicity.Savings(own, ordinary)
    assert savings.of("vilest")[0] > 0 > savings.of("gardening")[0]


def test_thresholds_come_from_the_sample():
    saved = [np.array([0, 9 if k % 2 else 4]) for k in range(100)]
    assert set(toxicity.calibrate(saved, [k % 2 for k in range(100)])) >= {5, 6, 7, 8, 9}


def test_toxicity_workers_keep_no_windows(spark):
    """What a task remembers of its texts does not stay in the worker for the stages that follow."""
    said = [f"plain words number {k}" for k in range(20)] + [f"nasty things number {k}" for k in range(20)]
    toxic_bytes, ordinary = toxicity.train_dictionaries(said, [0] * 20 + [1] * 20)
    thresholds = (1,) * toxicity.THRESHOLDS
    known = toxicity._savings(toxic_bytes, ordinary)
    width = len(toxicity.features(known.of("a b"), thresholds))
    model = toxicity.Model(toxic_bytes, ordinary, thresholds, (0.0,) * width, (1.0,) * width, (0.1,) * (width + 1))
    scored = list(toxicity.judge(model).func(iter([pd.Series(said)])))
    assert len(scored[0]) == 40 and not known.known

from __future__ import annotations

import numpy as np

from rolemart.llm import quality, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows

LABELS = "doc_id long, quality int, toxic int"


def _query(spark, path):
    return registry.spark_queries()["op1_bradley_terry_quality"](spark, path).collect()


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in _query(spark, path)}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{path}/labels.parquet").collect()}
    assert all(r["held_out"] == brute.held_out(d) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    test = [(q, got[d]) for d, q in labels.items() if brute.held_out(d)]
    assert len(test) > 50 and np.mean([r["predicted"] == q for q, r in test]) >= 0.95
    good, bad = ([r["score"] for q, r in test if q == v] for v in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_weights_are_those_of_the_pairwise_logistic_loss():
    rng = np.random.default_rng(2)
    d = rng.normal(size=(400, 3)) + [0.5, -0.2, 0]
    w = quality.fit_weights(d, 0.01)

    def loss(v):
        return np.mean(np.log1p(np.exp(-d @ v))) + 0.005 * v @ v

    assert all(loss(w) < loss(w + e) for e in 0.01 * rng.normal(size=(50, 3)))


def test_threshold_is_a_score_quantile():
    rng = np.random.default_rng(3)
    y = (np.arange(200) % 5 > 0).astype(int)
    x = rng.normal(size=(200, len(quality.FEATURES))) + 3 * y[:, None]
    model = quality.fit(x, y, 0.3)
    assert abs(model.quantile - 0.2) < 0.03 and ((model.score(x) >= 0.3) == (y == 1)).mean() > 0.97
    raw = model.raw(x)
    assert abs((raw < model.threshold).mean() - model.quantile) < 1e-9


def test_labels_of_one_kind_none_and_odd_rows(spark, folder):
    rows = doc_rows("a fine text.", None, "", "x" * 100_000, "word " * 30_000, "a fine text.") + [(None, "t", None, None, None), (1, "again", "en", "s", 5)]
    for labels in ([], [(1, 1, 0), (2, 1, None)], [(1, 0, 0)], [(1, 1, 0), (1, None, 0), (None, 0, 0), (99, 0, 0), (5, 0, 1), (5, 1, 1), (3, 7, 0)]):
        got = _query(spark, folder(documents=(DOCS, rows), labels=(LABELS, labels)))
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        same = [r["score"] for r in got if r["doc_id"] in (1, 6)]
        assert len(set(same)) <= 2
    assert _query(spark, folder(documents=(DOCS, []), labels=(LABELS, [(1, 1, 0)]))) == []


def test_sample_is_bounded_and_columns_pass(frame):
    docs = frame("doc_id long, text string, x int, quality string", *[(i, "good text. " * i if i % 2 else "#### " * i, i, "q") for i in range(60)])
    labels = frame("doc_id long, quality int", *[(i, i % 2) for i in range(60)])
    out = quality.with_quality(docs, labels, "s", max_rows=20).collect()
    assert [r["quality"] for r in out] == ["q"] * 60
    assert sum((r["s"] >= 0.3) == bool(r["doc_id"] % 2) for r in out) >= 57


def test_features_of_an_empty_text_are_zero():
    assert quality.features(b"") == [0.0] * len(quality.FEATURES) == quality.features(b" \n ")

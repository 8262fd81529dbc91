from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rolemart.llm import native, pii, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows

ODD = [
    None, "", "a@b.c", "a@b.c_x@d.e", "a@b.c@d.e", "x@y", "é ü a.b+c@d-e.example.com.", "@a.b c@.d", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0256.1.1.1 000255.1.1.1",
    "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1111 1", "41111111111111112", "5 4111111111111111", "4111  1111", "4111111111111111 1234567890123456",
    "+1 (555) 123-4567", "+1", "+12345678", "+1234567", "++49 30 1234567)", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "tel +49 (0) 30 / 12", "a@b.c " * 700, "1.1.1.1" * 300,
    "9" * 60_000, "a" * 60_000, "a." * 30_000 + "@", "x@" + "y." * 20_000 + "z", "+" * 5000, "+1" + " " * 50_000, "1-" * 20_000,
]


def _query(spark, path):
    return registry.spark_queries()["op9_weak_supervision_pii"](spark, path).collect()


def test_query_matches_brute_force(spark, sample):
    assert {tuple(r)[:6] for r in _query(spark, SF)} == {(d, *brute.personal(t)) for d, t in sample}


def test_odd_texts(spark, folder):
    rows = doc_rows(*ODD) + doc_rows("a@b.c") + [(None, "mail a@b.org", None, None, None)]
    got = sorted((tuple(r)[:6] for r in _query(spark, folder(documents=(DOCS, rows)))), key=str)
    assert got == sorted(((d, *brute.personal(t)) for d, t, *_ in rows), key=str)


def test_nothing_to_find_and_empty_table(spark, folder):
    assert [r["spans"] for r in _query(spark, folder(documents=(DOCS, doc_rows("plain text", None))))] == ["", ""]
    assert _query(spark, folder(documents=(DOCS, []))) == []


def test_further_kinds_are_decided_by_the_classifier(frame):
    texts = ["call me on phone 212-555-0187 today"] * 30 + ["mail to john [at] site [dot] com please"] * 10 + ["serial 111-222-3333 of the part"] * 3 + ["ip address 8.8.4.4 here"] * 20
    out = pii.with_personal_data(frame("doc_id long, text string", *enumerate(texts)), "found").collect()
    kinds = {r["doc_id"]: [s["kind"] for s in r["found"]] for r in out}
    assert kinds[0] == ["local_phone"] and kinds[30] == ["spoken_email"] and kinds[50] == ["ip"]
    chance = {r["doc_id"]: r["found"][0]["chance"] for r in out if r["found"]}
    assert 0.5 < chance[0] <= 1 and all(0 < c <= 1 for c in chance.values())


def test_reliabilities_by_expectation_maximisation():
    """Votes drawn from known reliabilities are told apart."""
    rng = np.random.default_rng(6)
    truth = rng.random(6000) < 0.7
    right = [0.95, 0.8, 0.65]
    votes = np.stack([np.where(rng.random(6000) < r, 1, -1) * np.where(truth, 1, -1) * (rng.random(6000) < 0.9) for r in right], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    found = pii.aggregate_votes(["email"] * len(patterns), patterns.astype(float), n.astype(float), rounds=300)
    values = list(found.reliability.values())
    assert values[0] > values[1] > values[2] and abs(values[0] - 0.95) < 0.06 and abs(found.share["email"] - 0.7) < 0.08


def test_running_sums_of_any_length(frame):
    arrays = [[], [3], list(range(300)), [1] * 70_000]
    df = frame("id int, a array<int>", *enumerate(arrays))
    got = {r["id"]: r["s"] for r in df.select("id", native.running(F.col("a")).alias("s")).collect()}
    assert got == {i: (np.cumsum(a) - a).tolist() if a else [] for i, a in enumerate(arrays)}


def test_redaction_and_columns(frame):
    rows = [(1, "write a@b.org or +1 555 123 4567!", "k", 3), (2, None, "k", 3), (3, "é nothing", None, None)]
    out = {r["doc_id"]: r for r in pii.redact(frame("doc_id long, text string, pii_spans string, pii_found int", *rows)).collect()}
    assert out[1]["text"] == "write <email> or <phone>!" and out[2]["text"] is None and out[3]["text"] == "é nothing"
    assert (out[1]["pii_spans"], out[1]["pii_found"]) == ("k", 3)


def test_plan_is_native(frame):
    plan = pii.with_personal_data(frame("doc_id long, text string", (1, "a@b.org")), "found")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan

from __future__ import annotations

import pytest

from rolemart.llm import decontaminate, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def _query(spark, path):
    return sorted((tuple(r) for r in registry.spark_queries()["op7_prefix_filtered_decontamination"](spark, path).collect()), key=str)


def test_query_matches_brute_force(spark, sample):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    expected = sorted(brute.leaks(sample, items), key=str)
    assert any(r[-1] for r in expected)
    assert _query(spark, SF) == expected


ITEMS = [(1, ITEM), (2, ITEM), (3, "Alpha beta"), (4, None), (5, "... !"), (7, "x x x x x x x x x x x x"), (8, "gamma")]
TEXTS = [ITEM, "zero " + ITEM.upper() + " thirteen", "one two three four five six seven eight nine", "alpha, BETA; alpha-beta", None, "",
         "x " * 25, "--", "gamma" * 2, "ein gamma strahl", "two three four five six seven eight nine ten eleven", "alpha beta " * 3000]


def test_made_up_cases_in_one_and_in_many_blocks(spark, folder, frame):
    rows = doc_rows(*TEXTS) + doc_rows(ITEM) + [(None, ITEM, None, None, None)]
    docs = frame(DOCS, *rows)
    items = frame("item_id long, text string", *ITEMS)
    expected = sorted(((d, n, h, k) for d, n, h, k, _, _ in brute.leaks([r[:2] for r in rows], ITEMS)), key=str)
    for block in (200_000, 2):
        out = decontaminate.with_leaks(docs, items, "leak", block_windows=block).collect()
        got = [(r["doc_id"], r["leak"]["n_words"], sum(s["end"] - s["start"] for s in r["leak"]["spans"]), len(r["leak"]["items"])) for r in out]
        assert sorted(got, key=str) == expected
    path = folder(documents=(DOCS, rows), benchmark=("item_id long, text string", ITEMS))
    assert _query(spark, path) == sorted(brute.leaks([r[:2] for r in rows], ITEMS), key=str)


def test_items_without_id_mark_their_passages(spark, folder):
    rows = doc_rows(ITEM, "alpha beta gamma", "clean words only")
    path = folder(documents=(DOCS, rows), benchmark=("item_id long, text string", [(None, ITEM), (3, "alpha beta"), (None, "alpha beta"), (None, None)]))
    got = _query(spark, path)
    assert [r[:4] + r[5:] for r in got] == [(1, 12, 12, 0, True), (2, 3, 2, 1, True), (3, 3, 0, 0, False)]
    assert [r[4] for r in got] == [brute.sha(""), brute.sha("3"), brute.sha("")]


@pytest.mark.parametrize("n_docs,n_items", [(0, 2), (2, 0)])
def test_empty_tables(spark, folder, n_docs, n_items):
    path = folder(documents=(DOCS, doc_rows(*TEXTS[:n_docs])), benchmark=("item_id long, text string", ITEMS[:n_items]))
    got = _query(spark, path)
    assert len(got) == n_docs and not any(r[-1] for r in got)


def test_columns_with_clashing_names_pass_through(frame):
    docs = frame("doc_id long, text string, leak_state int, words string, n int", (1, ITEM, 5, "w", 7))
    out = decontaminate.with_leaks(docs, frame("item_id long, text string, words int", (1, ITEM, 3)), "leak", block_windows=1).collect()
    assert (out[0]["leak_state"], out[0]["words"], out[0]["n"]) == (5, "w", 7) and out[0]["leak"]["items"] == ["1"]
    assert [tuple(s) for s in out[0]["leak"]["spans"]] == [(0, 12)]

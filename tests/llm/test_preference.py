from __future__ import annotations

from collections import Counter

import pytest

from harness.verify import connect
from rolemart.llm import preference, registry
from tests.llm.conftest import SF

TURNS = "conv_id long, turn long, role string, text string"
NAME = "op8_preference_pairs"


def _same_as_sql(spark, path):
    frame = registry.spark_queries()[NAME](spark, path)
    con = connect(SF)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS FROM read_parquet('{path}/conversations.parquet{'' if path == SF else '/*.parquet'}')")
    want = con.execute(registry.sql_queries()[NAME])
    names = [d[0] for d in want.description]
    assert Counter(map(tuple, frame.select(*names).collect())) == Counter(want.fetchall())
    return frame


def test_query_matches_sql(spark):
    assert _same_as_sql(spark, SF).count() > 0


def test_query_matches_sql_on_odd_rows(spark, folder):
    rows = [
        (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (1, 0, "user", "ho"), (1, 1, "assistant", "no"), (2, 0, "user", "only one"), (2, 1, "assistant", "reply"),
        (4, 0, "system", None), (4, 1, None, "x"), (4, None, "assistant", "late"), (5, 0, "assistant", None), (6, 0, "user", "no reply at all"), (7, 0, "assistant", "é" * 50_000),
        (8, 0, "user", "twice"), (8, 0, "user", "twice"), (8, 1, "assistant", "a"), (8, 1, "assistant", "b"), (9, 0, "assistant", "b"), (None, 0, "user", "nobody's"), (10, 0, "user", ""), (10, 1, "assistant", ""),
    ]
    _same_as_sql(spark, folder(conversations=(TURNS, rows)))
    assert registry.spark_queries()[NAME](spark, folder(conversations=(TURNS, []))).collect() == []


def _examples(frame, *rows):
    return {r["pair_id"]: r for r in preference.preference_examples(frame("pair_id long, chosen boolean, turn long, role string, text string, n int", *[(*r, 1) for r in rows])).collect()}


def test_common_prefix_is_rendered_once(frame):
    both = [(1, side, t, role, text) for side in (True, False) for t, role, text in ((0, "system", "s"), (1, "user", "q"))]
    got = _examples(frame, *both, (1, True, 2, "assistant", "good"), (1, True, 3, "user", "more"), (1, True, 4, "assistant", "fine"), (1, False, 2, "assistant", "bad"))[1]
    assert got["n_prompt_turns"] == 2 and got["prompt"].count("<|user|>") == 1
    assert [got["chosen"][s["start"] : s["end"]] for s in got["chosen_spans"]] == ["good\n<|end|>", "fine\n<|end|>"]
    assert [got["rejected"][s["start"] : s["end"]] for s in got["rejected_spans"]] == ["bad\n<|end|>"]


@pytest.mark.parametrize("shared", [0, 1, 3])
def test_prefix_ends_at_the_first_difference(frame, shared):
    rows = [(1, side, t, "user", f"t{t}" if t < shared or side else f"o{t}") for side in (True, False) for t in range(4)]
    got = _examples(frame, *rows)[1]
    assert (got["n_prompt_turns"], got["n_chosen_turns"], got["n_rejected_turns"]) == (shared, 4 - shared, 4 - shared)


def test_equal_one_sided_and_unnamed_pairs(frame):
    got = _examples(frame, (1, True, 0, "user", "a"), (1, False, 0, "user", "a"), (2, True, 0, "assistant", "b"), (None, None, 0, None, None), (3, False, None, "user", "x"))
    assert (got[1]["chosen"], got[1]["rejected"], got[1]["n_prompt_turns"]) == ("", "", 1)
    assert (got[2]["rejected"], got[2]["n_rejected_turns"], got[2]["n_chosen_turns"]) == ("", 0, 1)
    assert got[None]["n_rejected_turns"] == 1 and got[3]["n_rejected_turns"] == 1


def test_plan_is_native(spark):
    plan = registry.spark_queries()[NAME](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

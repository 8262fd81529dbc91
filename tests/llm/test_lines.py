from __future__ import annotations

from rolemart.llm import lines, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows

GOOD = "This is a sentence with some words in it, and it ends as it should."

OTHER = "Here another one follows, which says something else about the matter."


def _query(spark, path):
    return registry.spark_queries()["op6_line_first_cleaning"](spark, path).collect()


def test_query_matches_brute_force(spark, sample):
    got = {r["doc_id"]: tuple(r)[1:7] for r in _query(spark, SF)}
    assert got == {d: brute.quality(t) for d, t in sample}


def test_made_up_texts(spark, folder):
    texts = [None, "", " ", "a b c d e a b c d e", "a b c d a b c d a b c d", "x\n\nx\ny\n y\nx", "#$%&*|<>", "one two three four five six seven eight nine ten",
             "\x0b\x0c\r mixed\tspaces \n", "é ü ß  wide", "ab " * 20_000, "the end\n" * 50, "a b c d e f g h i j k l a b c d e z"]
    rows = doc_rows(*texts) + doc_rows("a b c d e a b c d e", start=4) + [(None, "no id", None, None, None)]
    got = sorted((tuple(r)[:7] for r in _query(spark, folder(documents=(DOCS, rows)))), key=str)
    assert got == sorted(((d, *brute.quality(t)) for d, t, *_ in rows), key=str)
    assert _query(spark, folder(documents=(DOCS, []))) == []


def _verdict(frame, *texts):
    return [r["v"] for r in lines.with_line_verdict(frame("doc_id long, text string", *enumerate(texts)), "v").orderBy("doc_id").collect()]


def test_rules_per_line(frame):
    navigation, boilerplate, shouting = "Home | News | Sport | Contact", "Copyright 2024 Someone. All rights reserved.", "BUY!! NOW!! THIS!! IS!! THE LAST CHANCE TO GET IT!!"
    for bad, rule in ((navigation, "navigation"), ("Log in", "navigation"), (boilerplate, "boilerplate"), (shouting, "punctuation"), ("$$$ &&& %%% cheap ###", "punctuation")):
        v = _verdict(frame, f"{GOOD}\n{bad}\n{OTHER}")[0]
        assert (v["clean_text"], v["removed"][rule], v["kept"]) == (f"{GOOD}\n{OTHER}", 1, True), bad
    assert _verdict(frame, GOOD)[0]["clean_text"] == GOOD


def test_documents_that_lose_too_much_go(frame):
    many = "\n".join(f"Page{i} | Link{i} | More{i}" for i in range(40))
    kept, lost, short = _verdict(frame, "\n".join([GOOD] + [f"{GOOD} Line {i}." for i in range(3)]), f"{GOOD}\n{many}", "Too short.")
    assert kept["kept"] or kept["base_failed"]
    assert not lost["kept"] and lost["lost"] > 0.5 and not lost["base_failed"]
    assert short["base_failed"] and not short["kept"]


def test_plan_is_native_and_columns_pass(frame):
    docs = frame("doc_id long, text string, line_words int, line_text string, v2 int", (1, GOOD, 4, "t", 9))
    out = lines.with_line_verdict(docs, "v")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    row = out.collect()[0]
    assert (row["line_words"], row["line_text"], row["v2"], row["text"]) == (4, "t", 9, GOOD)

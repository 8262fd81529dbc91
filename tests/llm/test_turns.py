from __future__ import annotations

import random

from pyspark.sql import functions as F

from rolemart.llm import registry, turns
from rolemart.llm.queries import damaged
from tests.llm import brute
from tests.llm.conftest import SF

NAME = "op11_suffix_shared_repair"
TURNS = "conv_id long, turn long, role string, text string"


def _query(spark, path):
    return sorted((tuple(r) for r in registry.spark_queries()[NAME](spark, path).collect()), key=str)


def _expected(rows):
    return sorted(brute.conversations(rows), key=str)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert _query(spark, SF) == _expected(rows)


def _random_rows(seed, conversations, length):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "User", None, "student", "u"]
    texts = ["Fine.", "Well?", "cut off", "", "  \t", "Yes! ", "no\n", None, "é.", "a.b", "…"]
    rows = []
    for c in range(conversations):
        own = rng.randint(0, length)
        for t in range(own):
            if rng.random() < 0.9:
                text = rng.choice(texts) if rng.random() < 0.4 else f"Text {rng.randrange(10**6)}{rng.choice(['.', '', '?'])}"
                rows.append((c, t * rng.choice([1, 1, 1, 2]) + (t if own > 9 else 0) * 100, rng.choice(roles[: rng.choice([2, 3, 11])]), text))
    seen = set()
    return [r for r in rows if (r[0], r[1]) not in seen and not seen.add((r[0], r[1]))]


def test_random_conversations(spark, folder):
    rows = _random_rows(3, 400, 14)
    got = _query(spark, folder(conversations=(TURNS, rows)))
    assert got == _expected(rows)
    assert len({r[7] for r in got}) > 100 and {e for r in got for e in r[7]} == set("KRDI")


def test_nulls_repeats_and_a_long_conversation(spark, folder):
    rows = [(None, 0, "user", "A."), (None, 1, "assistant", "B."), (7, None, "user", "No turn."), (7, 2, "assistant", "B."), (7, 9, "user", "B"), (8, None, None, None)]
    rows += [(9, t, "user" if t % 2 == 0 else "assistant", f"Line {t % 5000}." + "x" * (200_000 if t == 77 else 0)) for t in range(20_000)]
    rows += [(10, 3, "user", "Same.")] * 3 + [(10, 4, "assistant", "Reply.")]
    got = _query(spark, folder(conversations=(TURNS, rows)))
    assert got == _expected(rows)


def test_conversations_that_lose_all_rows_and_empty_tables(spark, folder):
    lost = [(c, 0, "user", "Gone.") for c in range(200)]
    got = _query(spark, folder(conversations=(TURNS, lost)))
    assert got == _expected(lost)
    assert (sum(r[7] == "" for r in got)) > 0
    assert _query(spark, folder(conversations=(TURNS, []))) == []


def test_edited_rows(spark):
    rows = spark.createDataFrame([(1, 0, "system", "Rules."), (1, 1, "assistant", "Hello."), (1, 2, "assistant", "Hello."), (1, 3, "assistant", "and then")], TURNS)
    plans = turns.repairs(rows.withColumn("conv", F.lit("clash")).withColumn("digest", F.lit(1)))
    assert [(r["cost"], r["audit"]) for r in plans.collect()] == [(10, "KRDK")]
    got = [tuple(r)[2:] for r in turns.edited(rows, plans).collect()]
    assert got == [(0, "K", "system", "Rules."), (1, "R", "user", "Hello."), (2, "D", "assistant", "Hello."), (3, "K", "assistant", "and then")]
    lone = spark.createDataFrame([(2, 5, "assistant", "Hello.")], TURNS)
    got = [tuple(r)[2:] for r in turns.edited(lone, turns.repairs(lone)).collect()]
    assert got == [(None, "I", "user", ""), (5, "K", "assistant", "Hello.")]


def test_nodes_are_the_distinct_suffixes():
    rng = random.Random(5)
    found = sorted({"".join(rng.choice("suaSUAox") for _ in range(rng.randint(0, 9)))[::-1] for _ in range(800)})
    automaton = turns.SuffixAutomaton()
    for backward in found:
        automaton.repair(backward)
    assert automaton.built == len({b[:i] for b in found for i in range(len(b) + 1)})
    assert len(automaton._classes) < automaton.built / 3


def test_damage_covers_every_fate(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(5)]
    got = sorted(tuple(r) for r in damaged(spark.createDataFrame(rows, TURNS)).collect())
    assert got == sorted(brute.damage(rows))
    assert len(got) != len(rows) and len({r[2:] for r in got}) == 4

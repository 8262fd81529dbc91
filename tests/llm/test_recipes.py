from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from rolemart.llm import recipes, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows

NAME = "op13_chunk_recipe_dedup"


def _query(spark, path):
    return sorted((tuple(r) for r in registry.spark_queries()[NAME](spark, path).collect()), key=str)


def _expected(rows):
    return sorted(brute.exact_groups([r[:2] for r in rows]), key=str)


def test_query_matches_brute_force_and_sql(spark, sample):
    got = _query(spark, SF)
    assert got == _expected(sample)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.sql(registry.sql_queries()[NAME]).fetchall(), key=str)


def test_odd_rows(spark, folder):
    """NULLs, empty and long texts, repeated ids, texts that differ in the last character only."""
    long = "Word after word. " * 40_000
    rows = doc_rows(None, "", " ", "a", "a", "A", "b" * 30_000, "b" * 30_000, "b" * 30_001, long, long + "x", long, "é", "é")
    rows += [(None, "a", "en", "s", 1), (None, "solo", "en", "s", 1), (None, "solo", "en", "s", 1), (5, "a", "en", "s", 1), (5, "a", "en", "t", 2)]
    assert _query(spark, folder(documents=(DOCS, rows))) == _expected(rows)


def test_empty_table(spark, folder):
    assert _query(spark, folder(documents=(DOCS, []))) == []


def test_chunks_join_to_the_text_and_follow_content(spark):
    text = "".join(f"Sentence number {i} of the text. " for i in range(3000))
    texts = [text, "Some words in front. " + text, "x" * 20_000, "", "line\n" * 5000, "。".join(["漢字" * 700] * 5)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    cut = [r[0] for r in frame.select(recipes.chunks(F.col("text"))).collect()]
    assert ["".join(c) for c in cut] == texts
    assert max(len(c) for cs in cut for c in cs) <= recipes._MOST + 1
    assert len(cut[0]) > 20 and cut[3] == []


def test_clashing_identifiers_are_numbered_anew(spark, folder):
    """With a numbering by length all chunks of one length clash, so the next rule must be taken."""
    rows = doc_rows(*(f"text {i % 7} of some" for i in range(20)))
    docs = spark.createDataFrame(rows, DOCS)
    weak = lambda c: F.length(c).cast("long")
    got = recipes.exact_groups(docs.select("doc_id", "text"), "g", (weak, *recipes.NUMBERINGS)).select("doc_id", "g.*")
    assert sorted((tuple(r) for r in got.collect()), key=str) == _expected(rows)
    with pytest.raises(ValueError):
        recipes.exact_groups(docs, "g", (weak,))


def test_bytes_that_are_not_utf8(spark):
    """Two texts that a reader of code points sees as the same, and one that looks like the replacement."""
    frame = spark.sql("SELECT * FROM VALUES (1L, X'61FF'), (2L, X'61FE'), (3L, X'61FF'), (4L, X'6166387669') AS t(doc_id, raw)")
    got = recipes.exact_groups(frame.select("doc_id", F.col("raw").cast("string").alias("text")), "g")
    assert {r["doc_id"]: r["g"]["keep_id"] for r in got.collect()} == {1: 3, 2: 2, 3: 3, 4: 4}


def test_further_columns_pass_and_no_python_runs(spark):
    names = ["exact_row", "exact_tie", "exact_sha", "exact_valid", "exact_recipe", "exact_part", "g_valid", "g_recipe", "g_best", "g_size", "g_part"]
    docs = spark.createDataFrame([(1, "a", *range(11)), (2, "a", *range(11)), (3, "b", *range(11))], ["doc_id", "text", *names])
    got = recipes.exact_groups(docs, "exact")
    assert got.columns == ["doc_id", *names, "exact"]
    assert sorted((r["doc_id"], r["exact"]["keep_id"], r["g_size"]) for r in got.collect()) == [(1, 2, 9), (2, 2, 9), (3, 3, 9)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_group_with_most_rows(spark, folder):
    rows = doc_rows(*(["the same text. " * 200] * 3000 + [f"other {i}" for i in range(100)]))
    got = _query(spark, folder(documents=(DOCS, rows)))
    assert got == _expected(rows) and sum(r[3] for r in got) == 101

from __future__ import annotations

import random

import duckdb
import pytest

from rolemart.llm import phrases, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF

NAME = "op12_toivonen_phrases"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _query(spark, path):
    return _rows(registry.spark_queries()[NAME](spark, path))


def _sql(path, glob=""):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet{glob}'")
    return sorted(con.sql(registry.sql_queries()[NAME]).fetchall())


def test_query_matches_brute_force_and_sql(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("lang", "text").collect()]
    got = _query(spark, SF)
    assert got == brute.collocations(docs) and len(got) > 100
    assert got == _sql(SF)


def _corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Über", "ÉTÉ", "naïve\xa0word", "x\x00y", "漢字"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            text += rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b", "\x85"]) + rng.choices(words, weights)[0].upper() if rng.random() < 0.9 else " new york city"
        out.append((rng.choice(["en", "en", "en", None, "und", "de"]), text))
    return out


@pytest.mark.parametrize("sample_percent", [0, 5, 60, 100])
def test_any_sample_gives_the_same(spark, sample_percent):
    docs = _corpus(1, 300)
    got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), sample_percent=sample_percent)
    expected = brute.collocations(docs)
    assert _rows(got) == expected and len(expected) > 40


def test_odd_tables(spark, folder):
    assert _query(spark, folder(documents=(DOCS, []))) == []
    rows = [(1, None, None, None, None), (None, "", "en", "s", 0), (2, " . , \n", "en", "s", 0), (3, "a b " * 11, None, "s", 0), (3, "a b " * 11, None, "s", 0), (4, "c d e;" * 10, "en", "s", 9)]
    path = folder(documents=(DOCS, rows))
    expected = brute.collocations([(r[2], r[1]) for r in rows])
    assert _query(spark, path) == expected == _sql(path, "/*.parquet") and {r[2] for r in expected} == {"a b a", "b a b", "c d e"}


def test_ties_are_ordered_by_bytes_and_cut_at_the_top(spark):
    docs = [("en", ". ".join(f"{a} {b}" for a, b in (("b", "x1"), ("a", "x2"), ("é", "x3"), ("z", "x4")) for _ in range(12)))]
    got = _rows(phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), top=3))
    assert [r[:3] for r in got] == [("en", 1, "a x2"), ("en", 2, "b x1"), ("en", 3, "z x4")]


def test_long_texts_are_counted_in_slices_without_loss():
    """Runs cut anywhere between words, within a piece that never ends, count as in one go."""
    rng = random.Random(2)
    text = " ".join(rng.choice(["a", "b", "c", "d."]) if rng.random() < 0.02 else rng.choice("abc") for _ in range(5000)).encode()
    everything = phrases.Bitmap()

    def count(slice_bytes, most):
        counter, total = phrases.Counter(3, everything, None, True), {}
        parts = [*counter.text(text, "en", most, slice_bytes), counter.rows()]
        for lang, size, found, times in (g for p in parts for g in p):
            for phrase, n in zip(found, times.tolist(), strict=True):
                total[lang, size, phrase] = total.get((lang, size, phrase), 0) + n
        return total, len(parts)

    whole, one = count(1 << 22, 10**9)
    assert one == 1 and len(whole) > 30
    for slice_bytes, most in ((64, 100), (300, 2), (1000, 700)):
        cut, parts = count(slice_bytes, most)
        assert cut == whole and parts > 5


def test_more_words_in_a_phrase(spark):
    docs = [("en", "one two three four five. " * 12 + "three four. " * 30)]
    got = phrases.collocations(spark.createDataFrame(docs, "lang string, text string"), max_words=5, sample_percent=0)
    assert [(r["phrase"], r["a"]) for r in got.collect()] == [("three four", 42), ("one two three four five", 12)]


def test_arithmetic_beyond_64_bits(spark):
    """The score's products are exact where 64 bits and floating point are not."""
    from pyspark.sql import functions as F

    a, l, r = 3_000_000_019, 3_000_000_021, 3_000_000_023
    got = spark.range(1).select(*(F.lit(v).cast("long").alias(c) for c, v in (("a", a), ("l", l), ("r", r)))).select(
        F.expr("(CAST(1000000 AS DECIMAL(38,0)) * a * a) DIV (CAST(l AS DECIMAL(38,0)) * r)")).collect()[0][0]
    assert got == 1000000 * a * a // (l * r)

from __future__ import annotations

import pytest

import corpus_pipeline
from rolemart.llm import quality
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows
from tests.llm.test_packing import check, tokenizer  # noqa: F401


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """What each stage gets and returns on the smallest driver tables."""
    path, out = str(tmp_path_factory.mktemp("stages")), []
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{path}/{name}")
        after = spark.read.parquet(f"{path}/{name}")
        out.append((docs, after))
        docs = after
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_stay(written):
    for before, after in written[:-1]:
        assert after.dtypes == before.dtypes


def test_quality_stage_applies_the_scores(spark, written):
    before, after = written[0]
    from rolemart.llm.queries import training_labels

    model = quality.train(before, training_labels(spark, SF), 0.3)
    kept = {d for d, t in _texts(before).items() if model.score(quality.np.array([quality.features((t or "").encode())]))[0] >= 0.3}
    assert set(_texts(after)) == kept and 0 < len(kept) < before.count()


def test_near_duplicate_stage_keeps_one_of_each_group(written):
    before, after = written[1]
    groups = brute.near_duplicates(list(_texts(before).items()), size=5)
    assert set(_texts(after)) == {d for d, (_, first) in groups.items() if d == first}
    assert after.count() < before.count()


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, frame):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    texts = [(5, a), (5, a), (7, a), (None, a), (None, b), (None, b), (None, b + " end"), (3, c), (3, d), (9, a + " end"), (3, d + " end"), (None, None), (None, None), (4, "")]
    docs = frame(DOCS, *[(*t, "en", "src0", 1) for t in texts]).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.keep_one_of_each(spark, docs, SF).collect()]
    expected = {(5, "a"), (None, "b"), (3, "c"), (3, "d"), (None, ""), (4, "")}
    assert {(i, (t or "")[:1]) for i, t in got} == expected
    assert len(got) == len(expected) + 1  # texts without words are in no group


def test_decontamination_stage(spark, written):
    before, after = written[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(_texts(after)) == {r[0] for r in brute.leaks(list(_texts(before).items()), items) if not r[-1]}
    assert after.count() < before.count()


def test_secret_stage_keeps_documents_and_removes_secrets(written):
    before, after = (_texts(x) for x in written[3])
    assert set(before) == set(after)
    assert all(brute.secrets(t)[:3] == (0, 0, 0) for t in after.values())
    assert all(before[d] == t for d, t in after.items() if brute.secrets(before[d])[:3] == (0, 0, 0))
    sizes = {r["doc_id"]: r["n_chars"] for r in written[3][1].collect()}
    assert all(sizes[d] == len(t) for d, t in after.items() if before[d] != t)


def test_packing_stage_and_run(spark, written, tokenizer):  # noqa: F811
    before, after = written[4]
    check(after.collect(), list(_texts(before).items()), tokenizer)
    again = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, again.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, after.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_odd_rows_and_empty_tables(spark, folder):
    labels, items = "doc_id long, quality int, toxic int", "item_id long, text string"
    extra = DOCS + ", score string, near int, leak int"
    rows = [(*r, "s", 1, 2) for r in [*doc_rows("good text here, and more of it. " * 4, None, "", "x", "secret = abcdefghij", "secret = abcdefghij"), (None, None, None, None, None)]]
    path = folder(documents=(extra, rows), labels=(labels, []), benchmark=(items, []))
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        docs = out
    assert sorted((r["doc_id"] or 0) for r in docs.collect()) == [0, 1, 2, 3, 4, 5]
    assert corpus_pipeline.run(spark, path).count() >= 6
    empty = folder(documents=(DOCS, []), labels=(labels, []), benchmark=(items, []))
    assert corpus_pipeline.run(spark, empty).count() == 0

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from rolemart.llm import repeats, registry
from tests.llm import brute
from tests.llm.conftest import DOCS, SF, doc_rows


def _rows(df):
    return sorted((tuple(r)[:5] for r in df.collect()), key=str)


def test_query_matches_brute_force(spark, sample):
    got = _rows(registry.spark_queries()["op2_run_length_index_dedup"](spark, SF))
    assert got == sorted(brute.repeats(sample), key=str) and sum(r[2] for r in got) > 0


def _made_up():
    rng = random.Random(4)

    def text(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage, other = text(120), text(51)
    texts = [passage + text(30), text(20) + passage[:49], text(20) + passage[10:60] + text(5), other, text(9) + other[:50], text(3) + other[1:], passage + passage,
             "a" * 300, "a" * 49, "b" * 10 + "a" * 60, "é" * 40, "x" + "é" * 30, None, "", "ab" * 100, "ba" * 100, text(200) + "\0" * 60, "\0" * 55]
    texts += [text(rng.randrange(80)) + passage[rng.randrange(60) :] + text(rng.randrange(80)) for _ in range(40)]
    return texts


@pytest.mark.parametrize("often", [256, 2])
def test_made_up_texts(spark, frame, often):
    rows = doc_rows(*_made_up())
    rng = random.Random(8)
    rng.shuffle(rows)
    rows += [rows[3], (7, "a" * 80, None, None, None), (None, "a" * 70, None, None, None), (None, "a" * 70, None, None, None)]
    docs = frame(DOCS, *rows).repartition(3)
    assert _rows(repeats.remove_repeats(docs, often=often)) == sorted(brute.repeats([r[:2] for r in rows]), key=str)


def test_copies_share_no_anchors_and_go_as_a_whole(frame, monkeypatch):
    """Equal texts are judged by their smallest id; they send no segments, however often they occur."""
    kept, landed = [], repeats.landed
    monkeypatch.setattr(repeats, "landed", lambda *a: kept.append(landed(*a)) or kept[-1])
    rng = random.Random(12)
    often, rare, short, alone = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (900, 300, 49, 400))
    rows = [*((i, often) for i in range(40, 10, -1)), (17, often), (None, often), (9, alone), (None, rare), (None, rare), (5, short), (4, short), (3, None), (2, "")]
    docs = frame(DOCS, *[(*r, None, None, None) for r in rows]).repartition(5)
    assert _rows(repeats.remove_repeats(docs)) == sorted(brute.repeats(rows), key=str)
    assert kept[0].where("shared IS NOT NULL").count() == 0
    partly = rows + [(30, rare[:200] + alone[100:]), (8, often[:500])]
    docs = frame(DOCS, *[(*r, None, None, None) for r in partly]).repartition(5)
    out = repeats.remove_repeats(docs, with_text=True).collect()
    assert sorted((tuple(r)[:5] for r in out), key=str) == sorted(brute.repeats(partly), key=str)
    assert {bytes(r["kept"]) for r in out if r["doc_id"] in (12, 40)} == {b""}


def test_texts_that_differ_by_their_ids_digits(frame):
    """Rows whose text and decimal id give the same string are still different documents."""
    rng = random.Random(11)
    a, b, c = ("".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(3))
    rows = [(2, a + "1"), (12, a), (None, b + "5"), (5, b), (3, c + "-"), (-3, c)]
    docs = frame(DOCS, *[(*r, None, None, None) for r in rows]).coalesce(1)
    got = _rows(repeats.remove_repeats(docs))
    assert got == sorted(brute.repeats(rows), key=str)
    assert {r[0]: r[2] for r in got} == {2: 0, 12: 90, None: 90, 5: 0, 3: 90, -3: 0}


def test_kept_bytes_and_other_sizes(frame):
    rows = doc_rows("0123456789 abcdefghij KLMNOPQRST", "xx 0123456789 abcdefghij KL yy", "nothing like it")
    out = {r["doc_id"]: bytes(r["kept"]) for r in repeats.remove_repeats(frame(DOCS, *rows), size=24, with_text=True).collect()}
    assert out == {1: rows[0][1].encode(), 2: b"xx  yy", 3: b"nothing like it"}


def test_empty_table(spark, folder):
    assert registry.spark_queries()["op2_run_length_index_dedup"](spark, folder(documents=(DOCS, []))).collect() == []


def test_each_window_has_one_anchor_that_depends_on_it_alone():
    rng = np.random.default_rng(1)
    anchoring = repeats.Anchoring()
    window = bytes(rng.integers(97, 100, 50, dtype=np.uint8))
    places = set()
    for left, right in ((0, 0), (17, 80), (90, 3), (200, 200)):
        data = bytes(rng.integers(97, 100, left, dtype=np.uint8)) + window + bytes(rng.integers(97, 100, right, dtype=np.uint8))
        hashes, first, last = anchoring.anchors(data)
        assert first[0] == 0 and last[-1] == len(data) - 50 and (first[1:] == last[:-1] + 1).all()
        places.add(hashes[np.searchsorted(first, left, "right") - 1])
    assert len(places) == 1


def test_run_index_is_a_run_length_transform():
    """Runs spell out the bytes before the sorted windows, and their heads carry the smallest document."""
    segments, docs = [b"abracadabra" * 3, b"zbracadabra" * 2, b"abracadabra" * 2], [5, 1, 9]
    size = 11
    text = np.frombuffer(b"".join(segments), np.uint8)
    begins, counts = [0, 33, 55], [23, 12, 12]
    starts = np.concatenate([b + np.arange(c) for b, c in zip(begins, counts, strict=True)])
    owners, opens = np.repeat(docs, counts), np.isin(starts, begins)
    index = repeats.RunIndex(text, starts, owners, opens, size)
    windows = [bytes(text[s : s + size]) for s in starts]
    order = sorted(range(len(starts)), key=lambda i: (windows[i], owners[i]))
    assert index.order.tolist() == order or [windows[i] for i in index.order] == [windows[i] for i in order]
    spelled = np.repeat(index.run_byte, np.diff(np.append(index.run_start, len(starts))))
    assert spelled.tolist() == [0 if opens[i] else text[starts[i] - 1] for i in index.order]
    assert len(index.run_start) < len(starts)
    smallest = {w: min(d for v, d in zip(windows, owners, strict=True) if v == w) for w in windows}
    assert index.smallest_documents().tolist() == [smallest[w] for w in windows]


def test_stretches_of_one_byte_are_one_anchor():
    from rolemart.llm.repeats import Anchoring

    hashes, first, last = Anchoring(50, 20).anchors(b"a unique beginning of thirty-some bytes " + b" " * 1_000_000 + b"and an end of the text, which is not long")
    assert len(hashes) < 40 and (last - first).max() > 990_000
    assert first[0] == 0 and (first[1:] == last[:-1] + 1).all()


@pytest.mark.parametrize("often", [2, 256])
def test_long_texts_of_little_variety(spark, often):
    """Blanks, one period and a long copy, against brute force; columns of any further name pass unread."""
    long = "".join(f"line {i % 97} of {i}\n" for i in range(4000))
    texts = [" " * 3000, " " * 5000 + "x", "ab" * 2000, "ab" * 1500 + "c", long, "intro " + long + " outro", "y" + " " * 60, " " * 49]
    docs = spark.createDataFrame([(i, t, "o", b"s", 1, None) for i, t in enumerate(texts)], "doc_id long, text string, owner string, shared binary, data int, marks string")
    got = sorted(tuple(r) for r in repeats.remove_repeats(docs, often=often).collect())
    assert got == sorted(brute.repeats([(i, t) for i, t in enumerate(texts)]))


def test_ranges_of_a_bucket_equal_all_pairs(monkeypatch):
    """Anchors with one and with several variants, the same segment in several documents, in blocks of few segments."""
    monkeypatch.setattr(repeats, "_AT_ONCE", 3)
    rng, size = np.random.default_rng(3), 9
    for _ in range(40):
        base = bytes(rng.integers(97, 99, 24, dtype=np.uint8))
        pool = [base[a : a + n] + b"xy"[: k % 3] for k, (a, n) in enumerate(zip(rng.integers(0, 12, 8).tolist(), rng.integers(size, 13, 8).tolist(), strict=True))]
        segments = [pool[i] for i in rng.integers(0, 8, 20)]
        docs = rng.integers(0, 9, 20).tolist()
        got = [[int(x) for x in r] for r in repeats.mark_bucket(segments, docs, [1] * 20, size)]
        windows = {(i, j): s[j : j + size] for i, s in enumerate(segments) for j in range(len(s) - size + 1)}
        want = {at for at, w in windows.items() if min(docs[i] for (i, _), v in windows.items() if v == w) < docs[at[0]]}
        assert {(i, j) for i, first, end in got for j in range(first, end)} == want
        assert got == sorted(got) and all(z < a or i != k for (i, _, z), (k, a, _) in zip(got, got[1:], strict=False))
    alike = repeats.mark_bucket([b"abcdefghijk", b"abcdefghijk", b"zzzzzzzzzz"], [4, 2, 1], [1, 1, 2], size)
    assert alike.tolist() == [[0, 0, 3]]


def test_indexes_over_some_anchors_at_a_time(monkeypatch):
    """A bucket of several anchors, indexed in blocks of few windows, gives what all pairs give."""
    monkeypatch.setattr(repeats, "_INDEXED", 20, raising=False)
    monkeypatch.setattr(repeats, "_AT_ONCE", 4)
    rng, size = np.random.default_rng(6), 9
    for _ in range(30):
        bases = [bytes(rng.integers(97 + 2 * k, 99 + 2 * k, 24, dtype=np.uint8)) for k in range(5)]
        keys = rng.integers(0, 5, 40).tolist()
        segments = [bases[k][a : a + n] for k, a, n in zip(keys, rng.integers(0, 12, 40).tolist(), rng.integers(size, 13, 40).tolist(), strict=True)]
        docs = rng.integers(0, 9, 40).tolist()
        got = [[int(x) for x in r] for r in repeats.mark_bucket(segments, docs, keys, size)]
        windows = {(i, j): s[j : j + size] for i, s in enumerate(segments) for j in range(len(s) - size + 1)}
        want = {at for at, w in windows.items() if min(docs[i] for (i, _), v in windows.items() if v == w) < docs[at[0]]}
        assert {(i, j) for i, first, end in got for j in range(first, end)} == want
        assert got == sorted(got)


def test_large_input_moves_in_large_rows(frame, monkeypatch):
    """Rows between chunks and buckets are chunks times buckets; at 10 GB of text each must still hold many segments."""
    made, real, n_bytes = [], repeats._segment_rows, 10_000_000_000
    monkeypatch.setattr(repeats, "_segment_rows", lambda *a: made.append((real(*a), a[1])) or made[-1][0])
    monkeypatch.setattr(repeats, "expected_units", lambda docs, bytes_per_unit: n_bytes)
    repeats.remove_repeats(frame(DOCS, *doc_rows("x" * 60, "y" * 60)))
    monkeypatch.setattr(repeats, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": classmethod(lambda c: 1)}))
    (send, bits), rng = made[0], np.random.default_rng(2)
    texts = [rng.integers(97, 123, 4000, dtype=np.uint8).tobytes() for _ in range(1000)]
    shared = [repeats.cut(np.unique(repeats.Anchoring().anchors(t)[0]), bits) for t in texts]
    owners = [i.to_bytes(16, "little") for i in range(len(texts))]
    columns = [pa.array(owners, pa.binary()), pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary()), pa.array([x.tobytes() for x in shared], pa.binary())]
    rows = sum(b.num_rows for b in send(iter([pa.RecordBatch.from_arrays(columns, names=["owner", "doc_id", "data", "shared"])])))
    assert sum(map(len, shared)) > 40 * rows


def test_packed_numbers_come_back():
    for numbers in ([], [5], [7, 7, 9, 2, (1 << 63) - 1, -4]):
        assert repeats._unpack(repeats._pack(np.array(numbers, np.int64))).tolist() == numbers

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest

from rolemart.llm import packing, registry
from rolemart.llm.queries import tokenizer_path
from tests.llm.conftest import DOCS, SF, doc_rows


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def check(rows, docs, tokenizer, capacity=1024):
    """Every token of every document in one piece, sequences without gaps, little padding."""
    ids = defaultdict(list)
    for doc_id, text in docs:
        ids[doc_id].append(np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc_id, found in ids.items():
        want = sorted((s, zlib.crc32(x[s : s + n].tobytes()), len(x)) for x in found for s, n in [(r["start"], r["length"]) for r in pieces[doc_id]] if s + n <= len(x))
        if len(found) == 1:
            assert want == sorted((r["start"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[doc_id])
        assert sum(r["length"] for r in pieces[doc_id]) == sum(map(len, found))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    totals = [sum(n for _, n in p) for p in sequences.values()]
    assert sum(t < capacity for t in totals) <= 1


def test_query_matches_the_tokenizer(spark, sample, tokenizer):
    check(registry.spark_queries()["op10_pack_min_bin_slack"](spark, SF).collect(), sample, tokenizer)


def test_odd_texts(spark, folder, tokenizer):
    texts = [None, "", " ", "a  b   c", "x\n\n y\t z \n", "it's we'll 'S", "<|endoftext|> <|endoftext|>", "ü  ß x", "word " * 5000, "9 99 1a,b", "\U0001f600 \U0001f600"]
    rows = doc_rows(*texts) + doc_rows("a b c", start=50) + doc_rows("a b c", start=50) + [(None, "null id", None, None, None)]
    path = folder(documents=(DOCS, rows))
    check(registry.spark_queries()["op10_pack_min_bin_slack"](spark, path).collect(), [r[:2] for r in rows], tokenizer)


def test_empty_table_and_ids(spark, folder, frame, tokenizer):
    assert registry.spark_queries()["op10_pack_min_bin_slack"](spark, folder(documents=(DOCS, []))).collect() == []
    docs = frame("doc_id long, text string, task int, rest string, start int", *[(i, f"text number {i} " * i, 1, "r", 2) for i in range(1, 60)])
    rows = packing.pack(docs, tokenizer_path(), capacity=64, with_ids=True, block_tokens=300).collect()
    check(rows, [tuple(r)[:2] for r in docs.collect()], tokenizer, 64)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_best_fill_is_the_best(tokenizer):
    rng = np.random.default_rng(5)
    for _ in range(200):
        counts = {int(x): int(n) for x, n in zip(rng.integers(1, 40, 5), rng.integers(1, 4, 5), strict=True)}
        room = int(rng.integers(0, 90))
        sums = {0}
        for x, n in counts.items():
            sums = {s + k * x for s in sums for k in range(n + 1)}
        taken, total = packing.best_fill(counts, room)
        assert total == max(s for s in sums if s <= room) == sum(x * n for x, n in taken.items())
        assert all(n <= counts[x] for x, n in taken.items())


def test_equal_lengths_leave_no_slack():
    packer = packing.Packer(100, 0, False)
    packer.block([(i, 0, b"\1\0\0\0" * 70, 70) for i in range(1000)])
    packer.finish()
    totals = defaultdict(int)
    for r in packer.out:
        totals[r[5]] += r[2]
    assert sum(totals.values()) == 70_000 and sorted(totals.values())[0] >= 1 and sum(t < 100 for t in totals.values()) <= 1


def test_encoder_remembers_a_bounded_number_of_bytes(tokenizer, monkeypatch):
    """Text without spaces is one long chunk and is not remembered; many short ones are forgotten when they fill the bound."""
    encode = packing.ChunkEncoder(tokenizer_path())
    dense = ["".join(chr(0x4E00 + (7 * i + k) % 9000) for i in range(3_000)) for k in range(40)]
    mixed = " ".join(dense) + " end"
    want = np.array(tokenizer.encode(mixed, add_special_tokens=False).ids, "<u4").tobytes()
    assert encode(mixed) == want and set(encode.memo) == {"end"}
    assert encode(mixed) == want  # again, from what is remembered
    monkeypatch.setattr(packing, "_MEMO_BYTES", 20_000)
    for start in range(0, 2_000, 50):
        text = " ".join(f"word{n}" for n in range(start, start + 50)) + " "
        assert encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encode.memo_bytes <= 20_000 and len(encode.memo) <= 200

"""Benchmark decontamination as a prefix-filtered set join of windows.

Each benchmark item is cut into windows of ``window`` words (a shorter item is one window), each window into shingles of
up to five words. A window that lies in a document has all its shingles there, so one shingle per window is a necessary
prefix: the one that is rarest over all documents. Windows whose rarest shingle occurs nowhere are gone at once. The
others are joined to documents by that shingle; the shingle's place in the window gives the only possible start, the
document's ends bound it, and the window's words are compared with the document's words there.

Scale: documents are read twice, once to count the shingles of the benchmark and once to join, and never shuffled. The
benchmark side goes to the tasks in blocks of at most ``block_windows`` windows, so what is broadcast has a fixed bound;
a larger benchmark takes more blocks over the same rows of the same scan, not a larger broadcast. Counts are summed in
each task before they are shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import bytes_of, landed, shingle_hashes, spare, word_hashes

#: A-Z in lower case; digits, letters and all bytes of other characters stay, everything else parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SHINGLE = 5


def fold_words(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct (item, window): item_id, words (joined by spaces), n_words."""

    @F.arrow_udf("array<struct<words:binary,n_words:int>>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out = []
            for text in texts:
                words = fold_words(text.as_py())
                starts = range(max(1, len(words) - window + 1)) if words else ()
                found = {b" ".join(words[i : i + window]): min(window, len(words)) for i in starts}
                out.append([{"words": w, "n_words": n} for w, n in found.items()])
            yield pa.array(out, pa.list_(pa.struct([("words", pa.binary()), ("n_words", pa.int32())])))

    items = benchmark.select(benchmark["item_id"].cast("string").alias("item_id"), bytes_of(benchmark).alias("text"))
    return items.select("item_id", F.explode(cut("text")).alias("w")).select("item_id", "w.words", "w.n_words").distinct()


class ShingleIndex:
    """Sorted shingle hashes by shingle size, for looking up all shingles of a document at once."""

    def __init__(self, by_size: dict[int, np.ndarray]) -> None:
        self.by_size = {size: np.unique(hashes) for size, hashes in by_size.items()}
        self.bits = {}
        for size, hashes in self.by_size.items():
            # one bit per hash value modulo a power of two, eight times wider than the hashes are many
            width = 1 << max(16, int(8 * len(hashes)).bit_length())
            flags = np.zeros(width, bool)
            flags[(hashes & np.uint64(width - 1)).astype(np.int64)] = True
            self.bits[size] = flags

    def hits(self, hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, positions, shingle hashes) of the document's shingles that are in the index."""
        for size, known in self.by_size.items():
            own = shingle_hashes(hashes, size)
            flags = self.bits[size]
            at = np.flatnonzero(flags[(own & np.uint64(len(flags) - 1)).astype(np.int64)])
            if len(at):
                place = np.minimum(np.searchsorted(known, own[at]), len(known) - 1)
                at = at[known[place] == own[at]]
            if len(at):
                yield size, at, own[at]


def _window_shingles(words: bytes) -> tuple[int, np.ndarray]:
    hashes = word_hashes(words.split(b" "))
    size = min(SHINGLE, len(hashes))
    return size, shingle_hashes(hashes, size)


def _count_shingles(texts: DataFrame, index: ShingleIndex) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(index)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            for text in batch.column(0):
                for size, _, own in sent.value.hits(word_hashes(fold_words(text.as_py()))):
                    for h, n in zip(*(x.tolist() for x in np.unique(own, return_counts=True)), strict=True):
                        totals[size, h] += n
        keys = [k for k, _ in totals]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int32()), pa.array(np.array([h for _, h in totals], np.uint64).view(np.int64)), pa.array(totals.values(), pa.int64())],
            names=["size", "shingle", "n"],
        )

    return texts.mapInArrow(count, "size int, shingle long, n long").groupBy("size", "shingle").agg(F.sum("n").alias("n"))


class WindowIndex:
    """Windows of one block under their rarest shingle: hash -> [(offset in the window, words, item ids)]."""

    def __init__(self, windows: list[tuple[bytes, list[str]]], counts: dict[tuple[int, int], int]) -> None:
        self.windows: dict[tuple[int, int], list] = defaultdict(list)
        for words, items in windows:
            size, shingles = _window_shingles(words)
            rarity = [(counts.get((size, h), 0), h, i) for i, h in enumerate(shingles.tolist())]
            n, h, offset = min(rarity)
            if n:
                self.windows[size, h].append((offset, words.split(b" "), items))
        by_size = defaultdict(list)
        for size, h in self.windows:
            by_size[size].append(h)
        self.index = ShingleIndex({size: np.array(hs, np.uint64) for size, hs in by_size.items()})

    def search(self, words: list[bytes], covered: set[tuple[int, int]], items: set[str]) -> None:
        for size, at, own in self.index.hits(word_hashes(words)):
            for position, h in zip(at.tolist(), own.tolist(), strict=True):
                for offset, window, ids in self.windows[size, h]:
                    start = position - offset
                    if 0 <= start <= len(words) - len(window) and words[start : start + len(window)] == window:
                        covered.add((start, start + len(window)))
                        items.update(ids)


def _merged(spans: set[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


LEAK = "struct<n_words:long,spans:array<struct<start:long,end:long>>,items:array<string>>"


def with_leaks(docs: DataFrame, benchmark: DataFrame, column: str, window: int = 10, block_windows: int = 200_000) -> DataFrame:
    """All rows and columns of ``docs`` and, as ``column``, what of the benchmark occurs in the whole of ``text``.

    The column has n_words, the covered word ranges as merged spans (end exclusive), and the item ids as sorted strings.
    A NULL or empty text, and one without words, has no words and no spans. Items that are NULL or have no words have no
    windows. Windows of an item with a NULL item_id mark spans like others, only the ids cannot list it. Items with equal windows are all reported.
    Repeated rows are each marked. An empty benchmark marks nothing. Further columns of either table pass through or are
    ignored, whatever their names.
    """
    spark = docs.sparkSession
    windows = landed(
        benchmark_windows(benchmark, window)
        .groupBy("words").agg(F.sort_array(F.collect_set("item_id")).alias("items")), "windows")
    n_blocks = max(1, -(-windows.count() // block_windows))
    block = F.pmod(F.xxhash64("words"), F.lit(n_blocks))
    texts = docs.select(bytes_of(docs).alias("text"))
    state, before = spare(docs, "leak_state"), None
    out = docs
    for k in range(n_blocks):
        rows = [(bytes(r["words"]), r["items"]) for r in windows.where(block == k).toLocalIterator()]
        by_size = defaultdict(set)
        for words, _ in rows:
            size, shingles = _window_shingles(words)
            by_size[size].update(shingles.tolist())
        shingles = ShingleIndex({size: np.array(list(hs), np.uint64) for size, hs in by_size.items()})
        counted = _count_shingles(texts, shingles).toLocalIterator() if rows else []
        counts = {(r["size"], r["shingle"] % (1 << 64)): r["n"] for r in counted}
        sent = spark.sparkContext.broadcast(WindowIndex(rows, counts))
        out = out.withColumn(state, _searcher(sent, before is not None)(bytes_of(docs), *([F.col(before)] if before else [])))
        if before:
            out = out.drop(before)
        before, state = state, spare(out, "leak_state")
    return out.withColumnRenamed(before, column)


def _searcher(sent, again: bool):
    """A search of one block; a later block adds to what the earlier ones found."""
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])

    def leaks(texts: pa.Array, found: pa.Array | None) -> pa.Array:
        out = []
        for i, text in enumerate(texts):
            words = fold_words(text.as_py())
            earlier = found[i].as_py() if found is not None else {"spans": [], "items": []}
            spans, items = {(s["start"], s["end"]) for s in earlier["spans"]}, set(earlier["items"])
            sent.value.search(words, spans, items)
            out.append({"n_words": len(words), "spans": [{"start": s, "end": e} for s, e in _merged(spans)], "items": sorted(items)})
        return pa.array(out, kind)

    if again:
        @F.arrow_udf(LEAK)
        def search(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, found in batches:
                yield leaks(texts, found)
    else:
        @F.arrow_udf(LEAK)
        def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in batches:
                yield leaks(texts, None)
    return search.asNondeterministic()

"""Exact removal of long repeats with a run-length index.

A byte goes if a string of ``size`` bytes around it also starts in a document with a smaller id.

0. Copies. Of equal texts only that with the smallest id takes part below: the others repeat it as a whole, and no string
   starts in them that does not start in it.
1. Anchors. In every window of ``size`` bytes, the position whose k-gram has the smallest hash is an anchor. Equal windows
   have equal anchors at the same place, so only windows at anchors that another text has too can repeat; the packed
   exchange finds those without a row per anchor.
2. Segments. Each shared anchor is cut out with all windows it anchors. Segments with equal anchors meet in one bucket. A
   task sends a segment once, for the smallest document that has it there; for its other documents the segment is
   a repeat as a whole. So a passage that a third of the corpus shares is sent once per task.
3. Index. Where all segments of an anchor are the same they are settled as a whole. Of the others, a bucket sorts the windows,
   and keeps the byte before each window as runs, with a sample at each run's head: the document there. Ties are in the order
   of the documents, so the sample at the head of a group of equal windows is its smallest document.
4. Marking. A window whose group's sample is a smaller document is a repeat, and goes back to its document. Groups decide this;
   there is no backward search and no match length, so the runs save room and are not needed for the result.

Everything a task holds is a chunk of anchors, a bucket of segments, or one document.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import bytes_of, landed, mixed, tidy
from rolemart.llm.exchange import batch_of, bucket_bits, cut, expected_units, shared_hashes

_LAST = (1 << 63) - 1
_HOT_BITS = 1 << 22
_AT_ONCE = 16_384  # segments whose windows are looked up together
_INDEXED = 1 << 18  # windows, about, that are indexed together
_CHUNK_BYTES, _BUCKET_BYTES = 40_000_000, 4_000_000
_SENT = "bucket int, chunk long, own binary, numbers binary, segments binary"
_ANSWER = "chunk long, own binary, marks binary"


def _words_at(data: np.ndarray, offset: int, n: int) -> np.ndarray:
    """The eight bytes at each of n places as one integer."""
    return np.ndarray((n,), np.uint64, data, offset, (1,)).copy()


@dataclass(frozen=True)
class Anchoring:
    """Minimizers: in each window of ``size`` bytes the k-gram with the smallest hash."""

    size: int = 50
    k: int = 20

    def anchors(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first window start, last window start) per anchor; each window start belongs to one anchor."""
        n = len(data) - self.size + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        words, grams = _words_at(data, 0, len(data) - 7), len(data) - self.k + 1
        least = mixed(mixed(mixed(words[:grams]) + words[8 : 8 + grams]) + words[self.k - 8 : self.k - 8 + grams])
        reach, width = 1, self.size - self.k + 1
        while reach < width:  # minima over spans that double in width
            step = min(reach, width - reach)
            least = np.minimum(least[step:], least[:-step])
            reach += step
        # neighbours with one hash are one anchor: a stretch of equal bytes has one, however long it is
        new = np.ones(n, bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        first = np.flatnonzero(new)
        return least[first], first, np.append(first[1:] - 1, n - 1)


class RunIndex:
    """The run-compressed Burrows-Wheeler transform of a bucket's windows.

    Windows are sorted by content, equal ones by document. ``byte`` is what stands before each window; a run is a stretch of
    equal windows with equal bytes. Per run are kept: where it starts, its byte, the document at its head, and whether a
    new window begins with it.
    """

    def __init__(self, text: np.ndarray, starts: np.ndarray, docs: np.ndarray, opens: np.ndarray, size: int) -> None:
        offsets = [*range(0, size - 7, 8), size - 8]
        # eight bytes at each place, the first weighing most, so that numbers compare as strings do
        words = _words_at(text, 0, len(text) - 7).byteswap()
        keys = [words[starts + o] for o in offsets]
        self.order = np.lexsort((docs, *reversed(keys)))
        new = np.zeros(len(starts), bool)
        new[:1] = True
        for key in keys:
            ranked = key[self.order]
            new[1:] |= ranked[1:] != ranked[:-1]
        ranked = starts[self.order]
        byte = np.where(opens[self.order], 0, text[np.maximum(ranked - 1, 0)])
        turns = new.copy()
        turns[1:] |= byte[1:] != byte[:-1]
        self.run_start = np.flatnonzero(turns)
        self.run_byte = byte[self.run_start]
        self.run_doc = docs[self.order][self.run_start]
        self.run_opens = new[self.run_start]

    def smallest_documents(self) -> np.ndarray:
        """For each window, in the order given, the smallest document that has an equal one.

        Streams over the runs: a run that opens a window group carries the sample that holds for the runs up to the next.
        """
        group = np.cumsum(self.run_opens) - 1
        per_run = self.run_doc[np.flatnonzero(self.run_opens)][group]
        lengths = np.diff(np.append(self.run_start, len(self.order)))
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.repeat(per_run, lengths)
        return out


def mark_bucket(segments: list[bytes], docs: list[int], keys: list[int], size: int) -> np.ndarray:
    """Rows (segment, first window, end) of the windows that a smaller document of the bucket has, in the segments' order.

    Windows can only be equal if their anchors are. Where all segments of an anchor are the same, so are their windows; indexes
    are built over the others, each over some anchors, so that they do not grow with the bucket.
    """
    first = _first_places(segments)
    distinct = np.flatnonzero(first == np.arange(len(segments)))
    which = np.searchsorted(distinct, first)
    holder = np.array(docs, np.int64)
    smallest_of = np.full(len(distinct), _LAST)
    np.minimum.at(smallest_of, which, holder)
    lengths = np.fromiter(map(len, segments), np.int64, len(segments))
    key = np.array(keys, np.int64)[distinct]
    _, kind, variants = np.unique(key, return_inverse=True, return_counts=True)
    alone = variants[kind] == 1
    whole = np.flatnonzero(alone[which] & (smallest_of[which] < holder))
    found = [np.stack([whole, np.zeros_like(whole), lengths[whole] - size + 1], 1)]
    # variants in the order of their anchors, and segments in the order of their variants
    texts = np.flatnonzero(~alone)
    texts = texts[np.argsort(kind[texts], kind="stable")]
    place = np.full(len(distinct), -1)
    place[texts] = np.arange(len(texts))
    contested = np.flatnonzero(place[which] >= 0)
    contested = contested[np.argsort(place[which[contested]], kind="stable")]
    counts = lengths[distinct[texts]] - size + 1
    until = np.cumsum(counts)
    ends = np.append(np.flatnonzero(np.diff(kind[texts])) + 1, len(texts))  # behind an anchor's last variant
    low = 0
    while low < len(texts):
        full = np.searchsorted(until, until[low] - counts[low] + _INDEXED)
        high = int(ends[min(np.searchsorted(ends, max(full, low + 1)), len(ends) - 1)])
        here = texts[low:high]
        n_windows, opens_at = counts[low:high], until[low:high] - counts[low:high] - until[low] + counts[low]
        text = b"".join([segments[i] for i in distinct[here].tolist()])
        within = np.arange(n_windows.sum()) - np.repeat(opens_at, n_windows)
        begins = opens_at + np.arange(high - low) * (size - 1)
        owner = np.repeat(smallest_of[here], n_windows)
        index = RunIndex(np.frombuffer(text, np.uint8), np.repeat(begins, n_windows) + within, owner, within == 0, size)
        smallest = index.smallest_documents()
        asked = contested[slice(*np.searchsorted(place[which[contested]], [low, high]))]
        for at in range(0, len(asked), _AT_ONCE):
            part = asked[at : at + _AT_ONCE]
            own_place = place[which[part]] - low
            n = n_windows[own_place]
            opens = np.cumsum(n) - n
            window = np.repeat(opens_at[own_place] - opens, n) + np.arange(n.sum())
            gone = smallest[window] < np.repeat(holder[part], n)
            before, after = np.append(False, gone[:-1]), np.append(gone[1:], False)
            before[opens] = after[opens + n - 1] = False  # ranges end with their segment
            begin, end = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after) + 1
            own = np.searchsorted(opens, begin, "right") - 1
            found.append(np.stack([part[own], begin - opens[own], end - opens[own]], 1))
        low = high
    rows = np.concatenate(found)
    return rows[np.argsort(rows[:, 0], kind="stable")]


def _first_places(texts: list[bytes]) -> np.ndarray:
    """For each text the place of the first that is equal."""
    known: dict[bytes, int] = {}
    return np.fromiter(map(known.setdefault, texts, range(len(texts))), np.int64, len(texts))


@cache
def _packer(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


@cache
def _unpacker() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _squeezed(data: bytes, level: int) -> bytes:
    return _packer(level).compress(data)


def _plain(data: bytes) -> bytes:
    return _unpacker().decompress(data)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers as their steps; those of a chunk mostly rise by little, and steps pack to a fraction."""
    steps = np.empty((len(columns), len(columns[0])), np.int64)
    for step, numbers in zip(steps, columns, strict=True):
        step[:1] = numbers[:1]
        np.subtract(numbers[1:], numbers[:-1], out=step[1:])
    return _squeezed(steps.tobytes(), 1)


def _unpack(packed: bytes, columns: int = 1) -> np.ndarray:
    numbers = np.cumsum(np.frombuffer(_plain(packed), np.int64).reshape(columns, -1), axis=1)
    return numbers if columns > 1 else numbers[0]


def merged_ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of ranges as sorted, disjoint, not touching (start, end) rows."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    return np.stack([starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]], 1).astype(np.int64)


def _hot_anchors(shared: DataFrame, often: int, blocks: int) -> np.ndarray:
    """Anchors that at least ``often`` documents of some block share, as bits of a fixed number of hash values.

    Their segments differ at the ends of the passage they lie in, so they would all go to one bucket; they are spread by
    window instead. Which anchors those are is decided once for all tasks, and a wrong bit does no harm.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(_HOT_BITS, np.uint32)
        for batch in batches:
            keys = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x.as_py(), np.uint64) for x in batch.column(0))])
            times += np.bincount((mixed(keys) % np.uint64(_HOT_BITS)).astype(np.int64), minlength=_HOT_BITS).astype(np.uint32)
        hot = np.flatnonzero(times >= often).astype(np.uint64)
        bits = np.zeros(_HOT_BITS // 64, np.uint64)
        np.bitwise_or.at(bits, (hot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (hot & np.uint64(63)))
        at = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

    found = shared.select("shared").coalesce(blocks).mapInArrow(count, "at int, bits long")
    rows = found.groupBy("at").agg(F.bit_or("bits").alias("bits")).collect()  # at most _HOT_BITS / 64
    out = np.zeros(_HOT_BITS // 64, np.uint64)
    for r in rows:
        out[r["at"]] = r["bits"] % (1 << 64)
    return out


def _is_hot(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = mixed(keys) % np.uint64(_HOT_BITS)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


class _Chunk:
    """Segments of some documents: what is sent, what is settled already, and who waits for an answer."""

    def __init__(self, number: int, buckets: int) -> None:
        self.number, self.buckets = number, buckets
        self.docs: list[tuple[int, bytes, np.ndarray, np.ndarray, list[bytes]]] = []
        self.size = 0

    def add(self, doc: int, owner: bytes, starts: np.ndarray, keys: np.ndarray, segments: list[bytes]) -> None:
        """A document's segments in the order of their starts and ends."""
        self.docs.append((doc, owner, starts, keys, segments))
        self.size += sum(map(len, segments)) + 100 * len(segments)

    def rows(self) -> list[tuple]:
        """A row for each bucket that gets segments. There are as many as chunks times buckets, so both are large."""
        self.docs.sort(key=lambda d: d[0])
        docs, owners, starts, keys, segments = zip(*self.docs, strict=True)
        counts = [len(x) for x in segments]
        number, doc = np.repeat(np.arange(len(docs)), counts), np.repeat(np.array(docs, np.int64), counts)
        start, key, segments = np.concatenate(starts), np.concatenate(keys), list(chain.from_iterable(segments))
        address = _first_places(segments)
        lengths = np.fromiter(map(len, segments), np.int64, len(segments))
        later = doc[address] < doc
        waiting = ~later
        owner, begin, end = number[later], start[later], start[later] + lengths[later]
        apart = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (begin[1:] > end[:-1])))) if len(owner) else owner
        settled = owner[apart], begin[apart], end[np.append(apart[1:] - 1, len(end) - 1)] if len(owner) else end
        own = pickle.dumps((b"".join(owners), _pack(address[waiting], number[waiting], start[waiting]), _pack(*settled)))
        rows = [(self.number % self.buckets, self.number, own, None, None)]
        sent = np.flatnonzero(address == np.arange(len(segments)))
        bucket = (key[sent] % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        sent, bucket = sent[order], bucket[order]
        present, at = np.unique(bucket, return_index=True)
        low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        for b, a, z in zip(present.tolist(), at.tolist(), np.append(at[1:], len(sent)).tolist(), strict=False):
            part = sent[a:z]
            numbers = pickle.dumps((_pack(part, doc[part], lengths[part]), low[part].tobytes()))
            # text packs to a fraction of what the shuffle's own codec leaves
            rows.append((b, self.number, None, numbers, _squeezed(b"".join([segments[i] for i in part.tolist()]), 3)))
        return rows


def _spread(data: bytes, first: int, last: int, size: int) -> Iterator[tuple[int, int]]:
    """Windows from ``first`` to ``last``; those of a stretch of one byte are all the same: one segment."""
    start = first
    while start <= last:
        window, end = data[start : start + size], start + size
        if window == window[:1] * size:
            while end < last + size and data[end] == window[0]:
                end += 1
        yield start, end
        start = end - size + 1


def _segment_rows(anchoring: Anchoring, bits: int, buckets: int, hot, chunk_bytes: int = _CHUNK_BYTES):
    """Arrow function over (owner, doc_id, data, shared): cut the shared anchors' segments out and send them."""
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 3]
    names = [c.split()[0] for c in _SENT.split(", ")]
    size = anchoring.size

    def segments_of(data: bytes, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        hashes, first, last = anchoring.anchors(data)
        keys, known = cut(hashes, bits), np.sort(shared)
        at = np.flatnonzero(known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys) if len(known) else np.empty(0, np.int64)
        keys, start, end = keys[at], first[at], last[at] + size
        spread = _is_hot(hot.value, keys)
        if spread.any():
            if (spread & (end - start >= 2 * size)).any():
                spans = [[*_spread(data, a, z - size, size)] if s else [(a, z)] for a, z, s in zip(start.tolist(), end.tolist(), spread.tolist(), strict=True)]
                counts = [len(x) for x in spans]
                start, end = np.array([*chain.from_iterable(spans)], np.int64).T
            else:
                counts = np.where(spread, end - start - size + 1, 1)
                opens = np.cumsum(counts) - counts
                start = np.repeat(start - opens, counts) + np.arange(counts.sum())
                end = np.where(np.repeat(spread, counts), start + size, np.repeat(end, counts))
            keys, spread = np.repeat(keys, counts), np.flatnonzero(np.repeat(spread, counts))
            keys[spread] = [xxhash.xxh3_64_intdigest(data[a : a + size]) for a in start[spread].tolist()]
        return start, keys, [data[a:z] for a, z in zip(start.tolist(), end.tolist(), strict=True)]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        chunk, seen = _Chunk(task << 24, buckets), set()
        for batch in batches:
            for owner, doc, data, shared in zip(*batch.columns, strict=True):
                owner, doc = owner.as_py(), doc.as_py()
                if owner in seen or not shared.is_valid:
                    continue
                seen.add(owner)
                chunk.add(_LAST if doc is None else doc, owner, *segments_of(data.as_py(), np.frombuffer(shared.as_py(), np.uint64)))
                if chunk.size >= chunk_bytes:
                    yield batch_of(chunk.rows(), kinds, names)
                    sequence += 1
                    chunk, seen = _Chunk(task << 24 | sequence, buckets), set()
        if chunk.docs:
            yield batch_of(chunk.rows(), kinds, names)

    return send


def _answer_bucket(size: int):
    kinds, names = [pa.int64(), pa.binary(), pa.binary()], [c.split()[0] for c in _ANSWER.split(", ")]

    def answer(table: pa.Table) -> pa.Table:
        rows, segments, numbers, keys, chunks = [], [], [], [], []
        for r in table.to_pylist():
            if r["segments"] is None:
                rows.append((r["chunk"], r["own"], None))
                continue
            packed, key = pickle.loads(r["numbers"])
            numbers.append(_unpack(packed, 3))
            keys.append(np.frombuffer(key, np.uint32))
            ends, text = np.cumsum(numbers[-1][2]).tolist(), _plain(r["segments"])
            segments += [text[a:z] for a, z in zip([0, *ends], ends, strict=False)]
            chunks.append(np.full(len(ends), r["chunk"]))
        if segments:
            addresses, docs, _ = np.concatenate(numbers, axis=1)
            found = mark_bucket(segments, docs, np.concatenate(keys), size)
            chunk, address = np.concatenate(chunks)[found[:, 0]], addresses[found[:, 0]]
            order = np.lexsort((address, chunk))
            chunk, address, found = chunk[order], address[order], found[order]
            present, at = np.unique(chunk, return_index=True)
            for c, a, z in zip(present.tolist(), at.tolist(), np.append(at[1:], len(chunk)).tolist(), strict=False):
                rows.append((c, None, _pack(address[a:z], found[a:z, 1], found[a:z, 2])))
        return pa.Table.from_batches([batch_of(rows, kinds, names)])

    return answer


def _settle_chunk(size: int):
    def settle(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        told, waiting, settled = pickle.loads(next(r["own"] for r in rows if r["own"] is not None))
        owners = [told[i : i + 16] for i in range(0, len(told), 16)]
        waiting, settled = _unpack(waiting, 3).T, _unpack(settled, 3).T
        answers = [_unpack(r["marks"], 3) for r in rows if r["own"] is None]
        address, first, end = np.concatenate([np.empty((3, 0), np.int64), *answers], axis=1)
        # an address may stand at several places: repeat its ranges of windows for each
        order = np.argsort(address, kind="stable")
        address, first, end = address[order], first[order], end[order]
        low, high = np.searchsorted(address, waiting[:, 0]), np.searchsorted(address, waiting[:, 0], "right")
        n = high - low
        pick = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(waiting[:, 2], n)
        number = np.concatenate([np.repeat(waiting[:, 1], n), settled[:, 0]])
        starts, ends = np.concatenate([at + first[pick], settled[:, 1]]), np.concatenate([at + end[pick] - 1 + size, settled[:, 2]])
        order = np.argsort(number, kind="stable")
        number, starts, ends = number[order], starts[order], ends[order]
        present, at = np.unique(number, return_index=True)
        out = [(owners[o], merged_ranges(starts[a:z], ends[a:z]).tobytes()) for o, a, z in zip(present.tolist(), at.tolist(), np.append(at[1:], len(number)).tolist(), strict=False)]
        return pa.Table.from_batches([batch_of(out, [pa.binary(), pa.binary()], ["owner", "marks"])])

    return settle


def remove_repeats(docs: DataFrame, size: int = 50, with_text: bool = False, often: int = 256) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the remaining bytes with ``with_text``.

    Texts are UTF-8 bytes; a NULL text is empty. A byte goes if it is covered by a string of ``size`` bytes (24 or more) that
    also starts in a document with a smaller doc_id; what is repeated is judged on the input. A string that only
    repeats within its own document, or in rows with the same doc_id, stays. A NULL doc_id counts as larger than every
    other. Repeated rows get equal results. Texts shorter than ``size`` stay whole. An empty table gives no rows; further
    columns are ignored. Matches never cross documents, whatever their texts' lengths.
    """
    anchoring = Anchoring(size, max(16, min(20, size - 8)))
    data = bytes_of(docs)
    doc_id = docs["doc_id"].cast("long")

    def owner(text_id: Column, doc: Column) -> Column:
        # both parts have a fixed width, a NULL id none, so different rows never give the same string
        id_bytes = F.coalesce(F.unhex(F.lpad(F.hex(doc), 16, "0")), F.lit(b""))
        return F.coalesce(F.unhex(F.md5(F.concat(text_id, id_bytes))), F.lit(b""))

    text_id = F.unhex(F.substring(F.sha2(data, 256), 1, 32))
    read = docs.select(owner(text_id, doc_id).alias("owner"), doc_id.alias("doc_id"), data.alias("data"))
    n_bytes = expected_units(docs, 1)
    bits = bucket_bits(int(n_bytes * 0.065))
    texts = docs.select(F.coalesce(text_id, F.lit(b"")).alias("owner"), doc_id.alias("doc_id"), data.alias("data"))
    shared = shared_hashes(texts.select("owner", "data"), lambda x: anchoring.anchors(x)[0], bits)
    # per text the row it is judged by, and its anchors that other texts have; a text of several chunks has equal anchors in each
    both = texts.select("owner", "doc_id", F.lit(None).cast("binary").alias("shared")).unionByName(shared.select("owner", F.lit(None).cast("long").alias("doc_id"), "shared"))
    found = both.groupBy("owner").agg(F.min("doc_id").alias("doc_id"), F.first("shared", ignorenulls=True).alias("shared"))
    firsts = landed(found.select(owner(found["owner"], found["doc_id"]).alias("owner"), "shared"), "shared-anchors")
    # the exchanges behind it are done; their files else stay until the driver happens to collect its garbage
    docs.sparkSession.sparkContext._jvm.System.gc()
    sharing = firsts.where(F.col("shared").isNotNull())
    hot = docs.sparkSession.sparkContext.broadcast(_hot_anchors(sharing, often, 1 + n_bytes // 1_000_000_000))
    buckets = max(16, n_bytes // _BUCKET_BYTES)
    # both joins read the same exchange of the texts
    held = read.join(sharing.hint("shuffle_hash"), "owner", "left").select("owner", "doc_id", "data", "shared")
    marks = (
        held.mapInArrow(tidy(_segment_rows(anchoring, bits, buckets, hot)), _SENT)
        .groupBy("bucket").applyInArrow(tidy(_answer_bucket(size)), _ANSWER)
        .groupBy("chunk").applyInArrow(tidy(_settle_chunk(size)), "owner binary, marks binary")
        .unionByName(firsts.select("owner", F.lit(None).cast("binary").alias("marks")))
        .groupBy("owner").agg(F.first("marks", ignorenulls=True).alias("marks"))  # equal rows of two chunks have equal marks
        .withColumn("is_first", F.lit(True))
    )
    out_kinds = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_text
    out_names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, found, is_first in zip(*batch.columns, strict=True):
                text, kept, gone, spans = text.as_py(), [], 0, np.empty((0, 2), np.int64)
                if not is_first.is_valid and len(text) >= size:
                    spans = np.array([[0, len(text)]], np.int64)
                elif found.is_valid:
                    spans = np.frombuffer(found.as_py(), np.int64).reshape(-1, 2)
                at = 0
                for a, z in spans.tolist():
                    kept.append(text[at:a])
                    gone, at = gone + z - a, z
                rest = b"".join([*kept, text[at:]])
                rows.append((doc_id.as_py(), len(text), gone, len(spans), hashlib.sha256(rest).hexdigest(), *[rest] * with_text))
            yield batch_of(rows, out_kinds, out_names)

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return read.join(marks.hint("shuffle_hash"), "owner", "left").select("doc_id", "data", "marks", "is_first").mapInArrow(tidy(finish), ddl)

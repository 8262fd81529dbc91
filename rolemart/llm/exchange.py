"""Which hashes of an owner also belong to another owner, for many hashes per owner.

A row per hash would cost far more than the hashes. So each task gathers the hashes of a chunk of owners, sorts them, and
sends one row per bucket of the hash space with packed arrays. Hashes that two owners of the chunk share are settled at
once; of such a hash, however many owners it has, one record is sent. Buckets find the hashes that came from two chunks and
answer the chunks; a chunk's answers come together in one row group again.

Hashes are cut to 32 bits and the bucket's bits, so two different values may meet by chance, about one time in
2^32 * buckets / hashes. Answers are therefore a superset of the truth; users confirm them on the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import tidy

_SENT = "bucket int, chunk long, owners binary, hashes binary, repeated binary, times binary, numbers binary, prints binary"
_ANSWER = "chunk long, owners binary, hashes binary, popular binary, is_own boolean"


#: An owner's number in its chunk takes two bytes; a fuller chunk is sent and the next one begins.
_MOST_OWNERS = 1 << 16


def cut(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The form in which shared hashes are returned: the top bits that are compared."""
    return hashes >> np.uint64(64 - 32 - bits)


def bucket_bits(expected_hashes: int, per_bucket: int = 1_500_000) -> int:
    """Bits that number the buckets; there are as many as the hashes need, so a bucket's size does not grow with the data."""
    return int(max(8, expected_hashes // per_bucket) - 1).bit_length()


def batch_of(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _fields(table: pa.Table) -> Iterator[dict]:
    """The rows of a table without NULL fields; binary ones as buffers, not copied."""
    for batch in table.to_batches():
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i] for j, n in enumerate(batch.schema.names)}
            yield {n: x.as_buffer() if isinstance(x, pa.BinaryScalar) else x.as_py() for n, x in row.items() if x.is_valid}


def _numbers(data: pa.Buffer, kind: type) -> np.ndarray:
    return np.frombuffer(data, kind) if data.size else np.empty(0, kind)


def shared_hashes(
    owners: DataFrame, hashes_of: Callable[[bytes], np.ndarray], bits: int, popular: int | None = None, chunk_hashes: int = 500_000
) -> DataFrame:
    """(owner binary, n long, shared binary, n_popular long), for owners that have hashes which another owner has too: how many
    hashes an owner has, those that are shared (cut, uint64), and how many of them more than ``popular`` owners have.

    Rows with equal ids are one owner, but in the count for ``popular`` such an owner may weigh once per chunk.

    ``owners`` has two binary columns: an id, equal ids meaning equal content, and the content. ``hashes_of`` gives the distinct
    64-bit hashes of a content.
    """
    sent_types = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
    sent_names = [c.split()[0] for c in _SENT.split(", ")]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, sequence = TaskContext.get().partitionId(), 0
        index: dict[bytes, int] = {}
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            chunk = task << 24 | sequence
            lengths = [len(h) for h in held]
            hashes = np.concatenate(held) if held else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(held), dtype=np.uint32), lengths)
            order = np.argsort(hashes)
            hashes, owner = hashes[order], owner[order]
            new = np.ones(len(hashes), bool)
            new[1:] = hashes[1:] != hashes[:-1]
            last = np.ones(len(hashes), bool)
            last[:-1] = new[1:]
            single = new & last
            own = ~single
            rows = [(int(chunk % (1 << bits)), chunk, b"".join(x.ljust(16, b"\0") + len(h).to_bytes(4, "little") for x, h in zip(index, held, strict=True)), owner[own].tobytes() + hashes[own].tobytes(), None, None, None, None)]
            # ids are digests: eight bytes of them tell equal from different owners
            prints = np.frombuffer(b"".join(x.ljust(8, b"\0")[:8] for x in index), np.uint64)
            alone, alone_owner, multiple = hashes[single], owner[single], hashes[new & ~last]
            times = np.diff(np.append(np.flatnonzero(new), len(hashes)))
            times = times[times > 1].astype(np.uint32)
            low, low_multiple = alone.astype(np.uint32), multiple.astype(np.uint32)
            buckets, buckets_multiple = alone >> np.uint64(32), multiple >> np.uint64(32)
            present = np.union1d(buckets, buckets_multiple)
            at, at_multiple = (np.searchsorted(x, present).tolist() for x in (buckets, buckets_multiple))
            to, to_multiple = (np.searchsorted(x, present, "right").tolist() for x in (buckets, buckets_multiple))
            for b, a, z, am, zm in zip(present.tolist(), at, to, at_multiple, to_multiple, strict=True):
                here, local = np.unique(alone_owner[a:z], return_inverse=True)
                packed = (local.astype(np.uint16), low[a:z], low_multiple[am:zm], times[am:zm], here.astype(np.uint16), prints[here])
                rows.append((b, chunk, *(x.tobytes() for x in packed)))
            return batch_of(rows, sent_types, sent_names)

        for batch in batches:
            for key, content in zip(batch.column(0), batch.column(1), strict=True):
                key = key.as_py()
                if key in index:
                    continue
                hashes = np.unique(cut(hashes_of(content.as_py()), bits))
                if not len(hashes):
                    continue
                index[key] = len(held)
                held.append(hashes)
                size += len(hashes)
                if size >= chunk_hashes or len(held) == _MOST_OWNERS:
                    yield flush()
                    index, held, size, sequence = {}, [], 0, sequence + 1
        if held:
            yield flush()

    answer_types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.bool_()]
    answer_names = [c.split()[0] for c in _ANSWER.split(", ")]

    def answer(table: pa.Table) -> pa.Table:
        top = np.uint64(table.column("bucket")[0].as_py() << 32)
        rows, sent, singles, repeated, times, owners = [], [], [], [], [], []
        prints, first = [], 0
        for r in _fields(table):
            if "repeated" not in r:
                rows.append((r["chunk"], r["owners"].to_pybytes(), r["hashes"].to_pybytes(), None, True))
                continue
            sent.append((r["chunk"], _numbers(r["owners"], np.uint16), _numbers(r["numbers"], np.uint16)))
            singles.append(_numbers(r["hashes"], np.uint32))
            repeated.append(_numbers(r["repeated"], np.uint32))
            times.append(_numbers(r["times"], np.uint32))
            prints.append(_numbers(r["prints"], np.uint64))
            owners.append(sent[-1][1].astype(np.int64) + first)
            first += len(prints[-1])
        none = np.empty(0, np.uint32)
        # an owner that stands in several chunks counts once: its prints are the same everywhere, and so is its number here
        _, number = np.unique(np.concatenate([none.astype(np.uint64), *prints]), return_inverse=True)
        met = np.concatenate([none, *singles]).astype(np.uint64) << np.uint64(32)
        met |= number.astype(np.uint64)[np.concatenate([none.astype(np.int64), *owners])]
        met.sort()
        met = (met[np.concatenate(([True], met[1:] != met[:-1]))] >> np.uint64(32)).astype(np.uint32) if len(met) else none
        begins = np.flatnonzero(np.concatenate(([True], met[1:] != met[:-1]))) if len(met) else np.empty(0, np.int64)
        alone, count = met[begins], np.diff(np.append(begins, len(met)))
        multiple = np.concatenate([none, *repeated])
        order = np.argsort(multiple)
        multiple, often = multiple[order], np.concatenate([none, *times])[order]
        begins = np.flatnonzero(np.concatenate(([True], multiple[1:] != multiple[:-1]))) if len(multiple) else np.empty(0, np.int64)
        often = np.add.reduceat(often, begins, dtype=np.int64) if len(multiple) else often.astype(np.int64)
        multiple = multiple[begins]
        place = np.searchsorted(alone, multiple)
        both = place < len(alone)
        both[both] = alone[place[both]] == multiple[both]
        twice = np.union1d(alone[count > 1], multiple[both])
        many = none
        if popular is not None:
            count[place[both]] += often[both]
            many = np.union1d(alone[count > popular], multiple[~both & (often > popular)])

        def among(own: np.ndarray, known: np.ndarray) -> np.ndarray:
            return known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own if len(known) else np.zeros(len(own), bool)

        for (chunk, local, numbers), own, multiple in zip(sent, singles, repeated, strict=True):
            hit = among(own, twice)
            famous = np.concatenate([own[among(own, many)], multiple[among(multiple, many)]])
            if hit.any() or len(famous):
                full = own[hit].astype(np.uint64) | top
                rows.append((chunk, numbers[local[hit]].astype(np.uint32).tobytes(), full.tobytes(), (famous.astype(np.uint64) | top).tobytes(), False))
        return pa.Table.from_batches([batch_of(rows, answer_types, answer_names)])

    def settle(table: pa.Table) -> pa.Table:
        owner, hashes, famous = [], [], [np.empty(0, np.uint64)]
        for r in _fields(table):
            if r["is_own"]:
                told = r["owners"].to_pybytes()
                keys = [(told[i : i + 16], int.from_bytes(told[i + 16 : i + 20], "little")) for i in range(0, len(told), 20)]
                n = r["hashes"].size // 12
                owner.append(_numbers(r["hashes"].slice(0, 4 * n), np.uint32))
                hashes.append(np.frombuffer(r["hashes"].slice(4 * n).to_pybytes(), np.uint64))
            else:
                owner.append(_numbers(r["owners"], np.uint32))
                hashes.append(_numbers(r["hashes"], np.uint64))
                famous.append(_numbers(r["popular"], np.uint64))
        owner, hashes = np.concatenate(owner), np.concatenate(hashes)
        order = np.argsort(owner, kind="stable")
        owner, hashes = owner[order], hashes[order]
        present, starts = np.unique(owner, return_index=True)
        ends = np.append(starts[1:], len(owner))[: len(starts)]
        known = np.concatenate([[0], np.cumsum(np.isin(hashes, np.concatenate(famous)))])
        out = [(*keys[o], hashes[a:z].tobytes(), int(known[z] - known[a])) for o, a, z in zip(present.tolist(), starts.tolist(), ends.tolist(), strict=True)]
        return pa.Table.from_batches([batch_of(out, [pa.binary(), pa.int64(), pa.binary(), pa.int64()], ["owner", "n", "shared", "n_popular"])])

    return (
        owners.mapInArrow(tidy(send), _SENT)
        .groupBy("bucket").applyInArrow(tidy(answer), _ANSWER)
        .groupBy("chunk").applyInArrow(tidy(settle), "owner binary, n long, shared binary, n_popular long")
    )


def expected_units(docs: DataFrame, bytes_per_unit: float) -> int:
    """About how many hashes the texts will have, from their size."""
    size = docs.agg(F.sum(F.octet_length(docs["text"].cast("string")).cast("long")).alias("n")).collect()[0]["n"] or 0
    return int(size / bytes_per_unit)

"""Packing token sequences by minimum bin slack.

Documents are encoded, ended with an end token, and cut into pieces that fill sequences of ``capacity`` tokens.
Whole multiples of the capacity are sequences of their own. The remainders are packed window by window: the window
takes the longest remainder, a subset-sum bitset over the lengths still there finds the sum closest to the room left,
and the counts per length are traced back from the bitset. If no multiset fills the window, one more remainder is cut
to the slack, and what is cut off goes back to the lengths to be packed.

Scale: every task packs what it reads, a block of tokens at a time, and carries its last, unfilled window to its next
block; only one unfilled window per task is left, at most ``capacity`` tokens. Those meet in groups of 128 tasks and
are packed again. So texts are never shuffled, memory holds one block, and at most one sequence per 128 tasks is short.
"""

from __future__ import annotations

import os
import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from sys import getsizeof

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rolemart.llm.common import landed, text_of

#: What remembered chunks may take, and the longest chunk worth remembering: text without spaces is one chunk.
_MEMO_BYTES = 160 << 20
_MEMO_CHUNK = 64
_MEMO_SLOT = 104  # of the dictionary
_GROUP = 128
# Fixed value: the splitting of byte-level BPE files of this kind.
_PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class ChunkEncoder:
    """Ids of a byte-level BPE tokenizer file as packed unsigned 32-bit integers, remembered per chunk.

    A chunk is a run without spaces and the one space before it. The tokenizer's own splitting always starts anew
    there, so the ids of a text are those of its chunks. Chunks that are not remembered are encoded by tiktoken over the
    file's vocabulary, which takes a third of the time; texts with neighbouring spaces or with a special token's string
    are encoded whole by tokenizers.
    """

    def __init__(self, path: str) -> None:
        import json

        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the file writes each byte as a printable character: those that are printable as themselves, the rest from 256 on
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        written = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        ranks = {bytes(written[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        bpe = tiktoken.Encoding(path, pat_str=_PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
        self.encode = bpe.encode_ordinary
        self.memo: dict[str, bytes] = {}
        self.memo_bytes = 0

    def __call__(self, text: str) -> bytes:
        if "  " in text or any(s in text for s in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        memo = self.memo
        missing = set(rest).difference(memo)
        for chunk in missing:
            memo[chunk] = np.array(self.encode(f" {chunk}"), "<u4").tobytes()
        ids = np.array(self.encode(first), "<u4").tobytes() + b"".join(map(memo.__getitem__, rest))
        for chunk in missing:
            if len(chunk) > _MEMO_CHUNK:
                del memo[chunk]
            else:
                self.memo_bytes += getsizeof(chunk) + getsizeof(memo[chunk]) + _MEMO_SLOT
        if self.memo_bytes > _MEMO_BYTES:
            memo.clear()
            self.memo_bytes = 0
        return ids


_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker; later tasks of the worker find its memo filled."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def best_fill(counts: dict[int, int], room: int) -> tuple[dict[int, int], int]:
    """How many of each length to take so that their sum is as close to ``room`` as possible, and that sum.

    ``reach`` has bit s set if some multiset has the sum s. A length with count c enters as groups of 1, 2, 4, ...
    so that every number up to c is possible; the bitset before each group allows tracing the choice back.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x, c in counts.items() if c and x <= room), reverse=True):
        left, group = min(counts[length], room // length), 1
        while left:
            group = min(group, left)
            wider = (reach | reach << (length * group)) & mask
            if wider != reach:
                steps.append((length, group, reach))
                reach = wider
            left -= group
            group *= 2
        if reach >> room & 1:
            break
    best = total = reach.bit_length() - 1
    taken: dict[int, int] = defaultdict(int)
    for length, group, before in reversed(steps):
        if not before >> best & 1:
            taken[length] += group
            best -= length * group
    return dict(taken), total


class Packer:
    """Packs the pieces of one task. ``left`` holds the pieces of the window that is not full yet."""

    def __init__(self, capacity: int, first_sequence: int, with_ids: bool) -> None:
        self.capacity, self.sequence, self.with_ids = capacity, first_sequence, with_ids
        self.left: list[tuple] = []
        self.out: list[tuple] = []

    def _place(self, pieces: list[tuple]) -> None:
        at = 0
        for doc_id, start, ids, doc_tokens in pieces:
            row = (doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, self.sequence, at)
            self.out.append((*row, np.frombuffer(ids, "<u4").tolist()) if self.with_ids else row)
            at += len(ids) // 4
        self.sequence += 1

    def block(self, docs: list[tuple]) -> None:
        """docs: (doc_id, first token, ids as bytes, tokens of the whole document)."""
        size = 4 * self.capacity
        pools: dict[int, list[tuple]] = defaultdict(list)
        for doc_id, start, ids, total in self.left + docs:
            whole = len(ids) // size * size
            for at in range(0, whole, size):
                self._place([(doc_id, start + at // 4, ids[at : at + size], total)])
            if len(ids) > whole:
                pools[(len(ids) - whole) // 4].append((doc_id, start + whole // 4, ids[whole:], total))
        self.left = []
        counts = {length: len(pool) for length, pool in pools.items()}

        def take(length: int, n: int) -> list[tuple]:
            counts[length] -= n
            taken = [pools[length].pop() for _ in range(n)]
            if not counts[length]:
                del counts[length]
            return taken

        while counts:
            longest = max(counts)
            counts[longest] -= 1
            fill, total = best_fill(counts, self.capacity - longest)
            counts[longest] += 1
            fill[longest] = fill.get(longest, 0) + 1
            slack = self.capacity - longest - total
            to_cut = max((x for x, c in counts.items() if x > slack and c > fill.get(x, 0)), default=0) if slack else 0
            if slack and not to_cut:  # all that is left fits into one window and does not fill it
                self.left = [p for x, n in fill.items() for p in take(x, n)]
                break
            need = dict(fill)
            if slack:
                need[to_cut] = need.get(to_cut, 0) + 1
            for _ in range(min(counts[x] // n for x, n in need.items())):
                pieces = [p for x, n in fill.items() for p in take(x, n)]
                if slack:
                    doc_id, start, ids, tokens = take(to_cut, 1)[0]
                    pieces.append((doc_id, start, ids[: 4 * slack], tokens))
                    rest = to_cut - slack
                    pools[rest].append((doc_id, start + slack, ids[4 * slack :], tokens))
                    counts[rest] = counts.get(rest, 0) + 1
                self._place(pieces)

    def finish(self) -> None:
        if self.left:
            self._place(self.left)
            self.left = []


def _batches(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 20_000):
        columns = zip(*rows[at : at + 20_000], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 0, with_ids: bool = False,
         block_tokens: int = 2_000_000) -> DataFrame:
    """Pieces of all documents and their places in sequences of ``capacity`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids with ``with_ids``.
    ``tokenizer`` is the path of a byte-level BPE file, the same on all machines.

    A NULL or empty text has the end token alone. Rows with a repeated or NULL doc_id are packed like any other. An
    empty table gives no rows. Further columns are ignored. Texts of any length are cut, never shortened.
    """
    ids_type = [("ids", pa.list_(pa.uint32()))] if with_ids else []
    piece = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")] + [(n, pa.list_(pa.int64())) for n, _ in ids_type])
    ddl = _PIECES + (", ids array<long>" if with_ids else "")
    rest = pa.schema([("task", pa.int64()), ("rest", pa.binary())])
    end = np.array([end_id], "<u4").tobytes()

    def in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer, encode = Packer(capacity, task << 33, with_ids), encoder(tokenizer)
        schema = pa.schema([*piece, *rest])

        def rows() -> Iterator[pa.RecordBatch]:
            done, packer.out = [(*r, None, None) for r in packer.out], []
            return _batches(done, schema)

        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                held.append((doc_id, 0, ids, len(ids) // 4))
                size += len(ids) // 4
                if size >= block_tokens:
                    packer.block(held)
                    held, size = [], 0
                    yield from rows()
        packer.block(held)
        yield from rows()
        if packer.left:
            yield from _batches([(*[None] * len(piece), task, pickle.dumps(packer.left))], schema)

    def across_tasks(table: pa.Table) -> pa.Table:
        group = table.column("task")[0].as_py() // _GROUP
        packer = Packer(capacity, (1 << 62) + (group << 33), with_ids)
        table = table.sort_by("task")
        packer.block([p for b in table.column("rest").to_pylist() for p in pickle.loads(b)])
        packer.finish()
        return pa.Table.from_batches(_batches(packer.out, piece), schema=piece)

    read = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    packed = landed(read.mapInArrow(in_task, ddl + ", task long, rest binary"), "packed")
    open_windows = packed.where(F.col("task").isNotNull()).select("task", "rest")
    groups = open_windows.groupBy((F.col("task") / _GROUP).cast("long").alias("tasks"))
    return packed.where(F.col("task").isNull()).drop("task", "rest").unionByName(groups.applyInArrow(across_tasks, ddl))

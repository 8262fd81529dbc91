"""What several operators share: landing intermediate results, spare column names, words and their hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolemart.session import new_scratch

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def landed(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a result that is read more than once to the shared folder, and read it from there.

    Lineage ends here: a lost executor costs the tasks that ran on it, not the steps before.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have, so that extra columns of any name pass through."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(df: DataFrame, column: str = "text") -> Column:
    return F.coalesce(df[column].cast("string"), F.lit(""))


def bytes_of(df: DataFrame, column: str = "text") -> Column:
    return text_of(df, column).cast("binary")


def tidy(work: Callable) -> Callable:
    """The same Arrow function, which gives memory back when it ends: workers stay alive, and an idle one should hold little."""

    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    def table(data: pa.Table) -> pa.Table:
        try:
            return work(data)
        finally:
            give_back()

    def batches(data):
        try:
            yield from work(data)
        finally:
            give_back()

    return table if "table" in work.__code__.co_varnames[:1] else batches


def space_words(data: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return data.translate(_LOWER).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all bits; the shifts and the multiplier are free choices."""
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` words; a shorter sequence has none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = mixed(out) + words[k : k + n]
    return mixed(out)

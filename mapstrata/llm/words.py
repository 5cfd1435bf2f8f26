"""Words, word hashes and Arrow batches shared by the operators of this package.

A word is a run of ``[^\\x20\\x09-\\x0D]``. ``bytes.split`` cuts at exactly these characters, so texts
reach the tasks as UTF-8 bytes and are never decoded.
"""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WORD = r"[^\x20\x09-\x0D]+"
MOST_CACHED = 200_000


def give_back() -> None:
    """Return freed memory to the system, which long-lived workers otherwise keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def worker_state(name: str, build: Callable[[], object]) -> object:
    """What ``build`` makes, once per Python worker; tasks of one worker share it. The part of the name before a space is
    its family: a worker that turns to another family forgets the rest, so caches of one step do not weigh on the next."""
    state = sys.modules.setdefault("_mapstrata_worker", types.ModuleType("_mapstrata_worker"))
    if not hasattr(state, name):
        family = name.split(" ")[0]
        others = [x for x in vars(state) if not x.startswith("__") and x.split(" ")[0] != family]
        for other in others:
            delattr(state, other)
        if others:
            give_back()
        setattr(state, name, build())
    return getattr(state, name)


def split_words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


class _WordHashes(dict):
    """64-bit hashes of words; forgets all when it holds ``MOST_CACHED`` of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def word_hashes(words: list[bytes]) -> np.ndarray:
    cache = worker_state("words hashes", _WordHashes)
    return np.fromiter(map(cache.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over all positions (the public splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# An odd multiplier of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class Rolling:
    """Hashes of any runs of consecutive words of one document, from prefix sums modulo 2**64."""

    def __init__(self, hashes: np.ndarray) -> None:
        n = len(hashes)
        known = worker_state("words powers", lambda: {"up": _powers(BASE, 1), "down": _powers(INVERSE, 1)})
        if len(known["up"]) <= n:
            size = 1 << (n + 1).bit_length()
            known["up"], known["down"] = _powers(BASE, size), _powers(INVERSE, size)
        self.up = known["up"]
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * known["down"][:n], dtype=np.uint64, out=self.sums[1:])

    def runs(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Hashes of ``lengths`` words from ``starts`` on; equal for equal runs wherever they stand."""
        return mixed((self.sums[starts + lengths] - self.sums[starts]) * self.up[starts])

    def all(self, length: int) -> np.ndarray:
        """Hashes of every run of ``length`` words."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mixed((self.sums[length:] - self.sums[:n]) * self.up[:n])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def as_bytes(column: str) -> Column:
    return F.col(column).cast("binary").alias(column)


def map_rows(
    df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` with a generator per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole documents are larger rows than Spark's default batch of 10,000 is made for."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def word_count(column: str) -> Column:
    """Number of words of a text column; null counts 0."""

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(split_words(x)) for x in texts.to_pylist()], pa.int64())

    return count(F.col(column).cast("binary"))

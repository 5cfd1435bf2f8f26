"""Token ids as binary shards with a keyed index.

A data set is a folder with, per shard, ``<shard>.ids`` (the ids, raw, little-endian, of ascending doc_id)
and ``<shard>.idx`` (a minimal perfect hash over the document keys, and per slot a fingerprint, offset and
length), and a table ``keys`` of the documents of every finished shard, which Spark commits as a whole. A
task that is repeated writes shards of other names; files that ``keys`` does not name are leftovers.

Null texts have no ids but the end id. A null doc_id is a key like any other and comes first. Rows that repeat
a doc_id are told apart by their ordinal, in order of their texts. Other columns are not read. An empty table
gives an empty data set. A shard is closed at ``SHARD_BYTES`` or ``SHARD_ROWS``, so a task holds the index of one shard at most,
also of very short documents. Folders of object stores are opened by their own library, under the scheme that it knows.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapstrata.llm.perfect_hash import PerfectHash
from mapstrata.llm.tokens import encoder, vocabulary_dtype
from mapstrata.llm.words import give_back

SHARD_BYTES = 256 << 20
SHARD_ROWS = 1_000_000
# Schemes that Spark and the file library call differently.
SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}
KEYS = "doc_id long, ordinal long, hash long, fingerprint int, shard string, writer int, number int, shard_ids long"


def library_uri(folder: str) -> str:
    """The folder by the name that the file library has for its scheme."""
    for spark_name, name in SCHEMES.items():
        if folder.startswith(spark_name):
            return name + folder.removeprefix(spark_name)
    return folder


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    folder = library_uri(folder)
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


class _ShardWriter:
    """One shard: payload as it comes, index when it is closed."""

    def __init__(self, folder: str, writer: int, number: int, dtype: np.dtype) -> None:
        self.fs, root = _open(folder)
        self.name, self.writer, self.number, self.dtype = f"{writer:08d}-{number:04d}-{uuid.uuid4().hex}", writer, number, dtype
        self.path = f"{root}/{self.name}"
        self.out = self.fs.open_output_stream(f"{self.path}.ids")
        self.rows: list[tuple[int | None, int, int, int]] = []
        self.ends = [0]

    def add(self, row: tuple[int | None, int, int, int], ids: bytes) -> None:
        self.out.write(ids)
        self.rows.append(row)
        self.ends.append(self.ends[-1] + len(ids) // self.dtype.itemsize)

    def close(self) -> pa.RecordBatch:
        self.out.close()
        doc_ids, ordinals, hashes, prints = zip(*self.rows)
        keys = np.array(hashes, dtype=np.int64).view(np.uint64)
        table = PerfectHash.build(keys)
        slots, ends, n = table.slots(keys), np.array(self.ends, dtype=np.int64), len(self.rows)
        fingerprints, offsets, lengths = np.zeros(n, np.int32), np.zeros(n, np.int64), np.zeros(n, np.int64)
        fingerprints[slots], offsets[slots], lengths[slots] = prints, ends[:-1], np.diff(ends)
        buffer = io.BytesIO()
        np.savez(
            buffer,
            bits=np.packbits(table.bits),
            sizes=table.sizes,
            fingerprints=fingerprints,
            offsets=offsets,
            lengths=lengths,
            itemsize=np.array([self.dtype.itemsize]),
        )
        with self.fs.open_output_stream(f"{self.path}.idx") as out:
            out.write(buffer.getvalue())
        fill = lambda value, kind: pa.array([value] * n, kind)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, pa.int64()),
                pa.array(ordinals, pa.int64()),
                pa.array(hashes, pa.int64()),
                pa.array(prints, pa.int32()),
                fill(self.name, pa.string()),
                fill(self.writer, pa.int32()),
                fill(self.number, pa.int32()),
                fill(self.ends[-1], pa.int64()),
            ],
            ["doc_id", "ordinal", "hash", "fingerprint", "shard", "writer", "number", "shard_ids"],
        )


class ShardReader:
    """Keyed access to one shard: the index in memory, payloads read where it points."""

    def __init__(self, folder: str, shard: str) -> None:
        self.fs, root = _open(folder)
        with self.fs.open_input_file(f"{root}/{shard}.idx") as file:
            stored = np.load(io.BytesIO(file.read()))
        sizes = stored["sizes"]
        self.table = PerfectHash(np.unpackbits(stored["bits"], count=int(sizes.sum())).astype(bool), sizes)
        self.fingerprints, self.offsets, self.lengths = stored["fingerprints"], stored["offsets"], stored["lengths"]
        self.dtype = np.dtype(f"<u{int(stored['itemsize'][0])}")
        self.file = self.fs.open_input_file(f"{root}/{shard}.ids")

    def find(self, hashes: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """Slots of the keys; -1 for keys that the shard does not hold."""
        slots = self.table.slots(hashes.view(np.uint64))
        known = slots >= 0
        known[known] = self.fingerprints[slots[known]] == fingerprints[known]
        return np.where(known, slots, -1)

    def ids(self, slot: int) -> bytes:
        size = self.dtype.itemsize
        return self.file.read_at(int(self.lengths[slot]) * size, int(self.offsets[slot]) * size)


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int) -> None:
    """Encode ``docs`` (doc_id, text) and write the data set to ``folder``, a place that all executors share."""
    dtype = vocabulary_dtype(tokenizer_path)
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    # rows of one doc_id fall in one range; the session's shuffle partitions set the number of writers
    placed = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    placed = placed.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(tokenizer_path), np.dtype(dtype)
        end = np.array([end_id], kind).tobytes()
        me, number, shard = TaskContext.get().partitionId(), 0, None
        last, ordinal = object(), 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode.many(batch.column(1))):
                ordinal = ordinal + 1 if doc_id == last else 0
                last = doc_id
                if shard is None:
                    shard = _ShardWriter(folder, me, number, kind)
                shard.add((doc_id, ordinal, *key_of(doc_id, ordinal)), ids + end)
                if shard.ends[-1] * kind.itemsize >= SHARD_BYTES or len(shard.rows) >= SHARD_ROWS:
                    yield shard.close()
                    shard, number = None, number + 1
        if shard is not None:
            yield shard.close()
        give_back()

    placed.mapInArrow(write, KEYS).write.parquet(f"{folder}/keys")


def key_of(doc_id: int | None, ordinal: int) -> tuple[int, int]:
    """64-bit hash and 32-bit fingerprint of a document key, as signed numbers."""
    raw = f"{'' if doc_id is None else doc_id}/{ordinal}".encode()
    wide = np.array([xxhash.xxh3_64_intdigest(raw)], np.uint64).view(np.int64)
    return int(wide[0]), int(np.array([xxhash.xxh32_intdigest(raw)], np.uint32).view(np.int32)[0])


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, ordinal, start, n_tokens, ids) of every document, each found in its shard by key. ``start``
    counts the ids of all documents before it; ``ids`` are bytes of the stored type."""
    keys = spark.read.parquet(f"{folder}/keys")
    shards = keys.groupBy("shard", "writer", "number").agg(F.max("shard_ids").alias("n"))
    order = Window.orderBy("writer", "number").rowsBetween(Window.unboundedPreceding, -1)
    begins = shards.select("shard", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("begin"))
    placed = keys.select("doc_id", "ordinal", "hash", "fingerprint", "shard").join(begins, "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, ShardReader] = {}
        for batch in batches:
            names = np.array(batch.column("shard").to_pylist(), dtype=object)
            for name in dict.fromkeys(names):
                if name not in opened:
                    opened.clear()  # one index at a time
                    opened[name] = ShardReader(folder, name)
                shard = opened[name]
                own = batch.filter(pa.array(names == name))
                slots = shard.find(own.column("hash").to_numpy(), own.column("fingerprint").to_numpy())
                if (slots < 0).any():
                    raise KeyError(f"{name} lacks a document that its keys name")
                begin = own.column("begin").to_numpy()
                for at in range(0, len(slots), 1000):  # bounded batches of payload
                    part = slice(at, at + 1000)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.column("doc_id")[part],
                            own.column("ordinal")[part],
                            pa.array(begin[part] + shard.offsets[slots[part]]),
                            pa.array(shard.lengths[slots[part]]),
                            pa.array([shard.ids(s) for s in slots[part]], pa.binary()),
                        ],
                        ["doc_id", "ordinal", "start", "n_tokens", "ids"],
                    )

    return placed.mapInArrow(read, "doc_id long, ordinal long, start long, n_tokens long, ids binary")

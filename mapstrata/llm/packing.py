"""Harmonic packing of documents into sequences of at most ``capacity`` tokens.

Documents are cut: first whole sequences, then the rest into pieces of capacity / 2, capacity / 4, ... down to
``smallest`` tokens, and a tail below that. A piece of more than capacity / (i + 1) and at most capacity / i
tokens is of class i, and i pieces of a class fill a sequence; the cut pieces fill theirs without a gap. Every
worker fills sequences on its own. What remains of a class in a partition, less than one sequence, is packed
again together with what ``FAN_IN`` partitions have left, until one group remains; there the pieces of all
classes share sequences, longest first. A remainder thus never exceeds one sequence per class and group.

A null or empty text is the end id alone. Repeated rows are packed each for itself. An empty table gives no
piece. Other columns are not read. Memory: one Arrow batch and less than one sequence per class.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.tokens import encoder, vocabulary_dtype
from mapstrata.llm.words import give_back
from mapstrata.session import cut_lineage

CAPACITY, SMALLEST, FAN_IN = 2048, 64, 64
NAMES = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

Piece = tuple[int | None, int, int, int, bytes]  # doc_id, start, length, doc_tokens, ids


def cuts(n: int, capacity: int = CAPACITY, smallest: int = SMALLEST) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens."""
    out = [capacity] * (n // capacity)
    n %= capacity
    size = capacity // 2
    while size >= smallest:
        if n >= size:
            out.append(size)
            n -= size
        size //= 2
    return out + [n] * (n > 0)


class _Classes:
    """Open sequences by class; full ones are handed out with an id of their own."""

    def __init__(self, capacity: int, first_id: int) -> None:
        self.capacity, self.next_id = capacity, first_id
        self.open: dict[int, list[Piece]] = {}

    def add(self, piece: Piece) -> list[tuple]:
        each = self.capacity // piece[2]
        mates = self.open.setdefault(each, [])
        mates.append(piece)
        if len(mates) < each:
            return []
        del self.open[each]
        return self.sequence(mates)

    def sequence(self, pieces: list[Piece]) -> list[tuple]:
        out, at = [], 0
        for doc_id, start, length, tokens, ids in pieces:
            out.append((doc_id, start, length, tokens, self.next_id, at, ids))
            at += length
        self.next_id += 1
        return out

    def left(self) -> list[tuple]:
        return [(*p[:4], None, None, p[4]) for _, mates in sorted(self.open.items()) for p in mates]

    def close(self) -> list[tuple]:
        """All that is left, longest first, each piece in the fullest sequence that has room for it."""
        room: dict[int, list[list[Piece]]] = {}
        for piece in sorted((p for mates in self.open.values() for p in mates), key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1])):
            fits = min((r for r, some in room.items() if r >= piece[2] and some), default=None)
            mates = room[fits].pop() if fits is not None else []
            free = (self.capacity if fits is None else fits) - piece[2]
            room.setdefault(free, []).append([*mates, piece])
        self.open.clear()
        return [row for free in sorted(room) for mates in room[free] for row in self.sequence(mates)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], NAMES)


def _with_group(batch: pa.RecordBatch, group: int) -> pa.RecordBatch:
    return batch.append_column("group", pa.array([group] * len(batch), pa.int64()))


def _packing_again(level: int, last: bool, capacity: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Packs what the partitions of one group have left; the last round leaves nothing."""

    def again(key: tuple, table: pa.Table) -> pa.Table:
        group = key[0].as_py()
        classes, rows = _Classes(capacity, _first_id(level, group)), []
        pieces = zip(*(table.column(c).to_pylist() for c in ("doc_id", "start", "length", "doc_tokens", "ids")))
        for piece in sorted(pieces, key=lambda p: (-p[2], p[0] is None, p[0] or 0, p[1], p[4])):
            rows += classes.add(piece)
        rows += classes.close() if last else classes.left()
        packed = pa.Table.from_batches([_with_group(_batch(rows), group)])
        del pieces, rows
        give_back()
        return packed

    return again


def _first_id(level: int, group: int) -> int:
    # 16 million sequences for each of 4 billion groups on each level
    return level << 56 | group << 24


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = CAPACITY, smallest: int = SMALLEST
) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids) per piece; ``ids`` are bytes of the type
    that ``vocabulary_dtype`` names. Each round is written before the next one reads it."""
    dtype = vocabulary_dtype(tokenizer_path)
    source = docs.select("doc_id", "text")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, size = encoder(tokenizer_path), np.dtype(dtype).itemsize
        end = np.array([end_id], dtype).tobytes()
        group = TaskContext.get().partitionId()
        classes, rows, held = _Classes(capacity, _first_id(0, group)), [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode.many(batch.column(1))):
                ids += end
                total, start = len(ids) // size, 0
                for length in cuts(total, capacity, smallest):
                    rows += classes.add((doc_id, start, length, total, ids[start * size : (start + length) * size]))
                    start += length
                held += len(ids)
                if held > 4 << 20:
                    if rows:
                        yield _with_group(_batch(rows), group)
                    rows, held = [], 0
        rows += classes.left()
        if rows:
            yield _with_group(_batch(rows), group)
        give_back()

    done = cut_lineage(source.mapInArrow(first, PIECES + ", group long"))
    out = [done.where("sequence_id is not null").drop("group")]
    left = done.where("sequence_id is null")
    groups, level = (left.agg(F.max("group")).first()[0] or 0) + 1, 0
    while True:
        level += 1
        last = groups <= FAN_IN
        merged = left.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("long"))
        done = merged.groupBy("group").applyInArrow(_packing_again(level, last, capacity), PIECES + ", group long")
        if last:
            out.append(done.drop("group"))
            break
        done = cut_lineage(done)
        out.append(done.where("sequence_id is not null").drop("group"))
        left, groups = done.where("sequence_id is null"), math.ceil(groups / FAN_IN)
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result

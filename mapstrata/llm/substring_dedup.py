"""Repeated word spans by compaction of a sparse de Bruijn graph.

Nodes are the anchors of documents: word k-mers with the smallest hash of some window, so every window of
``window`` words holds at least one and equal windows hold equal ones. The words from one anchor to the next are an
edge. Where all occurrences of a node go on alike on both sides the path does not branch, and every document
that holds one of its nodes holds all of it; Spark joins bring the nodes' counts back to their documents, where
such paths compact to one span. Windows that lie in a compacted span are settled by its nodes. Windows across a
branch are compared by hash, with the document and position they come from.

A window is removed if its words also start in a document with a smaller doc_id. Null and empty texts have no
words. Rows without doc_id keep their words and count as no earlier document. Rows that repeat a doc_id do
not remove words of each other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.storage import release
from mapstrata.llm.words import Rolling, as_bytes, map_rows, mixed, signed, split_words, word_hashes
from mapstrata.session import cut_lineage

WINDOW, NODE_WORDS = 50, 12


def sliding(a: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every run of ``width`` values, in log(width) passes."""
    n, done = len(a) - width + 1, 1
    if n <= 0:
        return a[:0]
    while done * 2 <= width:
        a = pick(a[:-done], a[done:])
        done *= 2
    return pick(a[:n], a[width - done : width - done + n])


class Anchored:
    """Anchors of one document: their positions, hashes and edges, and each window's own anchor."""

    def __init__(self, text: bytes | None, window: int, node_words: int) -> None:
        self.words = split_words(text)
        self.rolling = Rolling(word_hashes(self.words))
        self.window, self.node_words = window, node_words
        span = window - node_words + 1  # k-mers in a window
        nodes = self.rolling.all(node_words)
        self.least = sliding(nodes, span, np.minimum)
        if len(self.least):
            pad = np.zeros(span - 1, dtype=np.uint64)
            self.at = np.flatnonzero(sliding(np.concatenate([pad, self.least, pad]), span, np.maximum) == nodes)
        else:
            self.at = np.zeros(0, dtype=np.int64)
        self.hashes = nodes[self.at]

    def nodes(self, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, and hashes of what follows and of what precedes them: 0 where the document ends, and a
        number that no other document has where the document itself goes on in several ways."""
        after = np.zeros(len(self.at), dtype=np.uint64)
        before = np.zeros(len(self.at), dtype=np.uint64)
        if len(self.at) > 1:
            after[:-1] = before[1:] = self.rolling.runs(self.at[:-1], np.diff(self.at) + self.node_words)
        order = np.argsort(self.hashes, kind="stable")
        distinct, first = np.unique(self.hashes[order], return_index=True)
        own = mixed(distinct + np.uint64(salt % (1 << 64)))
        sides = []
        for side in (after[order], before[order]):
            low = np.minimum.reduceat(side, first) if len(first) else side
            high = np.maximum.reduceat(side, first) if len(first) else side
            sides.append(np.where(low == high, low, own))
        return distinct, *sides


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(signed(values) if values.dtype == np.uint64 else values.astype(np.int64))


def _occurrences(docs: DataFrame, window: int, node_words: int) -> DataFrame:
    """(node, doc_id, text_key, after, before), a row per distinct anchor of a document."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, ids, keys = (batch.column(i).to_pylist() for i in range(3))
        found: list[list[np.ndarray]] = []
        for text, doc_id, key in zip(texts, ids, keys):
            doc = Anchored(text, window, node_words)
            if len(doc.at):
                node, after, before = doc.nodes(doc_id * 0x9E3779B97F4A7C15 + key)
                found.append([node, np.full(len(node), doc_id), np.full(len(node), key), after, before])
        if found:
            yield pa.RecordBatch.from_arrays(
                [_long(np.concatenate(c)) for c in zip(*found)], ["node", "doc_id", "text_key", "after", "before"]
            )

    return map_rows(
        docs.where("doc_id is not null").select(as_bytes("text"), "doc_id", "text_key"),
        rows,
        "node long, doc_id long, text_key long, after long, before long",
    )


def _spans_and_windows(marked: DataFrame, window: int, node_words: int) -> DataFrame:
    """Per document with shared anchors: spans to remove that compacted paths settle, and the windows (position,
    hash) that no path settles."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for text, doc_id, key, nodes in zip(*(c.to_pylist() for c in batch.columns)):
            doc = Anchored(text, window, node_words)
            known = sorted((x["node"], x["first_doc"] < doc_id, x["one_after"], x["one_before"]) for x in nodes)
            known_nodes = np.array([x[0] for x in known], dtype=np.int64)
            at = np.searchsorted(known_nodes, signed(doc.hashes)).clip(max=len(known) - 1)
            shared = known_nodes[at] == signed(doc.hashes)
            earlier, one_after, one_before = (np.array([x[i] for x in known])[at] & shared for i in (1, 2, 3))
            joined = shared[:-1] & shared[1:] & one_after[:-1] & one_before[1:]
            starts = np.flatnonzero(shared & ~np.concatenate([[False], joined]))
            ends = np.flatnonzero(shared & ~np.concatenate([joined, [False]]))
            begin, end = doc.at[starts], doc.at[ends] + node_words
            long = end - begin >= window
            begin, end, gone = begin[long], end[long], earlier[starts[long]]
            # a window is settled if one path holds all of it
            total = len(doc.least)
            steps = np.zeros(total + 1, dtype=np.int64)
            np.add.at(steps, begin, 1)
            np.add.at(steps, end - window + 1, -1)
            settled = np.cumsum(steps[:-1]) > 0
            open_ = np.flatnonzero(~settled & np.isin(doc.least, doc.hashes[shared]))
            out.append(
                (doc_id, key, begin[gone].tolist(), end[gone].tolist(), open_.tolist(), signed(doc.rolling.runs(open_, window)).tolist())
            )
        if out:
            kinds = [pa.int64(), pa.int64()] + [pa.list_(pa.int64())] * 4
            names = ["doc_id", "text_key", "span_begins", "span_ends", "window_at", "window_hash"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return map_rows(
        marked.select(as_bytes("text"), "doc_id", "text_key", "nodes"),
        rows,
        "doc_id long, text_key long, span_begins array<long>, span_ends array<long>, window_at array<long>, window_hash array<long>",
    )


def _kept(found: DataFrame, window: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n_words, n_removed, kept = [], [], []
        columns = [batch.column(c).to_pylist() for c in ("text", "span_begins", "span_ends", "window_at", "window_hash", "gone_hash")]
        for text, begins, ends, windows, hashes, gone in zip(*columns):
            words = split_words(text)
            removed = 0
            if begins or gone:
                steps = np.zeros(len(words) + 1, dtype=np.int64)
                at = np.array(windows or [], dtype=np.int64)
                at = at[np.isin(np.array(hashes or [], dtype=np.int64), np.array(gone or [], dtype=np.int64))]
                np.add.at(steps, np.concatenate([np.array(begins or [], np.int64), at]), 1)
                np.add.at(steps, np.concatenate([np.array(ends or [], np.int64), at + window]), -1)
                covered = np.cumsum(steps[:-1]) > 0
                removed = int(covered.sum())
                words = [w for w, out in zip(words, covered) if not out]
            n_words.append(len(words) + removed)
            n_removed.append(removed)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_words", "n_removed", "kept"],
        )

    out = map_rows(
        found.select(as_bytes("text"), "doc_id", "span_begins", "span_ends", "window_at", "window_hash", "gone_hash"),
        rows,
        "doc_id long, n_words long, n_removed long, kept binary",
    )
    return out.withColumn("kept", F.col("kept").cast("string"))


def _shared_parts(keyed: DataFrame, window: int, node_words: int) -> DataFrame:
    """What ``_spans_and_windows`` finds, for the documents that share an anchor with another one."""
    seen = _occurrences(keyed, window, node_words)
    nodes = (
        seen.groupBy("node")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            (F.min("after") == F.max("after")).alias("one_after"),
            (F.min("before") == F.max("before")).alias("one_before"),
        )
        .where("first_doc < last_doc")
        .drop("last_doc")
    )
    lists = (
        seen.select("node", "doc_id", "text_key")
        .join(nodes, "node")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("node", "first_doc", "one_after", "one_before")).alias("nodes"))
    )
    marked = keyed.join(lists, ["doc_id", "text_key"])
    return cut_lineage(_spans_and_windows(marked, window, node_words))


def _removals(found: DataFrame) -> DataFrame:
    """Rows of ``found`` of the documents that lose words, with ``gone_hash``, the hashes of windows that go."""
    # a window that a document holds many times is one row of it
    windows = found.select("doc_id", "text_key", F.explode(F.array_distinct("window_hash")).alias("hash"))
    first = windows.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    repeated = (
        windows.join(first.where("first_doc < last_doc").drop("last_doc"), "hash")
        .where("first_doc < doc_id")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set("hash").alias("gone_hash"))
    )
    once = found.dropDuplicates(["doc_id", "text_key"]).join(repeated, ["doc_id", "text_key"], "left")
    once = once.where((F.size("span_begins") > 0) | F.col("gone_hash").isNotNull())
    # positions are needed only where some of their windows go
    for name in ("window_at", "window_hash"):
        once = once.withColumn(name, F.when(F.col("gone_hash").isNotNull(), F.col(name)))
    return cut_lineage(once)


def remove_repeats(docs: DataFrame, window: int = WINDOW, node_words: int = NODE_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs``; kept words are joined by one space."""
    # the text's hash tells rows of one doc_id apart
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    found = _shared_parts(keyed, window, node_words)
    release(docs.sparkSession)
    removals = _removals(found)
    del found
    release(docs.sparkSession)
    return _kept(keyed.join(removals, ["doc_id", "text_key"], "left"), window)

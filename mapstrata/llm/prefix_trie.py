"""Prefix trie of conversations, kept as a z-fast trie.

A path is what a conversation says turn by turn: 128-bit hashes of its first 1, 2, ... n turns. Only compacted nodes are
stored: the places where a path ends or paths part, each with the edge of turns that leads to it. The dictionary holds a
node under its handle, the prefix of its edge's 2-fattest depth (the one divisible by the largest power of two).

Paths are inserted in batches. A batch is located in the trie by fat binary search, in as many joins as the depth has bits
whatever the number of nodes passed, and a last one by the first turn of the edge that is left inside. Edges are split
where paths leave them or end in them, and only turns beyond these exits are grouped to form new nodes. Sums over subtrees
go up by pointer doubling, so they take as many rounds as the number of levels has bits. At the end edges are expanded to
one row per turn.

Equal paths are counted together before they are inserted. Joins that many paths or children share a key of go through
``joined_with_few``: broadcast when small, else salted. The ids of conversations that end at one node are sorted over all
tasks and hashed from chunks of ``CHUNK`` ids, so that none gathers them. Rows without an id belong to no conversation. Turns are taken
in the order of ``turn`` (null first), then of role and of the hash of the text; null role or text is empty; repeated rows are
repeated turns. An empty table has no nodes. Nodes are told apart by 128-bit hashes. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.words import as_bytes, map_rows, split_words
from mapstrata.operators.joins import joined_with_few
from mapstrata.session import cut_lineage

ROOT = b"\0" * 16
# One path in so many is in the first batch; the others follow when these are in the trie.
FIRST_BATCH = 16
CHUNK = 10_000

# Fixed values of the rebuilding: conversations to a family, and the divisor that tells how many turns are shared.
FAMILY, SHARED = 20, 4


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, ``said`` (hash of role and text) and the words of the text, for each row with an id."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        roles, texts = (batch.column(n).fill_null(b"").to_pylist() for n in (2, 3))
        said = [xxhash.xxh3_128_digest(len(r).to_bytes(8, "big") + r + t) for r, t in zip(roles, texts)]
        words = [len(split_words(t)) for t in texts]
        arrays = [batch.column(0), batch.column(1), pa.array(roles, pa.binary()), pa.array(said, pa.binary()), pa.array(words, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "turn", "role", "said", "words"])

    known = conversations.where(F.col("conv_id").isNotNull())
    wanted = known.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), as_bytes("role"), as_bytes("text"))
    return map_rows(wanted, rows, "conv_id long, turn long, role binary, said binary, words long")


def path_of(turns: list[tuple[bytes, int]]) -> tuple[list[bytes], list[int]]:
    """Hash and words of the first 1, 2, ... turns."""
    keys, words, key, total = [], [], ROOT, 0
    for said, count in turns:
        key = xxhash.xxh3_128_digest(key + said)
        total += count
        keys.append(key)
        words.append(total)
    return keys, words


def shared_turns(conv_id: int) -> int:
    return zlib.crc32(str(conv_id).encode()) % SHARED


def _paths(ordered: DataFrame, rebuild: bool) -> DataFrame:
    """Paths of turns that arrive family by family, each beginning with its first conversation, from any number of batches."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, list[bytes], list[int]]] = []
        current = family = None
        turns: list[tuple[bytes, int]] = []
        opening: list[tuple[bytes, int]] = []

        def close() -> None:
            nonlocal opening
            if rebuild and current == family:
                opening = turns[: SHARED - 1]
            h = shared_turns(current) if rebuild else 0
            done.append((current, *path_of((opening[:h] if h else []) + turns[h:])))

        def flush() -> pa.RecordBatch:
            ids, keys, words = zip(*done)
            done.clear()
            arrays = [pa.array(ids, pa.int64()), pa.array(keys, pa.list_(pa.binary())), pa.array(words, pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "keys", "words"])

        for batch in batches:
            for conv_id, base, said, words in zip(*(batch.column(n).to_pylist() for n in range(4))):
                if conv_id != current:
                    if current is not None:
                        close()
                    if base != family:
                        family, opening = base, []
                    current, turns = conv_id, []
                turns.append((said, words))
            if done:
                yield flush()
        if current is not None:
            close()
            yield flush()

    return ordered.mapInArrow(rows, "conv_id long, keys array<binary>, words array<bigint>")


def conversation_paths(conversations: DataFrame, rebuild: bool = False) -> DataFrame:
    """conv_id, ``keys`` and ``words`` (hash and words of its first turns) of every conversation. With ``rebuild`` the first
    turns are those of the conversation whose id is the multiple of ``FAMILY`` at or below its own, as many as
    ``shared_turns`` says and that one has, and its own go on after that many."""
    base = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(FAMILY))
    turns = hashed_turns(conversations).withColumn("family", base)
    ordered = turns.repartition("family").sortWithinPartitions(
        "family", "conv_id", F.col("turn").asc_nulls_first(), "role", "said"
    )
    return _paths(ordered.select("conv_id", "family", "said", "words"), rebuild)


# The trie


def fattest(a: str, b: str) -> Column:
    """The number in (a, b] that the largest power of two divides."""
    return F.expr(f"{b} & shiftleft(-1, length(bin({a} ^ {b})) - 1)")


def _root_id() -> Column:
    return F.lit(bytearray(ROOT))


def _handled(nodes: DataFrame) -> DataFrame:
    """Nodes with the depth and prefix of their handles, and the prefix that names them: their edge's first turn."""
    deep = F.when(F.col("start") < F.col("ext"), fattest("start", "ext"))
    return nodes.withColumn("deep", deep).withColumns(
        {"handle": F.expr("get(edge, deep - start - 1).key"), "name": F.expr("get(edge, 0).key")}
    )


def _located(paths: DataFrame, nodes: DataFrame, longest: int) -> DataFrame:
    """Paths with the node they leave the trie in (``exit``, null where that is exactly at a node) and the depth ``at`` of it."""
    count, turns = nodes.agg(F.count(F.lit(1)), F.sum(F.size("edge"))).first()
    handles = nodes.where("deep IS NOT NULL").select(
        F.col("deep").alias("f"), F.col("handle").alias("probe"), F.col("id").alias("found"),
        F.col("start").alias("found_start"), F.col("ext").alias("found_ext"),
    )
    spread = [F.col("id")]
    at = paths.withColumns({"a": F.lit(0), "b": F.col("n")})
    for _ in range(longest.bit_length()):
        at = at.withColumn("f", F.when(F.col("a") < F.col("b"), fattest("a", "b")))
        at = at.withColumn("probe", F.expr("get(keys, f - 1)"))
        at = joined_with_few(at, handles, ["f", "probe"], spread, "left", size=count * 100)
        passes = "found_ext <= n AND get(keys, found_ext - 1) = found"
        low = f"CASE WHEN found IS NULL THEN a WHEN {passes} THEN found_ext ELSE found_start END"
        high = f"CASE WHEN f IS NULL THEN b WHEN found IS NULL THEN f - 1 WHEN {passes} THEN b ELSE found_start END"
        at = at.select(*paths.columns, F.expr(low).alias("a"), F.expr(high).alias("b"))
    names = nodes.where("name IS NOT NULL").select("name", F.col("id").alias("exit"), F.col("ext").alias("exit_ext"), F.col("edge"))
    at = at.withColumn("name", F.expr("get(keys, a)"))
    at = joined_with_few(at, names, ["name"], spread, "left", size=count * 100 + (turns or 0) * 60)
    shared = F.expr("size(filter(sequence(1, least(exit_ext, n) - a), i -> keys[a + i - 1] = edge[i - 1].key))")
    depth = F.when(F.col("exit").isNull(), F.col("a")).otherwise(F.col("a") + shared)
    return at.withColumn("at", depth).select(
        *paths.columns, "at", F.when(F.col("at") < F.col("exit_ext"), F.col("exit")).alias("exit")
    )


def _split(nodes: DataFrame, located: DataFrame) -> DataFrame:
    """Nodes whose edges are cut where paths leave them or end in them. Cuts of an edge are at most as many as its turns."""
    cuts = located.where("exit IS NOT NULL").groupBy(F.col("exit").alias("id")).agg(F.collect_set("at").alias("cuts"))
    ends = F.array_sort(F.concat(F.coalesce("cuts", F.array().cast("array<int>")), F.array("ext")))
    pieces = nodes.join(cuts, "id", "left").withColumn("ends", ends).select("*", F.posexplode("ends").alias("i", "end"))
    begin = pieces.withColumn("begin", F.expr("if(i = 0, start, ends[i - 1])"))
    last = F.expr("if(ext = start, id, get(edge, end - start - 1).key)")
    return begin.select(
        last.alias("id"),
        F.col("begin").alias("start"),
        F.col("end").alias("ext"),
        F.expr("if(i = 0, parent, get(edge, begin - start - 1).key)").alias("parent"),
        F.expr("if(i = 0, before, get(edge, begin - start - 1).words)").alias("before"),
        F.expr("slice(edge, begin - start + 1, end - begin)").alias("edge"),
    )


def _grown(located: DataFrame) -> DataFrame:
    """Nodes of the turns beyond the exits. Paths that share such turns are combined before the shuffle; a prefix is a node
    where a path ends or the next turns differ, and belongs to the smallest path through it."""
    at = located.where("at < n").select("id", "n", "keys", "words", F.explode(F.expr("sequence(at + 1, n)")).alias("depth"))
    turns = at.select(
        F.expr("keys[depth - 1]").alias("key"), "depth", "id",
        F.expr("get(keys, depth)").alias("next"), (F.col("depth") == F.col("n")).alias("last"),
        F.coalesce(F.expr("get(keys, depth - 2)"), _root_id()).alias("parent"),
        F.expr("words[depth - 1]").alias("words"), F.coalesce(F.expr("get(words, depth - 2)"), F.lit(0)).alias("before"),
    )
    prefixes = turns.groupBy("key", "depth", "parent", "words", "before").agg(
        F.min("id").alias("id"),
        (F.bool_or("last") | (F.min("next") != F.max("next"))).alias("node"),
    )
    listed = F.array_sort(F.collect_list(F.struct("depth", "key", "words", "parent", "before", "node")))
    path = prefixes.groupBy("id").agg(listed.alias("path")).withColumn("first", F.expr("path[0].depth"))
    ends = path.withColumn("ends", F.expr("transform(filter(path, p -> p.node), p -> p.depth)"))
    pieces = ends.select("path", "first", "ends", F.posexplode("ends").alias("i", "ext"))
    begun = pieces.withColumn("start", F.expr("if(i = 0, first - 1, ends[i - 1])"))
    return begun.select(
        F.expr("path[ext - first].key").alias("id"),
        "start",
        "ext",
        F.expr("path[start - first + 1].parent").alias("parent"),
        F.expr("path[start - first + 1].before").alias("before"),
        F.expr("transform(slice(path, start - first + 2, ext - start), p -> struct(p.key AS key, p.words AS words))").alias("edge"),
    )


NODE = "id binary, start int, ext int, parent binary, before bigint, edge array<struct<key:binary,words:bigint>>"


def z_fast_trie(paths: DataFrame) -> DataFrame:
    """Compacted nodes of distinct paths (``id``, ``n``, ``keys``, ``words``; id is the last key): ``id``, the depths ``start``
    to ``ext`` of the edge, the ``parent``, the words ``before`` the edge, the ``edge``, and its handle."""
    nodes = _handled(paths.sparkSession.createDataFrame([(ROOT, 0, 0, None, 0, [])], NODE))
    longest = paths.agg(F.max("n")).first()[0] or 0
    first = F.pmod(F.xxhash64("id"), F.lit(FIRST_BATCH)) == 0
    for batch in (paths.where(first), paths.where(~first)) if longest else ():
        located = cut_lineage(_located(batch.where("n > 0"), nodes, longest))
        nodes = cut_lineage(_handled(_split(nodes, located).unionByName(_grown(located))))
    return nodes


# Sums over subtrees


def _with_subtrees(nodes: DataFrame) -> DataFrame:
    """Adds up the columns of ``SUMS`` and takes the smallest ``conv_id`` over each subtree: after round k a node has what is
    fewer than 2**k levels below, and points 2**k levels up."""
    at = cut_lineage(nodes.withColumn("up", F.col("parent")))
    while at.where("up IS NOT NULL").limit(1).count():
        below = at.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            *[F.sum(c).alias(f"more_{c}") for c in SUMS], F.min("conv_id").alias("more_conv_id")
        )
        added = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in SUMS}
        added["conv_id"] = F.least("conv_id", "more_conv_id")
        reached = F.col("more_conv_id").isNotNull() | F.col("more_paths").isNotNull()
        at = at.join(below, "id", "left").withColumn("reached", reached).withColumns(added)
        at = cut_lineage(at.drop(*[f"more_{c}" for c in SUMS], "more_conv_id"))
        further = at.where("reached AND up IS NOT NULL").select(F.col("id").alias("up"), F.col("up").alias("further"))
        size = 80 * at.where("reached AND up IS NOT NULL").count()
        moved = joined_with_few(at.drop("reached"), further, ["up"], [F.col("id")], "left", size=size)
        at = cut_lineage(moved.withColumn("up", F.col("further")).drop("further"))
    return at.drop("up")


SUMS = ["n_convs", "n_leaves", "said", "held", "paths"]


def ends_hashed(ends: DataFrame) -> DataFrame:
    """``id`` and ``ends_sha256`` of the decimal ``conv_id`` that end at each node, in ascending order, joined by commas.
    Ids are sorted over all tasks, each writes its part of a node's list in chunks, and the chunks are hashed in order."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, int, bytes]] = []
        node, first, held = None, 0, []
        for batch in batches:
            for key, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != node or len(held) >= CHUNK:
                    if held:
                        out.append((node, first, ",".join(held).encode()))
                    node, first, held = key, conv_id, []
                held.append(str(conv_id))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["id", "first", "part"])
                out = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (node, first, ",".join(held).encode())], ["id", "first", "part"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, out = None, None, []
        for batch in batches:
            for key, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == node:
                    state.update(b"," + part)
                    continue
                if node is not None:
                    out.append((node, state.hexdigest()))
                node, state = key, hashlib.sha256(part)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["id", "ends_sha256"])
                out = []
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["id", "ends_sha256"])

    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = ends.select("id", "conv_id").repartitionByRange(parts, "id", "conv_id").sortWithinPartitions("id", "conv_id")
    pieces = spread.mapInArrow(chunks, "id binary, first long, part binary")
    ordered = pieces.repartition("id").sortWithinPartitions("id", "first").select("id", "part")
    return ordered.mapInArrow(hashes, "id binary, ends_sha256 string")


def trie_nodes(paths: DataFrame) -> DataFrame:
    """One row per node of the expanded trie of ``conversation_paths``: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (summed over the subtree) and ends_sha256."""
    last = F.coalesce(F.get("keys", F.size("keys") - 1), _root_id())
    paths = cut_lineage(paths.withColumn("id", last).withColumn("n", F.size("keys")))
    distinct = cut_lineage(
        paths.groupBy("id", "n").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"), F.first("words").alias("words")
        )
    )
    nodes = z_fast_trie(distinct.select("id", "n", "keys", "words"))
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("n_children"))
    total = F.coalesce(F.get("words", F.col("n") - 1), F.lit(0))
    ended = distinct.select("id", "conv_id", "copies", (total * F.col("copies")).alias("spoken"))
    own = nodes.select("id", "start", "ext", "parent", "before", "edge").join(ended, "id", "left").join(children, "id", "left")
    edge_words = F.coalesce(F.expr("get(edge, size(edge) - 1).words") - F.col("before"), F.lit(0))
    counted = own.withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)),
            "n_convs": F.coalesce("copies", F.lit(0)),
            "n_leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long"),
            "said": F.coalesce("spoken", F.lit(0)),
            "held": edge_words,
            "paths": F.lit(1).cast("long"),
        }
    ).drop("copies", "spoken")
    tree = _with_subtrees(counted)
    parents = tree.where("n_children > 0").select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    tree = joined_with_few(tree, parents, ["parent"], [F.col("id")], "left", size=80 * parents.count())
    tree = tree.join(ends_hashed(paths), "id", "left")
    nobody = hashlib.sha256(b"").hexdigest()
    steps = F.when(F.size("edge") == 0, F.expr("array(named_struct('key', id, 'words', 0L))")).otherwise(F.col("edge"))
    rows = tree.where("n_convs > 0").select("*", F.posexplode(steps).alias("i", "step"))
    at_end = F.col("i") >= F.size("edge") - 1
    earlier = F.when(F.col("i") == 0, F.col("before")).otherwise(F.expr("get(edge, i - 1).words"))
    saved = F.col("said") - F.col("n_convs") * F.col("earlier") - F.col("held") + F.col("earlier") - F.col("before")
    return rows.withColumn("earlier", earlier).select(
        "conv_id",
        F.when(F.size("edge") == 0, 0).otherwise(F.col("start") + F.col("i") + 1).cast("long").alias("depth"),
        F.when(F.col("i") == 0, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        F.col("n_convs").cast("long").alias("n_convs"),
        F.when(at_end, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        F.col("n_leaves").cast("long").alias("n_leaves"),
        saved.cast("long").alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends_sha256", F.lit(nobody))).otherwise(F.lit(nobody)).alias("ends_sha256"),
    )

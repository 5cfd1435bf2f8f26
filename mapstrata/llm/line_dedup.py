"""Line dedup by pairwise alignment.

Documents that share a line are aligned with patience diff, and the common blocks are deleted from the later
one (larger doc_id), whatever the number of documents that hold the line. Lines in at most ``RARE`` documents pair all of
them. Lines in more are common. They pair each holder with their first one, which settles most; what stays is settled by
views. The view of a document is its common lines, in order, with a mark for every run of others between them. Two
documents that share common lines only align as their views do, so each two views are aligned once, if they share a
run of lines long enough for a block, and only for lines not yet deleted. What two views have in common leaves a
document if an earlier one has the other view and shares no rarer line with it, as such pairs were aligned in full.

Lines are the parts between ``\\n``; lines without a word take no part. A block of fewer than ``least_words`` words
stays. Null and empty texts stay as they are. Rows without doc_id come last. Rows that repeat a doc_id are ordered
by a hash of their texts; rows that also repeat the text are one document and share its fate, as a row is
compared with other documents only. Columns other than doc_id and text pass through.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.llm.carried import set_aside
from mapstrata.llm.words import as_bytes, map_rows
from mapstrata.session import cut_lineage

RARE, LEAST_WORDS = 16, 5
LAST = (1 << 63) - 1
OTHER = -1  # in a view: lines that are not common
DOC = "struct<place:long,text_key:long>"


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned positions of two sequences by patience diff, in order."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        at_b = {b[j]: j for j in range(b0, b1) if in_b[b[j]] == 1}
        unique = [(i, at_b[a[i]]) for i in range(a0, a1) if in_a[a[i]] == 1 and a[i] in at_b]
        anchors = _increasing(unique)
        if not anchors:
            continue
        i0, j0 = a0, b0
        for i, j in anchors:
            out.append((i, j))
            todo.append((i0, i, j0, j))
            i0, j0 = i + 1, j + 1
        todo.append((i0, a1, j0, b1))
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest run of pairs, given by rising first member, whose second members rise too."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        at = bisect_left(tails, j)
        if at == len(tails):
            tails.append(j)
            ends.append(k)
        else:
            tails[at], ends[at] = j, k
        back.append(ends[at - 1] if at else -1)
    out, k = [], ends[-1] if ends else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def common_lines(later: list[int], sizes: list[int], earlier: list[int], least_words: int) -> list[int]:
    """Lines of ``later`` in aligned blocks of at least ``least_words`` words; ``sizes``: words per line. A block is a
    run of matches between which neither side has another line with a word."""
    in_later, in_earlier = ([i for i, x in enumerate(lines) if x] for lines in (later, earlier))
    pairs = patience([later[i] for i in in_later], [earlier[i] for i in in_earlier])
    out: list[int] = []
    block: list[int] = []
    for (i, j), before in zip(pairs, [(-2, -2), *pairs]):
        if (i - 1, j - 1) != before:
            out += block if sum(sizes[x] for x in block) >= least_words else []
            block = []
        block.append(in_later[i])
    return out + (block if sum(sizes[x] for x in block) >= least_words else [])


def _lines(docs: DataFrame) -> DataFrame:
    """(place, text_key, hashes, sizes): hash and words of every line of every document; 0 without a word."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hashes, sizes = [], []
        for text in batch.column(0).to_pylist():
            split = text.split(b"\n")
            count = [len(x.split()) for x in split]
            sizes.append(count)
            # a hash of 0 would mean no line; bit 63 stays free for a signed long
            hashes.append([(xxhash.xxh3_64_intdigest(x) >> 1 | 1) if n else 0 for x, n in zip(split, count)])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
            ["place", "text_key", "hashes", "sizes"],
        )

    return map_rows(
        docs.where("text is not null").select(as_bytes("text"), "place", "text_key"),
        rows,
        "place long, text_key long, hashes array<long>, sizes array<int>",
    )


def _shared(lines: DataFrame) -> DataFrame:
    """(line, doc, n, first) for every line of a document that others hold too: how many do, and the first of them."""
    held = lines.select(F.struct("place", "text_key").alias("doc"), F.explode(F.array_distinct("hashes")).alias("line"))
    held = held.where("line <> 0").distinct()
    holders = held.groupBy("line").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")).where("n > 1")
    return held.join(holders, "line")


def _with_first(shared: DataFrame, rare: int) -> DataFrame:
    """(later, earlier): holders of a line in more than ``rare`` documents, and its first."""
    return shared.where((F.col("n") > rare) & (F.col("doc") > F.col("first"))).select(
        F.col("doc").alias("later"), F.col("first").alias("earlier")
    )


def _all_pairs(shared: DataFrame, rare: int) -> DataFrame:
    """(later, earlier): all holders of a line in at most ``rare`` documents, so at most their square of pairs."""
    few = shared.where(F.col("n") <= rare).groupBy("line").agg(F.collect_list("doc").alias("docs"))
    few = few.select("docs", F.explode("docs").alias("later"))
    return few.select("later", F.explode("docs").alias("earlier")).where("later > earlier").distinct()


def _aligned(pairs: DataFrame, least_words: int) -> DataFrame:
    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        columns = [batch.column(c).to_pylist() for c in ("hashes", "sizes", "earlier_hashes")]
        found = [common_lines(*row, least_words) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("later"), pa.array(found, pa.list_(pa.int32()))], ["later", "lines"]
        )

    return map_rows(
        pairs.select("later", "hashes", "sizes", "earlier_hashes"),
        rows,
        f"later {DOC}, lines array<int>",
    )


def shortest_runs(view: list[int], sizes: list[int], least_words: int) -> set[tuple[int, int]]:
    """(begin, end) of the shortest runs of common lines with ``least_words`` words from each line on, and up to each line.
    Every line of a block that is long enough lies in one of them that is part of the block."""
    out = set()
    for at in range(len(view)):
        for step in (1, -1):
            words, k = 0, at
            while 0 <= k < len(view) and view[k] != OTHER:
                words += sizes[k]
                if words >= least_words:
                    out.add((min(at, k), max(at, k) + 1))
                    break
                k += step
    return out


def _views(docs: DataFrame, least_words: int) -> DataFrame:
    """Views of ``docs`` (doc, hashes, sizes, common): ``seq`` and the words and positions of its lines, and their runs."""

    def key(seq: list[int]) -> int:
        return xxhash.xxh3_64_intdigest(np.array(seq, np.int64).tobytes()) >> 1

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out = []
        for hashes, sizes, common in zip(*(batch.column(c).to_pylist() for c in ("hashes", "sizes", "common"))):
            seq, words, at, known = [], [], [], set(common)
            for i, (x, n) in enumerate(zip(hashes, sizes)):
                if x in known or (x and seq[-1:] != [OTHER]):
                    seq.append(x if x in known else OTHER)
                    words.append(n)
                    at.append(i)
            runs = [{"run": key(seq[i:j]), "lines": at[i:j]} for i, j in sorted(shortest_runs(seq, words, least_words))]
            out.append({"view": key(seq), "seq": seq, "words": words, "at": at, "runs": runs})
        run = pa.struct([("run", pa.int64()), ("lines", pa.list_(pa.int32()))])
        types = {"view": pa.int64(), "seq": pa.list_(pa.int64()), "words": pa.list_(pa.int32()), "at": pa.list_(pa.int32()), "runs": pa.list_(run)}
        columns = [pa.array([r[c] for r in out], t) for c, t in types.items()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), *columns], ["doc", *types])

    schema = f"doc {DOC}, view long, seq array<long>, words array<int>, at array<int>, runs array<struct<run:long,lines:array<int>>>"
    return map_rows(docs.select("doc", "hashes", "sizes", "common"), rows, schema)


def _aligned_views(pairs: DataFrame, least_words: int) -> DataFrame:
    """(later, earlier, spot): positions in the view ``later`` that it shares with the view ``earlier``."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = []
        for seq, words, other in zip(*(batch.column(c).to_pylist() for c in ("seq", "words", "earlier_seq"))):
            other = [OTHER - 1 if x == OTHER else x for x in other]  # other lines of two documents are never equal
            found.append(common_lines(seq, words, other, least_words))
        yield pa.RecordBatch.from_arrays(
            [batch.column("later"), batch.column("earlier"), pa.array(found, pa.list_(pa.int32()))], ["later", "earlier", "spots"]
        )

    pairs = pairs.select("later", "earlier", "seq", "words", "earlier_seq")
    return map_rows(pairs, rows, "later long, earlier long, spots array<int>").select("later", "earlier", F.explode("spots").alias("spot"))


def _by_views(views: DataFrame, gone: DataFrame, few: DataFrame, least_words: int) -> DataFrame:
    """(later, lines) that leave documents through pairs that share common lines only. ``gone``: (later, lines) deleted
    already; ``few``: (later, earlier) that share a rarer line."""
    left = views.join(gone.withColumnRenamed("later", "doc"), "doc", "left").withColumn("lines", F.coalesce("lines", F.array().cast("array<int>")))
    left = left.select("doc", "view", "at", "lines", F.explode("runs").alias("run"))
    left = cut_lineage(left.where(F.size(F.array_except("run.lines", "lines")) > 0))
    if left.isEmpty():
        return gone.limit(0)
    kinds = views.groupBy("view").agg(F.min("doc").alias("first"), F.first("seq").alias("seq"), F.first("words").alias("words"))
    kinds = cut_lineage(kinds)
    firsts = kinds.select(F.col("view").alias("earlier"), "first")

    asked = left.groupBy(F.col("run.run").alias("run"), F.col("view").alias("later")).agg(F.max("doc").alias("last"))
    holding = views.select(F.col("view").alias("earlier"), F.explode("runs.run").alias("run")).distinct()
    pairs = asked.join(holding.join(firsts, "earlier"), "run").where("first < last").select("later", "earlier").distinct()
    pairs = pairs.join(kinds.select(F.col("view").alias("later"), "seq", "words"), "later")
    pairs = pairs.join(kinds.select(F.col("view").alias("earlier"), F.col("seq").alias("earlier_seq")), "earlier")
    hits = cut_lineage(_aligned_views(pairs, least_words))

    best = hits.join(firsts, "earlier").groupBy("later", "spot").agg(F.min("first").alias("earlier"))
    wanted = left.select("doc", F.col("view").alias("later"), "at", "lines").distinct()
    wanted = wanted.join(best, "later").where("earlier < doc").withColumn("line", F.expr("at[spot]"))
    wanted = wanted.where("not array_contains(lines, line)").select(F.col("doc"), F.col("later").alias("view"), "spot", "line", "earlier")
    partners = few.select(F.col("later").alias("doc"), "earlier", F.lit(True).alias("full"))
    wanted = cut_lineage(wanted.join(partners, ["doc", "earlier"], "left"))
    found = wanted.where("full is null").select("doc", "line")

    # where that earliest document shares a rarer line too, another one decides: a document with n such partners needs no
    # more than the n + 1 first of each view to find one that is none of them
    unsure = wanted.where("full").select("doc", "view", "spot", "line")
    n_partners = few.join(unsure.select(F.col("doc").alias("later")).distinct(), "later").groupBy(F.col("later").alias("doc")).agg(F.count(F.lit(1)).alias("n"))
    most = n_partners.agg(F.max("n")).first()[0]
    if most:
        by_place = Window.partitionBy("view").orderBy("doc")
        members = views.select("view", "doc").withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= most + 1)
        members = members.select(F.col("view").alias("other"), F.col("doc").alias("earlier"), "rank")
        tried = unsure.join(n_partners, "doc").join(hits.select(F.col("later").alias("view"), F.col("earlier").alias("other"), "spot"), ["view", "spot"])
        tried = tried.join(members, "other").where("rank <= n + 1 and earlier < doc")
        found = found.union(tried.join(partners, ["doc", "earlier"], "left_anti").select("doc", "line"))
    return found.groupBy(F.col("doc").alias("later")).agg(F.collect_set("line").alias("lines"))


def _without(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Text without the lines at the positions in ``lines``."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, lines: pa.Array) -> pa.Array:
        out = []
        for text, gone in zip(texts.to_pylist(), lines.to_pylist()):
            if gone:
                gone = set(gone)
                text = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in gone)
            out.append(text)
        return pa.array(out, pa.binary())

    kept = cut(F.col("text").cast("binary"), F.col("__lines")).cast("string")
    return docs.select(
        *(F.when(F.size("__lines") > 0, kept).otherwise(F.col("text")).alias("text") if c == "text" else F.col(c) for c in columns),
        F.coalesce(F.size("__lines"), F.lit(0)).alias("__removed"),
    )


def dedup_lines(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """The columns of ``docs`` with shortened texts, and ``__removed``, the number of lines deleted. Other columns pass under
    names of their own; one that is called ``__removed`` itself gives way to the number."""
    renamed, _ = set_aside(docs, ("doc_id", "text"))
    keyed = renamed.withColumn("__place", F.coalesce("doc_id", F.lit(LAST))).withColumn("__text_key", F.xxhash64("text"))
    slim = keyed.select("text", F.col("__place").alias("place"), F.col("__text_key").alias("text_key"))
    lines = cut_lineage(_lines(slim))
    once = lines.dropDuplicates(["place", "text_key"]).select(F.struct("place", "text_key").alias("doc"), "hashes", "sizes")
    shared = cut_lineage(_shared(lines))
    few = cut_lineage(_all_pairs(shared, RARE))
    pairs = few.union(_with_first(shared, RARE)).distinct()
    full = pairs.join(once.withColumnRenamed("doc", "later"), "later").join(
        once.select(F.col("doc").alias("earlier"), F.col("hashes").alias("earlier_hashes")), "earlier"
    )
    found = _aligned(full, least_words).where(F.size("lines") > 0)
    gone = found.select("later", F.explode("lines").alias("line")).groupBy("later").agg(F.collect_set("line").alias("lines"))
    gone = cut_lineage(gone)
    common = shared.where(F.col("n") > RARE).groupBy("doc").agg(F.collect_list("line").alias("common"))
    views = cut_lineage(_views(once.join(common, "doc"), least_words))
    more = gone.union(_by_views(views, gone, few, least_words))
    gone = more.groupBy("later").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("lines"))
    gone = gone.select(F.col("later.place").alias("__place"), F.col("later.text_key").alias("__text_key"), F.col("lines").alias("__lines"))
    found = _without(keyed.join(gone, ["__place", "__text_key"], "left"), renamed.columns)
    kept = [c for c in docs.columns if c != "__removed"]
    names = dict(zip(docs.columns, renamed.columns))
    return found.select(*[F.col(names[c]).alias(c) for c in kept], "__removed")

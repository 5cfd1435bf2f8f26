"""Near-duplicate documents by improved consistent weighted sampling.

A document is the weighted set of its five-word shingles: how often one occurs, times the mean inverse document
frequency of its words, counted over all documents. The counts of the most frequent words are a table of at most
``TABLE`` words, which every task gets: all words that make up more than one of ``TABLE`` pairs of a document and a word.
The others' counts meet their documents in a shuffle, which none of them can skew, and travel with the texts from then on.
Samples (Ioffe's scheme) fall in ``BANDS`` bands of ``ROWS``; documents that agree on a band are candidates, and a
link needs an exact weighted Jaccard similarity of ``SIMILARITY`` or more. Classes are connected components.

Texts of equal words are one text from the start. In a bucket every text is first compared with the bucket's most central
one. Where a bucket still falls in several classes, its texts are compared in blocks, all with all of other classes; a
block returns only links that join classes. So a group of copies costs about one comparison a text, no pairs of a
group are written, and no candidate that could join two classes is left out.

Texts of fewer than five words are one shingle. Null texts and texts without words belong to no other document.
Rows that repeat a doc_id are told apart by their texts. Rows without doc_id take part; a class of such rows alone has
no class id. Other columns are not read. An empty table gives no row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.llm.carried import carries_columns
from mapstrata.llm.components import connected_components
from mapstrata.llm.storage import release
from mapstrata.llm.words import Rolling, as_bytes, give_back, map_rows, mixed, signed, split_words, worker_state
from mapstrata.session import cut_lineage

SHINGLE, SIMILARITY = 5, 0.8
ROWS, BANDS = 3, 12
TABLE = 1 << 22  # most words whose counts every task gets, of 16 bytes each
BUCKET_BYTES = 16 << 20  # texts that meet the counts of their words in one group of a task
BLOCK = 256  # texts of a bucket that a task compares with as many others at a time
BAND_NAMES = [f"band{i}" for i in range(BANDS)]


# Whether a byte is part of a word; numbers that stand for a byte (none for blanks) and for a place in a word.
SOLID = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BYTES, PLACES = mixed(np.arange(1, 257, dtype=np.uint64)) * SOLID, mixed(np.arange(1001, 1257, dtype=np.uint64)) | np.uint64(1)


def words_of(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words of a text: sums of products of byte and place, of all words at once."""
    data = np.frombuffer(text or b"", np.uint8)
    solid = SOLID.take(data)
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = np.empty_like(starts)  # with the blanks behind a word, which add nothing
    np.subtract(starts[1:], starts[:-1], out=lengths[:-1])
    lengths[-1] = len(data) - starts[-1]
    longest = lengths.max()
    places = PLACES if longest <= len(PLACES) else mixed(np.arange(1001, 1001 + longest, dtype=np.uint64)) | np.uint64(1)
    at = np.arange(starts[0], len(data))
    at -= np.repeat(starts, lengths)
    products = BYTES.take(data[starts[0] :])
    products *= places.take(at)
    return mixed(np.add.reduceat(products, starts - starts[0]))


def distinct_words(text: bytes | None) -> np.ndarray:
    return np.unique(words_of(text))


def common_words(docs: DataFrame) -> tuple[int, np.ndarray, np.ndarray, int]:
    """Number of documents with a word; sorted hashes of the at most ``TABLE`` most frequent words, and in how many
    documents each one is; bytes of all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, documents, length, size = [], 0, 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = distinct_words(text)
                documents += bool(len(words))
                length += len(text or b"")
                held.append(words)
                size += len(words)
                if size > 1 << 20:  # bounds what a task holds
                    yield summed(held)
                    held, size = [], 0
        held.append(np.zeros(0, np.uint64))
        yield summed(held)
        yield of([None], [documents], [length])

    def of(words: object, n: object, length: object) -> pa.RecordBatch:
        columns = [pa.array(c, pa.int64()) for c in (words, n, length)]
        return pa.RecordBatch.from_arrays(columns, ["word", "n", "length"])

    def summed(held: list[np.ndarray]) -> pa.RecordBatch:
        words, n = np.unique(np.concatenate(held), return_counts=True)
        return of(signed(words), n.astype(np.int64), np.zeros(len(n), np.int64))

    rows = docs.select(as_bytes("text")).mapInArrow(count, "word long, n long, length long")
    counts = cut_lineage(rows.groupBy("word").agg(F.sum("n").alias("n"), F.sum("length").alias("length")))
    total, length = (counts.where("word is null").select("n", "length").first() or (0, 0))
    counts = counts.where("word is not null").select("word", "n")
    pairs = counts.agg(F.sum("n")).first()[0] or 0
    table = counts.where(F.col("n") * TABLE > pairs).toPandas()  # fewer than TABLE, as no more fit in all pairs
    words = table["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return total, words[order], table["n"].to_numpy(np.int64)[order], length


def places(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash stands among the sorted ``known`` ones, and whether it does."""
    if not len(known):
        return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return at, known[at] == hashes


class Places:
    """The same for many calls. The first bits of a hash tell where those that begin with them stand, of which there are
    few, as the bits of hashes are even."""

    def __init__(self, known: np.ndarray) -> None:
        bits = max(1, len(known).bit_length())
        self.known, self.shift = known, np.uint64(64 - bits)
        counts = np.bincount((known >> self.shift).view(np.int64), minlength=1 << bits)
        self.most = int(counts.max(initial=0))
        self.begins = (np.cumsum(counts) - counts).astype(np.int32) if 0 < self.most <= 16 else None

    def __call__(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.begins is None:
            return places(self.known, hashes)
        at = self.begins.take((hashes >> self.shift).view(np.int64))
        for _ in range(self.most):
            less = self.known.take(at, mode="clip") < hashes
            if not less.any():
                break
            at += less
        np.minimum(at, len(self.known) - 1, out=at)
        return at, self.known.take(at) == hashes


def held_places(name: str, known: np.ndarray) -> Places:
    """Places of the table of that name, which the tasks of a worker share; a worker holds those of one table."""
    held = worker_state("words places", dict)
    if name not in held:
        held.clear()
        held[name] = Places(known)
    return held[name]


class Weights:
    """Weighted shingles of texts. Every text comes with the counts of its words that are neither common nor in no other
    document: their hashes in order, then as many 32-bit counts."""

    def __init__(self, total: int, words: np.ndarray, n: np.ndarray) -> None:
        self.total, self.words, self.n = total, words, n
        self.name = uuid.uuid4().hex  # of the table of words

    def __call__(self, words: np.ndarray, own: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingles and their weights."""
        shingles, counts, values = self.counted(words, own)
        return shingles, counts * values

    def documents(self, hashes: np.ndarray, own: bytes) -> np.ndarray:
        """In how many documents each word is."""
        at, common = held_places(self.name, self.words)(hashes)
        n = np.ones(len(hashes), np.int64)
        n[common] = self.n[at[common]]
        if own:
            k = len(own) // 12
            at, found = places(np.frombuffer(own, np.uint64, k), hashes)
            n[found] = np.frombuffer(own, np.uint32, k, 8 * k)[at[found]]
        return n

    def counted(self, words: np.ndarray, own: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct shingles, how often they occur, and the value of one occurrence."""
        if not len(words):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        idf = 1 + np.log((self.total + 1) / (self.documents(words, own) + 1))
        width = min(SHINGLE, len(words))
        shingles = Rolling(words).all(width)
        shingles = shingles if len(shingles) else Rolling(words).runs(np.array([0]), width)
        sums = np.concatenate([[0.0], np.cumsum(idf)])
        mean = (sums[width:] - sums[:-width]) / width
        order = shingles.argsort(kind="stable")
        ordered = shingles[order]
        begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        ends = np.append(begins[1:], len(ordered))
        return ordered[begins], ends - begins, mean[order[begins]]


def _other_words(docs: DataFrame, weights: Weights) -> DataFrame:
    """(row, word, n) for every word of every row of ``docs`` (text, row) that is in several documents, ``n``, and not
    among the common ones that all ``weights`` know."""
    name, common = weights.name, weights.words

    def words(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = [distinct_words(text) for text in batch.column(0).to_pylist()]
        rows = np.repeat(batch.column(1).to_numpy(), [len(hashes) for hashes in held])
        hashes = np.concatenate([np.zeros(0, np.uint64), *held])
        other = ~held_places(name, common)(hashes)[1]
        yield pa.RecordBatch.from_arrays([pa.array(rows[other]), pa.array(signed(hashes[other]))], ["row", "word"])

    pairs = map_rows(docs.select(as_bytes("text"), "row"), words, "row long, word long")
    return pairs.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("word"))).where("n > 1")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    union = a[1].sum() + b[1].sum() - both
    return float(both / union) if union else 0.0


class Sampler:
    """Improved consistent weighted samples. The random numbers of a shingle come from its hash, 16 bits each,
    through quantile tables of their distributions (Gamma(2, 1) twice, and uniform)."""

    def __init__(self) -> None:
        p = (np.arange(1 << 16) + 0.5) / (1 << 16)
        low, high = np.zeros_like(p), np.full_like(p, 40.0)
        for _ in range(60):  # bisection of the distribution function 1 - (1 + x) exp(-x)
            mid = (low + high) / 2
            less = 1 - (1 + mid) * np.exp(-mid) < p
            low, high = np.where(less, mid, low), np.where(less, high, mid)
        self.r = low.astype(np.float32)
        self.log_c = np.log(low).astype(np.float32)
        k = ROWS * BANDS
        self.factors = (mixed(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1))[:, None]

    def bands(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.keys(*(x[None] for x in self.samples(shingles, weights)))[0]

    def samples(self, shingles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The chosen shingles and their levels. Only shingles that may be the least are computed in full: the logarithm
        that is compared, log c - r (t + 1 - beta), is at least log c - r - log w."""
        k = len(self.factors)
        best, pick, level = np.full(k, np.inf, np.float32), np.zeros(k, np.uint64), np.zeros(k, np.float32)
        logs, row = np.log(weights).astype(np.float32), np.arange(k)
        for at in range(0, len(shingles), 1024):  # blocks that stay in a core's cache
            s, log_w = shingles[at : at + 1024], logs[at : at + 1024]
            bits = (s * self.factors).view(np.uint16).reshape(k, len(s), 4)
            least = self.log_c.take(bits[:, :, 2])
            least -= self.r.take(bits[:, :, 3])
            least -= log_w

            def full(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                own = bits[i, j]
                beta, r = own[:, 1] * np.float32(2**-16), self.r.take(own[:, 3])
                t = np.floor(log_w[j] / r + beta)
                return (beta - t - 1) * r + self.log_c.take(own[:, 2]), t

            bound = np.minimum(full(row, least.argmin(axis=1))[0], best)
            bound += np.abs(bound) * np.float32(1e-4) + np.float32(1e-3)  # more than the rounding of either side
            i, j = np.divmod(np.flatnonzero(least <= bound[:, None]), len(s))
            log_a, t = full(i, j)
            # the first of the least ones of every sample that has any
            lows = np.full(k, np.inf, np.float32)
            np.minimum.at(lows, i, log_a)
            hits = np.flatnonzero((log_a == lows[i]) & (log_a < best[i]))
            of, first = i[hits[::-1]], hits[::-1]  # of equal ones the last to be written is the first in order
            best[of], pick[of], level[of] = log_a[first], s[j[first]], t[first]
        return pick, level

    def keys(self, pick: np.ndarray, level: np.ndarray) -> np.ndarray:
        """Keys of the bands of each row of samples."""
        samples = mixed(pick + mixed(level.astype(np.int64).view(np.uint64) + np.uint64(1)))
        keys = np.arange(BANDS, dtype=np.uint64)
        for step in np.moveaxis(samples.reshape(-1, BANDS, ROWS), 2, 0):
            keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + step)
        return signed(keys)


def fingerprint(words: list[bytes]) -> bytes | None:
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def with_fingerprint(docs: DataFrame, name: str) -> DataFrame:
    """Adds the hash of the words of ``text``; null for texts without a word."""

    @F.arrow_udf("binary")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(split_words(x)) for x in texts.to_pylist()], pa.binary())

    return docs.withColumn(name, of(F.col("text").cast("binary")))


def _named(docs: DataFrame) -> DataFrame:
    """(text, doc_id, row), ``row`` a hash that names the row."""
    # the id is part of the name, so that rows of one text are dealt over all buckets; rows of one name share their counts
    return docs.select(as_bytes("text"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text", "doc_id").alias("row"))


def _signatures(docs: DataFrame, weights: Weights, length: int) -> DataFrame:
    """(doc_id, row, print, own, weight, band0...) of every row, ``own`` the counts that its ``Weights`` need; only the id and
    name where there is no word."""

    def sign(left: pa.Table, right: pa.Table) -> pa.Table:
        sampler = worker_state("words sampler", Sampler)
        row, word, n = (right.column(c).to_numpy() for c in ("row", "word", "n"))
        order = np.lexsort((word.view(np.uint64), row))
        row, word, n = row[order], word.view(np.uint64)[order], n[order].astype(np.uint32)
        names = left.column("row").to_numpy()
        begins, ends = np.searchsorted(row, names, "left"), np.searchsorted(row, names, "right")
        prints, tables, totals, numbers, picks, levels = [], [], [], [], [], []
        known: dict = {None: (0.0, 0)}  # by print: texts of equal words are signed once a group
        for text, begin, end in zip(left.column("text").to_pylist(), begins, ends):
            prints.append(fingerprint(split_words(text)))
            tables.append(word[begin:end].tobytes() + n[begin:end].tobytes())
            if prints[-1] not in known:
                shingles, values = weights(words_of(text), tables[-1])
                known[prints[-1]] = float(values.sum()), len(known)
                pick, level = sampler.samples(shingles, values)
                picks.append(pick)
                levels.append(level)
            totals.append(known[prints[-1]][0])
            numbers.append(known[prints[-1]][1])
        keys = [np.zeros((1, BANDS), np.int64)]
        if picks:
            keys.append(sampler.keys(np.array(picks), np.array(levels)))
        found = np.concatenate(keys)[np.array(numbers, np.int64)]
        return pa.table(
            [left.column("doc_id"), left.column("row"), pa.array(prints, pa.binary()), pa.array(tables, pa.binary()), pa.array(totals, pa.float64()), *map(pa.array, np.ascontiguousarray(found.T))],
            names=["doc_id", "row", "print", "own", "weight", *BAND_NAMES],
        )

    schema = ", ".join(["doc_id long, row long, print binary, own binary, weight double", *(f"{b} long" for b in BAND_NAMES)])
    named = _named(docs)
    bucket = F.pmod("row", F.lit(1 + length // BUCKET_BYTES)).alias("bucket")
    counts = _other_words(named, weights).select("row", "word", "n", bucket).groupBy("bucket")
    return named.select("*", bucket).groupBy("bucket").cogroup(counts).applyInArrow(sign, schema)


def _verified(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """The pairs (a, b) of prints whose texts are similar enough."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keep, hub, known = [], None, None
        for b, text_a, text_b, own_a, own_b in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b", "own_a", "own_b"))):
            if b != hub:  # pairs of one hub come together
                hub, known = b, weights(words_of(text_b), own_b)
            keep.append(weighted_jaccard(weights(words_of(text_a), own_a), known) >= SIMILARITY)
        give_back()
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    a, b = (texts.select(F.col("print").alias(x), F.col("text").alias(f"text_{x}"), F.col("own").alias(f"own_{x}")) for x in "ab")
    full = pairs.join(a, "a").join(b, "b")
    return map_rows(full.select("a", "b", "text_a", "text_b", "own_a", "own_b"), rows, "a binary, b binary")


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(print, text, own) of the ``wanted`` (print, doc_id, row, own) rows, one per print."""
    wanted = wanted.select("print", F.col("doc_id").alias("__d"), F.col("row").alias("__r"), "own")
    found = _named(docs).join(wanted, (F.col("row") == F.col("__r")) & F.col("doc_id").eqNullSafe(F.col("__d")))
    return found.select("print", "text", "own").dropDuplicates(["print"])


def block_links(texts: list[bytes], owns: list[bytes], classes: list, sides: np.ndarray, weights: Weights) -> list[tuple[int, int]]:
    """Links that join classes of one block: a spanning set of the similar pairs, one from either side of the block (or
    any, where it has one side only). Intersections of all pairs come from products of a few thousand shingles at
    a time; the second occurrence of a shingle in a text is a feature of its own, so that sums of minima are exact."""
    features, rows, values, totals = [], [], [], np.zeros(len(texts))
    for row, (text, own) in enumerate(zip(texts, owns)):
        shingles, counts, value = weights.counted(words_of(text), own)
        totals[row] = float((counts * value).sum())
        levels = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        features.append(mixed(np.repeat(shingles, counts) + mixed(levels)))
        values.append(np.repeat(value, counts))
        rows.append(np.full(len(levels), row))
    _, number, n = np.unique(np.concatenate(features), return_inverse=True, return_counts=True)
    shared = n[number] > 1
    number, row, value = number[shared], np.concatenate(rows)[shared], np.concatenate(values)[shared]
    order = np.argsort(number, kind="stable")
    number, row, value = number[order], row[order], np.sqrt(value[order])
    both = np.zeros((len(texts), len(texts)))
    steps = np.flatnonzero(np.diff(number, prepend=-1))  # where each feature begins
    for at in range(0, len(steps), 4096):
        part = slice(steps[at], steps[at + 4096] if at + 4096 < len(steps) else len(number))
        column = np.cumsum(np.diff(number[part], prepend=number[part.start]) > 0)
        table = np.zeros((len(texts), 4096))
        table[row[part], column] = value[part]
        both += table @ table.T
    similar = np.triu(both >= SIMILARITY * (totals[:, None] + totals[None, :] - both), 1)
    if sides.any() and not sides.all():
        similar &= sides[:, None] != sides[None, :]
    parent = {c: c for c in classes}

    def find(c: object) -> object:
        while parent[c] != c:
            c = parent[c]
        return c

    out = []
    for i, j in zip(*np.nonzero(similar)):
        a, b = find(classes[i]), find(classes[j])
        if a != b:
            parent[a] = b
            out.append((int(i), int(j)))
    return out


def _linking(weights: Weights) -> Callable[[tuple, pa.Table], pa.Table]:
    def link(key: tuple, block: pa.Table) -> pa.Table:
        prints = block.column("print").to_pylist()
        sides = block.column("chunk").to_numpy() == key[2].as_py()
        texts, owns, classes = (block.column(c).to_pylist() for c in ("text", "own", "c"))
        found = block_links(texts, owns, classes, sides, weights)
        if len(prints) >= BLOCK // 4:  # tables of a large block are many times its texts
            give_back()
        return pa.table({"a": pa.array([prints[i] for i, _ in found], pa.binary()), "b": pa.array([prints[j] for _, j in found], pa.binary())})

    return link


def _links_within(open_members: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Links inside buckets of any size: members (band, key, n, print, c) are dealt to chunks, and every pair of chunks
    is one block of a task, which compares all texts of different classes and returns the links that join classes."""
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = open_members.withColumn("chunk", F.pmod(F.xxhash64("print"), parts).cast("int"))
    dealt = dealt.select("band", "key", "print", "c", "chunk", F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"))
    dealt = dealt.select("band", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "print", "c", "chunk")
    blocks = dealt.join(texts, "print")
    # i is the third key: the side of a block that a text is on
    return blocks.groupBy("band", "key", "i", "j").applyInArrow(_linking(weights), "a binary, b binary")


def _buckets(texts: DataFrame) -> DataFrame:
    """(band, key, n, print, weight, hub) for every text of every bucket of two texts or more. The hub of a bucket is the
    text that meets the most others in all its buckets: in a family of copies, the one they come from."""
    members = texts.select("print", "weight", F.posexplode(F.array(*BAND_NAMES)).alias("band", "key"))
    sizes = members.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut_lineage(members.join(sizes, ["band", "key"]))
    central = members.groupBy("print").agg(F.sum("n").alias("met"))
    hubs = members.join(central, "print").groupBy("band", "key").agg(F.max(F.struct("met", "print")).alias("hub"))
    return cut_lineage(members.join(hubs, ["band", "key"]).withColumn("hub", F.col("hub.print")))


def _with_classes(members: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    classes = connected_components(links).select(F.col("node").alias("print"), F.col("component").alias("c"))
    return classes, members.join(classes, "print", "left").withColumn("c", F.coalesce("c", "print"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, print, class_id, first_print) for every row of ``docs``. ``class_id`` is the smallest doc_id of the
    class; ``first_print`` the print of the text that stands for it."""
    *known, length = common_words(docs)
    weights = Weights(*known)
    rows = cut_lineage(_signatures(docs, weights, length))
    texts = rows.where("print is not null").groupBy("print").agg(
        F.min("doc_id").alias("doc_id"), F.first("weight").alias("weight"), *(F.first(b).alias(b) for b in BAND_NAMES)
    )
    texts = cut_lineage(texts)
    named = texts.select("print", "doc_id")
    members = _buckets(texts)
    owns = rows.select(F.col("print").alias("__q"), F.col("doc_id").alias("__i"), "row", "own")

    def with_own(wanted: DataFrame) -> DataFrame:
        match = (F.col("print") == F.col("__q")) & F.col("doc_id").eqNullSafe(F.col("__i"))
        return wanted.join(owns, match).dropDuplicates(["print"]).select("print", "doc_id", "row", "own")

    # first every text of a bucket with its hub
    near = F.least("weight", "hub_weight") >= SIMILARITY * 0.999999 * F.greatest("weight", "hub_weight")
    hub_weight = texts.select(F.col("print").alias("hub"), F.col("weight").alias("hub_weight"))
    star = members.where("print <> hub").select("print", "hub", "weight").distinct().join(hub_weight, "hub")
    star = cut_lineage(star.where(near).select(F.col("print").alias("a"), F.col("hub").alias("b")))
    involved = star.select(F.col("a").alias("print")).union(star.select("b")).distinct().join(named, "print")
    links = cut_lineage(_verified(star, _texts_of(docs, with_own(involved)), weights))
    release(docs.sparkSession)
    classes, placed = _with_classes(members, links)

    # then the buckets whose texts are not yet in one class; of two texts both have been compared
    apart = placed.groupBy("band", "key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    still_open = placed.where("n > 2").join(apart, ["band", "key"], "left_semi").select("band", "key", "n", "print", "c")
    still_open = cut_lineage(still_open)
    if not still_open.isEmpty():
        involved = still_open.select("print").distinct().join(named, "print")
        more = cut_lineage(_links_within(still_open, _texts_of(docs, with_own(involved)), weights))
        release(docs.sparkSession)
        if not more.isEmpty():
            classes, _ = _with_classes(members, links.union(more))

    named = named.join(classes, "print", "left").withColumn("c", F.coalesce("c", "print"))
    first = named.groupBy("c").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("print"))).alias("first"))
    named = named.join(first, "c").select("print", F.col("first.doc_id").alias("class_id"), F.col("first.print").alias("first_print"))
    return rows.select("doc_id", "print").join(named, "print", "left").select(
        "doc_id", "print", F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "first_print"
    )


@carries_columns("doc_id", "text")
def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of every class: the smallest doc_id. Rows without a word all stay. Columns as in ``docs``."""
    found = near_duplicates(docs)
    firsts = found.where("print = first_print and doc_id <=> class_id").groupBy("doc_id", "print").agg(F.count(F.lit(1)).alias("n"))
    firsts = cut_lineage(firsts.select(F.col("doc_id").alias("__d"), F.col("print").alias("__p"), "n"))
    keyed = with_fingerprint(docs, "__print")
    match = (F.col("__print") == F.col("__p")) & F.col("doc_id").eqNullSafe(F.col("__d"))
    kept = keyed.join(firsts.where("n = 1"), match, "left").where("__print is null or __p is not null").select(*docs.columns)
    if not firsts.where("n > 1").isEmpty():  # rows that repeat both doc_id and text: one of them
        again = keyed.join(firsts.where("n > 1"), match, "left_semi").dropDuplicates(["doc_id", "__print"])
        kept = kept.unionByName(again.select(*docs.columns))
    return kept

"""Maximal runs of periodically repeated words, located by block convolution.

A run is a stretch of consecutive words whose smallest period is q, at least ``max(LEAST_LENGTH, 2 * q)`` words long, that
no neighbouring word extends keeping the period.

Texts of a batch stand one after another, with a separator between them that equals nothing. At every scale B = 2, 4,
8, ... the words are cut in blocks of B. Whatever the place of a run of period q, the words of it that q words later ones
repeat hold a whole block of the scale with q in ``[2 * B - 1, 4 * B - 2]`` (from 1 on at the smallest scale). The
squared differences between a block and each shift of the window behind it, summed, come from one number theoretic
transform of exact integers; shifts with sum 0 are the occurrences. Each is a pair of equal blocks at a distance, which is
extended to both sides. Equal stretches found at several distances are one run: the smallest distance is its period, since
by Fine and Wilf all others are its multiples.

Blocks with a word that does not come again within the window have no occurrence and take no transform. A run of at most
half a block's length as period is known from earlier scales: its own multiples are not extended again, and a block whose
window ends within it has no others.

Null and empty texts have no words and no runs. Repeated rows are judged each for itself; an empty table gives an empty
result. A text is one row's own work whatever its length, so no table is shuffled; other columns of ``docs`` are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapstrata.llm.words import Rolling, as_bytes, map_rows, mixed, split_words

LEAST_LENGTH = 12
SMALLEST_BLOCK = 2

# Words worked on together: texts are put together up to this many, a longer one is alone.
WORDS_TOGETHER = 400_000
# Numbers in one transform.
CELLS = 1 << 18

# Primes k * 2**m + 1 with m >= 23, each with a primitive root.
PRIMES = [(998244353, 3), (167772161, 3), (469762049, 3)]


def rewritten(n: int, doc_id: int | None) -> np.ndarray | None:
    """Places that the words of a text are taken from where its id makes it periodic, else None. A null id does not."""
    if n == 0 or doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _transform(x: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Number theoretic transforms of the rows of ``x``, whose length is a power of two."""
    m, size = x.shape
    powers = np.ones(max(size // 2, 1), dtype=np.uint64)
    step = pow(root, (prime - 1) // size, prime)
    known = 1
    while known < len(powers):
        more = min(known, len(powers) - known)
        powers[known : known + more] = powers[:more] * np.uint64(pow(step, known, prime)) % np.uint64(prime)
        known += more
    p = np.uint64(prime)
    x, rest, stride = x.astype(np.uint64).reshape(m, size, 1), size, 1
    while rest > 1:
        half = rest // 2
        low, high = x[:, :half], x[:, half:]
        out = np.empty((m, half, 2, stride), dtype=np.uint64)
        total = low + high
        out[:, :, 0] = np.where(total >= p, total - p, total)
        product = (low + (p - high)) * powers[::stride][:half, None]
        out[:, :, 1] = product - (product // p) * p
        rest, stride = half, stride * 2
        x = out.reshape(m, rest, stride)
    return x.reshape(m, size)


def _correlations(blocks: np.ndarray, windows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """Sums over j of ``blocks[:, j] * windows[:, k + j]`` modulo a prime, for every k; windows have a power of two as length."""
    m, size = windows.shape
    turned = np.zeros_like(windows)
    turned[:, -np.arange(blocks.shape[1])] = blocks
    product = _transform(turned, prime, root) * _transform(windows, prime, root) % np.uint64(prime)
    back = _transform(product, prime, pow(root, -1, prime))
    return back * np.uint64(pow(size, -1, prime)) % np.uint64(prime)


def _numbered(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each block as small numbers from 1 on, and its window in the same numbers, 0 where the block has no such word."""
    m, size = blocks.shape
    top = int(max(blocks.max(), windows.max())) + 1
    rows = np.arange(m, dtype=np.int64)[:, None] * top
    known, place = np.unique((blocks + rows).ravel(), return_inverse=True)
    first = np.searchsorted(known, rows.ravel())[:, None]
    numbers = place.reshape(m, size) - first + 1
    asked = (windows + rows).ravel()
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    found = np.where(known[at] == asked, at, -1).reshape(windows.shape)
    return numbers, np.where(found >= 0, found - first + 1, 0)


def occurrences(ids: np.ndarray, starts: np.ndarray, block: int, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances, ``nearest`` to ``4 * block - 2``, at which the blocks at ``starts`` occur again."""
    places, distances = [], []
    reach, size = 4 * block - 2, 4 * block
    offsets = np.arange(nearest, reach + block)
    # A sum of squared differences is below block ** 3, so zero modulo primes of a larger product is zero.
    primes, product = [], 1
    for prime, root in PRIMES:
        primes.append((prime, root))
        product *= prime
        if product > 2 * block**3:
            break
    padded = np.concatenate([ids, np.full(reach + block, ids.max(initial=0) + 1)])
    each = max(1, CELLS // size)
    for part in range(0, len(starts), each):
        at = starts[part : part + each]
        mine, behind = _numbered(padded[at[:, None] + np.arange(block)], padded[at[:, None] + offsets])
        window = np.zeros((len(at), size), dtype=np.int64)
        window[:, : len(offsets)] = behind
        shifts = len(offsets) - block + 1
        squares = np.zeros((len(at), len(offsets) + 1), dtype=np.int64)
        np.cumsum(behind * behind, axis=1, out=squares[:, 1:])
        fixed = (mine * mine).sum(axis=1)[:, None] + squares[:, block:] - squares[:, : shifts]
        equal = np.ones((len(at), shifts), dtype=bool)
        for prime, root in primes:
            cross = _correlations(mine, window, prime, root)[:, :shifts].astype(np.int64)
            equal &= (fixed - 2 * cross) % prime == 0
        row, shift = np.nonzero(equal)
        places.append(at[row])
        distances.append(shift + nearest)
    return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(distances or [np.zeros(0, np.int64)])


def _reach(rolling: Rolling, left: np.ndarray, right: np.ndarray, most: np.ndarray, backwards: bool) -> np.ndarray:
    """How many words from ``left`` and ``right`` on (or before them) agree, at most ``most``, by hashes of runs of words."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        a, b = (left - middle, right - middle) if backwards else (left, right)
        same = rolling.runs(a, middle) == rolling.runs(b, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _agree(ids: np.ndarray, start: int, end: int, distance: int) -> bool:
    """Whether a stretch has a period and no neighbour extends it, word by word."""
    if not np.array_equal(ids[start : end - distance], ids[start + distance : end]):
        return False
    return (start == 0 or ids[start - 1] != ids[start - 1 + distance]) and (end == len(ids) or ids[end] != ids[end - distance])


def _stretched(ids: np.ndarray, place: int, distance: int) -> tuple[int, int]:
    """The stretch around an equal pair, word by word."""
    start, end = place, place + distance
    while start and ids[start - 1] == ids[start - 1 + distance]:
        start -= 1
    while end < len(ids) and ids[end] == ids[end - distance]:
        end += 1
    return start, end


def extended(ids: np.ndarray, rolling: Rolling, places: np.ndarray, distances: np.ndarray) -> set[tuple[int, int, int]]:
    """Start, end and distance of the maximal stretches around equal pairs that are long enough. Hashes find their ends,
    words confirm them; a hash that misled is replaced by reading the words."""
    right = _reach(rolling, places, places + distances, len(ids) - places - distances, False)
    left = _reach(rolling, places, places + distances, places.copy(), True)
    starts, ends = places - left, places + distances + right
    long = ends - starts >= np.maximum(LEAST_LENGTH, 2 * distances)
    if not long.any():
        return set()
    found = np.unique(np.stack([starts, ends, distances, np.where(long, places, 0)], axis=1)[long], axis=0)
    out: dict[tuple[int, int, int], int] = {}
    for start, end, distance, place in found.tolist():
        out.setdefault((start, end, distance), place)
    checked = set()
    for (start, end, distance), place in out.items():
        if not _agree(ids, start, end, distance):
            start, end = _stretched(ids, place, distance)
        if end - start >= max(LEAST_LENGTH, 2 * distance):
            checked.add((start, end, distance))
    return checked


def _within_known(known: list[tuple[int, int, int]], n_blocks: int, block: int) -> np.ndarray | None:
    """For each block the run of a period of at most half a block that it lies in, or -1; there is at most one."""
    runs = [(i, s, e) for i, (s, e, q) in enumerate(known) if 2 * q <= block and e - s >= block]
    if not runs:
        return None
    covered = np.full(n_blocks, -1)
    for i, s, e in runs:
        covered[-(-s // block) : e // block] = i
    return covered


def runs_of(ids: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """Start, end and smallest period of every run, by start, then period. ``longest`` bounds the words of one text."""
    n = len(ids)
    if longest < LEAST_LENGTH:
        return []
    by_word = np.argsort(ids, kind="stable")
    gap = np.full(n, n, dtype=np.int64)
    again = ids[by_word[1:]] == ids[by_word[:-1]]
    gap[by_word[:-1][again]] = (by_word[1:] - by_word[:-1])[again]
    rolling = Rolling(mixed(ids.astype(np.uint64) + np.uint64(1)))
    best: dict[tuple[int, int], int] = {}
    block, widest = SMALLEST_BLOCK, gap
    while 2 * block - 1 <= longest // 2 or block == SMALLEST_BLOCK:
        nearest = 1 if block == SMALLEST_BLOCK else 2 * block - 1
        n_blocks = n // block
        # The widest gap to the next equal word, over the words of each block; the scale before has those of its halves.
        shape = widest[: 2 * (len(widest) // 2)].reshape(-1, 2) if block > SMALLEST_BLOCK else gap[: n_blocks * block].reshape(-1, block)
        widest = shape.max(axis=1)
        numbers = np.nonzero(widest <= 4 * block - 2)[0]
        known = [(s, e, q) for (s, e), q in best.items()]
        covered = _within_known(known, n_blocks, block)
        if covered is not None:
            ends, periods = np.array([e for _, e, _ in known]), np.array([q for _, _, q in known])
            run = covered[numbers]
            # A window inside the run holds the multiples of its period and nothing else.
            numbers = numbers[(run < 0) | (numbers * block + 5 * block - 2 > ends[run])]
        if len(numbers):
            places, distances = occurrences(ids, numbers * block, block, nearest)
            if covered is not None and len(places):
                run = covered[places // block]
                told = (run >= 0) & (distances % periods[run] == 0) & (places + distances + block <= ends[run])
                places, distances = places[~told], distances[~told]
            if len(places):
                # Neighbouring blocks with one distance lie in one stretch, which the first of them stands for.
                order = np.lexsort((places, distances))
                places, distances = places[order], distances[order]
                first = np.ones(len(places), dtype=bool)
                first[1:] = (distances[1:] != distances[:-1]) | (places[1:] != places[:-1] + block)
                places, distances = places[first], distances[first]
                for start, end, distance in extended(ids, rolling, places, distances):
                    best[start, end] = min(distance, best.get((start, end), distance))
        block *= 2
    return sorted(((s, e, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def collapsed(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words stay when every run keeps its first period only."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, end, period in runs:
        change[start + period] += 1
        change[end] -= 1
    return np.cumsum(change[:n]) == 0


SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"
)
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _worked(texts: list[tuple[int | None, list[bytes]]]) -> Iterator[tuple]:
    """Id, words, runs and collapsed text of texts that are worked on together."""
    lengths = np.array([len(words) for _, words in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    together = pa.array([w for _, words in texts for w in words], pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    words_from = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.empty(int(starts[-1]), dtype=np.int64)
    rewrites = []
    for n, (doc_id, words) in enumerate(texts):
        own = together[words_from[n] : words_from[n + 1]]
        places = rewritten(len(words), doc_id)
        rewrites.append(places)
        ids[starts[n] : starts[n] + len(own)] = own if places is None else own[places]
        ids[starts[n] + len(own)] = len(together) + n
    runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_of(ids, int(lengths.max(initial=0)))
    owners = np.searchsorted(starts, [r[0] for r in found], side="right") - 1
    for owner, (start, end, period) in zip(owners.tolist(), found):
        base = int(starts[owner])
        runs[owner].append((start - base, end - base, period))
    for (doc_id, words), places, own in zip(texts, rewrites, runs):
        if places is not None:
            words = [words[i] for i in places.tolist()]
        if own:
            kept = collapsed(len(words), own)
            words_kept = [w for w, keep in zip(words, kept.tolist()) if keep]
        else:
            words_kept = words
        yield doc_id, len(words), [{"start": s, "length": e - s, "period": q} for s, e, q in own], b" ".join(words_kept)


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, ``n_words``, ``runs`` (start, length and period by start, then period) and ``collapsed``, the text without
    the repeats, for every row of ``docs``. Texts that their id makes periodic (see ``rewritten``) are judged so."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts: list[tuple[int | None, list[bytes]]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            doc_ids, counts, runs, kept = zip(*_worked(texts))
            arrays = [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(runs, RUNS), pa.array(kept, pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "runs", "collapsed"])

        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = split_words(text.as_py())
            if texts and held + len(words) > WORDS_TOGETHER:
                yield flush()
                texts, held = [], 0
            texts.append((doc_id, words))
            held += len(words) + 1
        if texts:
            yield flush()

    return map_rows(docs.select(F.col("doc_id").cast("long"), as_bytes("text")), rows, SCHEMA)


def run_digest(found: DataFrame) -> DataFrame:
    """Per document the number of runs, the longest of them, and hashes of all runs and of the collapsed text."""
    best = F.array_sort(
        "runs",
        lambda a, b: F.when(a["length"] != b["length"], F.when(a["length"] > b["length"], -1).otherwise(1))
        .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        .when(a["period"] != b["period"], F.when(a["period"] < b["period"], -1).otherwise(1))
        .otherwise(0),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    top = found.withColumn("_top", F.get(best, F.lit(0)))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_top.start").alias("start"),
        F.col("_top.length").alias("length"),
        F.col("_top.period").alias("period"),
        F.expr("1000 * _top.length div _top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

"""Periodic runs against comparing every distance."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from mapstrata.llm import periodic_runs
from mapstrata.llm.periodic_runs import find_runs, runs_of
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute_runs(x):
    """Start, end and period of all runs, by trying every period from the smallest on."""
    n, out = len(x), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_runs_fast(x):
    """The same, the places of equal words at a distance coming from arrays."""
    x, n, out = np.asarray(x), len(x), {}
    for q in range(1, n // 2 + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j + q - i >= max(12, 2 * q):
                out.setdefault((i, j + q), q)
    return sorted(((s, e, q) for (s, e), q in out.items()), key=lambda r: (r[0], r[2]))


def rewritten_words(doc_id, text):
    words = (text or "").encode().split()
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(words, runs):
    best = sorted(runs, key=lambda r: (r[0] - r[1], r[0], r[2]))[:1]
    top = [(s, e - s, q, 1000 * (e - s) // q) for s, e, q in best] or [(None,) * 4]
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *top[0], hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def composed(draw):
    letters, n, x = draw.choice([1, 2, 2, 3, 5, 20]), draw.randint(0, 200), []
    while len(x) < n:
        kind = draw.random()
        if kind < 0.4:
            x += [draw.randrange(letters) for _ in range(draw.randint(1, 20))]
        elif kind < 0.7:
            unit = [draw.randrange(letters) for _ in range(draw.randint(1, 30))]
            x += (unit * draw.randint(1, 6))[: -draw.randint(1, len(unit))] or unit
        elif x:
            i = draw.randrange(len(x))
            x += x[i : i + draw.randint(1, 60)] * draw.randint(1, 3)
    return x


@pytest.mark.parametrize("seed", range(6))
def test_runs(seed):
    draw = random.Random(seed)
    for _ in range(150):
        x = composed(draw)
        assert runs_of(np.array(x, dtype=np.int64), len(x)) == brute_runs(x)


@pytest.mark.parametrize("x", [[0] * 3000, fibonacci(2500), ([0] * 50 + [1]) * 40, list(range(700)) * 4, list(range(3000)), []])
def test_regular_texts(x):
    assert runs_of(np.array(x, dtype=np.int64), len(x)) == brute_runs_fast(x)


def test_large_blocks_take_more_primes():
    """Blocks of 2,048 words, whose sums of squared differences pass one prime."""
    draw = random.Random(8)
    unit = [draw.randrange(100_000) for _ in range(9000)]
    x = [200_001, *unit, *unit, *unit[:700], 200_002]
    assert runs_of(np.array(x, dtype=np.int64), len(x)) == [(1, 18_701, 9000)]


def test_transforms_are_exact():
    rng = np.random.default_rng(0)
    for block in (2, 16, 512):
        ids = rng.integers(0, 3, 40 * block)
        starts = np.arange(0, len(ids) - block, block)
        nearest = 1 if block == 2 else 2 * block - 1
        places, distances = periodic_runs.occurrences(ids, starts, block, nearest)
        expected = {
            (s, d) for s in starts for d in range(nearest, 4 * block - 1)
            if s + d + block <= len(ids) and np.array_equal(ids[s : s + block], ids[s + d : s + d + block])
        }
        assert set(zip(places.tolist(), distances.tolist())) == expected


def test_misleading_hashes(monkeypatch):
    """Words decide where hashes of runs of words are equal by chance."""

    class Weak(periodic_runs.Rolling):
        def runs(self, starts, lengths):
            return super().runs(starts, lengths) & np.uint64(1)

    monkeypatch.setattr(periodic_runs, "Rolling", Weak)
    draw = random.Random(4)
    for _ in range(60):
        x = composed(draw)
        got = set(runs_of(np.array(x, dtype=np.int64), len(x)))
        assert got <= set(brute_runs(x))


def texts(seed):
    draw = random.Random(seed)
    rows = [(n, " ".join(f"w{i}" for i in composed(draw))) for n in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (103, "a " * 5000), (104, "a " * 5000), (None, "b c " * 30), (105, "ä b ä b " * 20)]
    return rows + rows[:3]


@pytest.mark.parametrize("together", [20, 400_000])
def test_documents(spark, documents, monkeypatch, together):
    monkeypatch.setattr(periodic_runs, "WORDS_TOGETHER", together)
    rows = texts(1)
    docs = documents([(i, t, "s") for i, t in rows]).withColumnRenamed("size", "runs")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in find_runs(docs).collect())
    expected = []
    for doc_id, text in rows:
        words = rewritten_words(doc_id, text)
        runs = brute_runs_fast(words) if words else []
        gone = {i for s, e, q in runs for i in range(s + q, e)}
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        expected.append((doc_id is None, doc_id or 0, len(words), [(s, e - s, q) for s, e, q in runs], kept))
    assert found == sorted(expected)


def test_empty_table(spark, documents):
    assert find_runs(documents([])).count() == 0


def test_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    expected = []
    for doc_id, text in rows:
        words = rewritten_words(doc_id, text)
        numbers = {}
        runs = brute_runs_fast([numbers.setdefault(w, len(numbers)) for w in words]) if words else []
        expected.append((doc_id, *digest(words, runs)))
    found = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF_DIR).collect()]
    assert sorted(found) == sorted(expected)
    assert sum(r[1] > 0 for r in found) > 50

"""Substring, line and near dedup against brute force."""

import collections
import difflib
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mapstrata.llm import line_dedup, near_dedup, substring_dedup
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute_repeats(rows, window):
    """rows: (doc_id, text). Kept words of each row, as the contract says it."""
    starts = collections.defaultdict(set)
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for doc_id, words in split:
        for p in range(len(words) - window + 1):
            if doc_id is not None:
                starts[b" ".join(words[p : p + window])].add(doc_id)
    out = []
    for doc_id, words in split:
        gone = set()
        for p in range(len(words) - window + 1):
            if doc_id is not None and min(starts[b" ".join(words[p : p + window])]) < doc_id:
                gone.update(range(p, p + window))
        out.append((doc_id, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def copies(seed):
    """Texts that share passages in every arrangement: copies, cuts, chains, repeats inside a text, very long runs."""
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefghij") + str(draw.randrange(30))
    passages = [[word() for _ in range(draw.choice([8, 20, 45, 120]))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(draw.randrange(1, 6)):
            p = draw.choice(passages)
            cut = draw.randrange(len(p))
            words += draw.choice([p, p[cut:], p[:cut], [word() for _ in range(draw.randrange(30))], ["x"] * draw.randrange(60)])
        rows.append((draw.choice([i, i, i, 5, None]), draw.choice([" ", "\n"]).join(words)))
    return rows + [(200, None), (201, ""), (202, " \n "), (3, rows[7][1]), (500, " ".join(["y"] * 5000)), (501, " ".join(["y"] * 4000)), *rows[:3]]


@pytest.mark.parametrize("seed", range(5))
def test_repeats(spark, documents, seed):
    rows = copies(seed)
    found = substring_dedup.remove_repeats(documents([(i, t, "s") for i, t in rows]), window=12, node_words=4).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept.encode()) for r in found), key=key) == sorted(brute_repeats(rows, 12), key=key)


def test_no_documents(spark, documents):
    none = documents([(1, "x", "a")]).where("false")
    assert substring_dedup.remove_repeats(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.drop_near_duplicates(none).count() == 0


def test_query_repeats(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = {(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op3_substring_dedup"](spark, SF_DIR).collect()}
    assert found == {(i, n, k, hashlib.sha256(kept).hexdigest()) for i, n, k, kept in brute_repeats(rows, 50)}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 9), max_size=25), st.lists(st.integers(1, 9), max_size=25))
def test_patience_is_an_alignment(a, b):
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    if a == b:
        assert len(pairs) == len(a)


def test_patience_finds_moved_and_kept_lines():
    a, b = [1, 2, 3, 4, 5, 6, 7], [9, 1, 2, 8, 4, 5, 7]
    assert [a[i] for i, _ in line_dedup.patience(a, b)] == [1, 2, 4, 5, 7]
    assert [i for i, _ in line_dedup.patience(list(range(1, 300)), list(range(1, 300)))] == list(range(299))


def brute_lines(rows, least):
    """rows: (doc_id, text) with distinct pairs; all pairs of documents that share a line, aligned one by one."""
    docs = sorted({(line_dedup.LAST if i is None else i, t) for i, t in rows if t is not None}, key=lambda d: d[0])
    numbers = {}
    ids = lambda t: [numbers.setdefault(x, len(numbers) + 1) if x.split() else 0 for x in t.split("\n")]
    lines = {d: ids(d[1]) for d in docs}
    holders = collections.defaultdict(list)
    for d in docs:
        for x in set(lines[d]) - {0}:
            holders[x].append(d)
    pairs = set()
    for held in holders.values():
        pairs |= {(b, a) for i, a in enumerate(held) for b in held[i + 1 :]}
    gone = collections.defaultdict(set)
    for later, earlier in pairs:
        sizes = [len(x.split()) for x in later[1].split("\n")]
        gone[later] |= set(line_dedup.common_lines(lines[later], sizes, lines[earlier], least))
    out = []
    for i, t in rows:
        cut = gone.get((line_dedup.LAST if i is None else i, t), set())
        out.append((i, t if not cut else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut), len(cut)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_lines(spark, documents, monkeypatch, seed):
    monkeypatch.setattr(line_dedup, "RARE", 5)
    draw = random.Random(seed)
    pool = [" ".join(f"{k}w{j}" for j in range(draw.choice([1, 2, 6, 9]))) for k in range(40)] + ["", "  ", "\t"]
    rows = [(i if i % 17 else None, "\n".join(draw.choice([*pool, *pool[:3] * 8]) for _ in range(draw.randrange(1, 12)))) for i in range(1, 140)]
    rows = [r for k, r in enumerate(rows) if r[0] is not None or k < 20]  # one row without id: their order is by hash
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, None), (303, ""), (304, "\n".join(f"line number {i} is long enough" for i in range(3000))), rows[5]]
    found = line_dedup.dedup_lines(documents([(i, t, "s") for i, t in rows])).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text, r["__removed"]) for r in found), key=key) == sorted(brute_lines(rows, 5), key=key)
    assert found[0]["size"] == "x"


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("rare", [1, 3, 16])
def test_common_lines_align_with_every_earlier_document(spark, documents, monkeypatch, seed, rare):
    draw = random.Random(seed)
    monkeypatch.setattr(line_dedup, "RARE", rare)
    pool = [" ".join(f"{k}w{j}" for j in range(draw.choice([1, 2, 3, 6]))) for k in range(draw.choice([6, 12, 40]))]
    own = lambda i: [f"{i} has a line that nobody else has {draw.random()}"]
    rows = []
    for i in range(1, 150):
        lines = [x for _ in range(draw.randrange(1, 9)) for x in draw.choice([[draw.choice(pool)], [draw.choice(pool)], own(i), [""], pool[:3], pool[3:5][::-1]])]
        rows.append((i, "\n".join(lines)))
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, "")]
    found = line_dedup.dedup_lines(documents([(i, t, "s") for i, t in rows])).collect()
    assert {(r.doc_id, r.text, r["__removed"]) for r in found} == set(brute_lines(rows, 5))


@pytest.mark.parametrize("first", ["B\nA", "A\nx\nA", "A", "A\nx\nB"])
def test_first_holder_that_does_not_align(spark, documents, first):
    """The first of 30 holders has the lines crossed, twice, in part, or apart; the second aligns with all others."""
    lines = {"A": "three words here", "B": "and three more", "x": "another line of six words altogether"}
    text = lambda s, i: "\n".join([f"begin {i} of a text of its own", *(lines[c] for c in s.split("\n")), f"end {i} of a text of its own"])
    rows = [(0, text(first, 0)), *((i, text("A\nB", i)) for i in range(1, 30))]
    found = line_dedup.dedup_lines(documents([(i, t, "s") for i, t in rows])).collect()
    assert {r.doc_id: r["__removed"] for r in found} == {0: 0, 1: 0, **{i: 2 for i in range(2, 30)}}
    assert {(r.doc_id, r.text, r["__removed"]) for r in found} == set(brute_lines(rows, 5))


def test_query_lines_whole(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = {(r.doc_id, r.n_removed, r.kept_md5) for r in QUERIES["op6_line_dedup"](spark, SF_DIR).collect()}
    assert found == {(i, n, hashlib.md5(t.encode()).hexdigest()) for i, t, n in brute_lines(rows, line_dedup.LEAST_WORDS)}


def test_aligned_lines_agree_with_difflib_on_unique_lines():
    draw = random.Random(1)
    for _ in range(50):
        a = draw.sample(range(1, 100), 30)
        b = [x for x in a if draw.random() < 0.7] + draw.sample(range(100, 130), 5)
        blocks = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        assert len(line_dedup.patience(a, b)) >= sum(m.size for m in blocks)


def brute_classes(rows):
    """Components of all pairs of weighted Jaccard similarity 0.8 or more, by plain dictionaries."""
    texts = sorted({tuple((t or "").encode().split()) for _, t in rows} - {()})
    n = sum(bool((t or "").split()) for _, t in rows)
    df = collections.Counter(w for _, t in rows for w in set((t or "").encode().split()))
    idf = lambda k: 1 + np.log((n + 1) / (k + 1))
    value = {w: idf(k) for w, k in df.items()}
    sets = []
    for words in texts:
        width = min(5, len(words))
        weights = collections.Counter()
        for p in range(len(words) - width + 1):
            weights[words[p : p + width]] += sum(value[w] for w in words[p : p + width]) / width
        sets.append(weights)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            where[x].append(k)
    for pair in {(a, b) for held in where.values() for a in held for b in held if a < b}:
        a, b = (sets[k] for k in pair)
        both = sum(min(v, b[x]) for x, v in a.items())
        if both >= 0.8 * (sum(a.values()) + sum(b.values()) - both):
            parent[find(pair[0])] = find(pair[1])
    at = {t: k for k, t in enumerate(texts)}
    first = {}
    for i, t in rows:
        words = tuple((t or "").encode().split())
        if words and i is not None:
            c = find(at[words])
            first[c] = min(first.get(c, i), i)
    out = []
    for i, t in rows:
        words = tuple((t or "").encode().split())
        out.append((i, first.get(find(at[words])) if words else i))
    return out


def near_rows(seed):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefgh") + str(draw.randrange(200))
    rows = []
    for _ in range(25):
        base = [word() for _ in range(draw.choice([3, 4, 6, 60, 300]))]
        for _ in range(draw.randrange(1, 12)):
            other = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, len(base) // 40, len(base) // 6])):
                other[draw.randrange(len(other))] = word()
            rows.append((len(rows), draw.choice([" ", "\n "]).join(other)))
    chain = [word() for _ in range(400)]
    for _ in range(30):  # each like the one before it, the first unlike the last
        at = draw.randrange(390)
        chain = chain[:at] + [word() for _ in range(6)] + chain[at + 6 :]
        rows.append((len(rows), " ".join(chain)))
    return rows + [(900, None), (901, ""), (902, " \n"), (None, rows[4][1]), (None, "only here without id"), (903, "z " * 9000), (904, "z " * 9100), rows[6], (6, rows[9][1])]


@pytest.mark.parametrize("seed, table", [(0, 1 << 22), (1, 1 << 22), (2, 300), (3, 0)])
def test_near_duplicates(spark, documents, monkeypatch, seed, table):
    """Counts of words in a table, some of them, and all of them with the texts."""
    monkeypatch.setattr(near_dedup, "TABLE", table)
    monkeypatch.setattr(near_dedup, "BUCKET_BYTES", 20_000)
    rows = near_rows(seed)
    found = near_dedup.near_duplicates(documents([(i, t, "s") for i, t in rows])).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)
    assert sorted(((r.doc_id, r.class_id) for r in found), key=key) == sorted(brute_classes(rows), key=key)


def test_one_of_each_class_stays(spark, documents):
    rows = near_rows(7)
    docs = documents([(i, t, "s") for i, t in rows])
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    classes = {c for (i, t), (_, c) in zip(rows, brute_classes(rows)) if t and t.split()}
    assert ids.keys() == classes | {900, 901, 902} and max(ids.values()) == 1


@pytest.mark.parametrize("table", [1 << 22, 2000])
def test_query_near_duplicates(spark, monkeypatch, table):
    monkeypatch.setattr(near_dedup, "TABLE", table)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = {(r.doc_id, r.class_id) for r in QUERIES["op1_near_dedup"](spark, SF_DIR).collect()}
    assert found == set(brute_classes(rows))


def test_hashes_of_words():
    draw = random.Random(4)
    texts = [bytes(draw.choice(b"ab\xc3\xa9 \t\n\x0b\r\x1c\x00") for _ in range(draw.randrange(40))) for _ in range(500)]
    texts += [b"x" * 1000 + b" " + b"x" * 999, b"", b" ", b"a" * 300]
    known = {}
    for text in texts:
        hashes = near_dedup.words_of(text).tolist()
        assert len(hashes) == len(text.split())
        for word, value in zip(text.split(), hashes):
            assert known.setdefault(word, value) == value
    assert len(set(known.values())) == len(known) > 500 and not len(near_dedup.words_of(None))


def test_samples_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    sampler = near_dedup.Sampler()
    agree, expected = [], []
    for _ in range(300):
        shingles = np.unique(draw.integers(0, 1 << 63, 400).astype(np.uint64))
        a, b = draw.uniform(1, 6, len(shingles)), draw.uniform(1, 6, len(shingles))
        expected.append(near_dedup.weighted_jaccard((shingles, a), (shingles, b)) ** near_dedup.ROWS)
        agree.append((sampler.bands(shingles, a) == sampler.bands(shingles, b)).mean())
    assert np.mean(agree) == pytest.approx(np.mean(expected), abs=0.02)


@pytest.mark.parametrize("block", [3, 16])
def test_blocks_of_a_bucket_lose_no_link(spark, documents, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rows = near_rows(11) + [(i + 2000, t) for i, t in near_rows(12) if i is not None]
    found = near_dedup.near_duplicates(documents([(i, t, "s") for i, t in rows])).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)
    assert sorted(((r.doc_id, r.class_id) for r in found), key=key) == sorted(brute_classes(rows), key=key)


def plain_samples(sampler, shingles, weights):
    """Every shingle of every sample computed in full."""
    bits = (shingles * sampler.factors).view(np.uint16).reshape(len(sampler.factors), len(shingles), 4)
    beta, r = bits[:, :, 1] * np.float32(2**-16), sampler.r[bits[:, :, 3]]
    t = np.floor(np.log(weights).astype(np.float32) / r + beta)
    log_a = (beta - t - 1) * r + sampler.log_c[bits[:, :, 2]]
    i, row = log_a.argmin(axis=1), np.arange(len(log_a))
    return shingles[i], t[row, i]


@pytest.mark.parametrize("n", [0, 1, 2, 511, 1024, 5000])
def test_samples_of_likely_shingles_are_those_of_all(n):
    sampler, rng = near_dedup.Sampler(), np.random.default_rng(n)
    shingles = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
    for weights in (np.ones(n), rng.lognormal(0, 3, n), rng.lognormal(8, 1, n)):
        pick, level = sampler.samples(shingles, weights)
        if n:
            expected = plain_samples(sampler, shingles, weights)
            assert (pick == expected[0]).all() and (level == expected[1]).all()
        assert (sampler.keys(np.array([pick, pick]), np.array([level, level])) == sampler.bands(shingles, weights)).all()


@pytest.mark.parametrize("known", [[], [0], [5, 6, 7], range(40), [0, 1 << 63, (1 << 64) - 1], np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64)])
def test_places_by_first_bits_equal_a_search(known):
    known = np.unique(np.array(list(known), np.uint64))
    asked = np.concatenate([known, known + np.uint64(1), np.random.default_rng(2).integers(0, 1 << 64, 1000, dtype=np.uint64)])
    at, found = near_dedup.Places(known)(asked)
    expected, there = near_dedup.places(known, asked)
    assert (found == there).all() and (at[found] == expected[found]).all()


def test_a_worker_holds_the_places_of_one_table():
    first, second = (near_dedup.Weights(9, np.array(words, np.uint64), np.array([5, 6])) for words in ([3, 4], [4, 8]))
    asked = np.array([8, 4, 3], np.uint64)
    for _ in range(2):
        assert first.documents(asked, b"").tolist() == [1, 6, 5]
        assert second.documents(asked, b"").tolist() == [6, 5, 1]
    assert list(near_dedup.worker_state("words places", dict)) == [second.name]


def test_texts_are_found_by_the_hash_of_their_row(documents):
    rows = [(1, "a b c", "x"), (1, "a  b c", "x"), (None, "a b c", "x"), (2, "d", None), (3, None, "x")]
    docs = documents(rows)
    named = near_dedup._named(docs).where("doc_id is null or text = 'd'")
    wanted = named.select(F.concat(F.lit("p"), "text").cast("binary").alias("print"), "doc_id", "row", F.lit(b"").alias("own"))
    found = near_dedup._texts_of(docs, wanted)
    assert sorted((bytes(r["print"]), bytes(r["text"])) for r in found.collect()) == [(b"pa b c", b"a b c"), (b"pd", b"d")]
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()

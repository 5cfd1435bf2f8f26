"""Nearest neighbours against brute force, the classifier on held-out rows."""

import zlib

import numpy as np
import pytest

from mapstrata.llm import ann, quality_classifier
from mapstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute_nearest(rows, wanted, k):
    """rows: (id, vector). Per id of ``wanted`` its (id, score) list."""
    rows = {(i, tuple(map(float, v))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, vector in rows:
        if q in wanted:
            scores = [(-float(np.dot(vector, v)), i) for i, v in rows if i != q and len(v) == len(vector)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def test_all_found_when_everything_is_reranked(spark):
    draw = np.random.default_rng(0)
    rows = [(i, draw.integers(-3, 4, 6).astype(float).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(300)]  # copies, and ties among the rest
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [None] + [1.0] * 5), (2004, [float("nan")] * 6), (2005, [float("inf")] * 6)]
    rows += [(None, [1.0] * 6), (2010, [1.0, 2.0]), (2020, [2.0, 1.0]), (2030, [1.0, 0.0, 0.0, 1.0]), rows[5]]
    df = spark.createDataFrame(rows, "id long, vector array<float>").repartition(4)
    wanted = {i for i, _ in rows if i is not None and i % 10 == 0}
    found = {}
    for r in sorted(ann.search(df, df.where("id % 10 = 0"), k=9, share=1.0).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.id, r.score))
    expected = {q: v for q, v in brute_nearest(rows, wanted, 9).items() if v}
    assert found == expected


def test_lengths_without_pivots_are_searched_whole(spark):
    draw = np.random.default_rng(1)
    rows = [(d * 10_000 + i, draw.normal(size=d).tolist()) for d in (3, 4, 5, 6, 7) for i in range(2010 if d < 7 else 2000)]
    df = spark.createDataFrame(rows, "id long, vector array<double>").repartition(4)
    found = {}
    for r in sorted(ann.search(df, df.where("id >= 70000 and id % 100 = 0"), k=9).collect(), key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append(r.id)
    expected = brute_nearest(rows[-2000:], set(range(70_000, 72_000, 100)), 9)
    assert found == {q: [i for i, _ in v] for q, v in expected.items()}


def test_no_vectors(spark):
    df = spark.createDataFrame([], "id long, vector array<float>")
    assert ann.search(df, df).count() == 0


@pytest.mark.parametrize(("prefix", "share"), [(20, 0.3), (60, 0.1), (20, 1.0)])
def test_postings_follow_the_footrule_distance(monkeypatch, prefix, share):
    """Against sums over ranks written out, with tied scores and vectors that are always reranked."""
    monkeypatch.setattr(ann, "LEAST_RERANKED", 5)
    rng = np.random.default_rng(9)
    vectors = rng.integers(-2, 3, size=(400, 6)).astype(float)
    pivots, ids = rng.normal(size=(60, 6)), rng.permutation(400)
    always = rng.random(400) < 0.02
    block = ann.Postings(ids, vectors, always, pivots, prefix)
    queries = rng.normal(size=(20, 6))
    orders = ann.nearest_ranks(vectors, pivots, prefix).astype(int)
    for query, ranks in zip(queries, ann.nearest_ranks(queries, pivots, prefix)):
        at, scores = block.nearest(query, ranks, share, 21)
        sums = (prefix - np.maximum(orders, ranks.astype(int))).sum(axis=1)
        least = np.sort(sums)[::-1][int(np.ceil(share * 400)) - 1]
        products = vectors @ query
        assert np.allclose(scores, products[at]) and len(set(at)) == 21
        assert list(zip(-scores, ids[at])) == sorted(zip(-scores, ids[at]))
        assert all(sums[i] >= least or always[i] for i in at)
        left = [i for i in range(400) if (sums[i] > least or always[i]) and i not in at]
        assert all(products[i] <= scores[-1] + 1e-9 for i in left)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_query_recall(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
    found = {}
    for r in QUERIES["op8_nearest_neighbours"](spark, folder).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert found.keys() == {i for i in ids.tolist() if i % 20 == 0}
    recall = []
    for q, answers in found.items():
        scores = x @ x[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -scores))].tolist() if i != q][:20]
        got = [answers[k] for k in range(1, 21)]
        assert got == sorted(got, key=lambda a: (-a[1], a[0]))
        assert all(s == pytest.approx(scores[ids == i][0], abs=1e-12) for i, s in got)
        recall.append(len(set(best) & {i for i, _ in got}) / 20)
    assert np.mean(recall) >= 0.95


@pytest.mark.parametrize("spread", [1.0, 0.2, 0.02])
def test_recall_over_several_blocks(spark, monkeypatch, spread):
    """Directions of one length around a common one, in three blocks of more than 2,000 each."""
    monkeypatch.setattr(ann, "BLOCK", 2600)
    draw = np.random.default_rng(2)
    x = draw.normal(size=(7500, 64)) * spread + draw.normal(size=64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vector array<double>").repartition(4)
    found = {}
    for r in ann.search(df, df.where("id % 100 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.id)
    best = {q: set([i for i in np.argsort(-(x @ x[q])).tolist() if i != q][:20]) for q in range(0, 7500, 100)}
    recall = np.mean([len(best[q] & found[q]) / 20 for q in best])
    print("recall", spread, recall)
    assert recall >= 0.95


def test_classifier_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op2_quality_classifier"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == y for p, y in held]) > 0.97


def test_held_out_labels_are_not_used(spark):
    docs = quality_classifier.described(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    one, two = (quality_classifier.fit(docs, x.repartition(5)) for x in (labels, flipped))
    assert (one.weights == two.weights).all() and (one.levels == two.levels).all()


def test_odd_rows(spark, documents):
    docs = documents([(1, None, "a"), (2, "", "a"), (None, "some words", "a"), (3, "w " * 100_000, "b"), (3, "!", "b")])
    stats = quality_classifier.described(docs)
    none = quality_classifier.fit(stats, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.score for r in quality_classifier.scored(stats, none).collect()} == {0.5}
    some = quality_classifier.fit(stats, spark.createDataFrame([(1, 0), (2, 0), (3, 1), (3, 1), (3, None), (None, 1), (4, 7)], "doc_id long, quality int"))
    rows = quality_classifier.scored(stats, some).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows) and all(r.held_out is False for r in rows if r.doc_id is None)
    assert quality_classifier.scored(quality_classifier.described(docs.where("false")), some).count() == 0


def test_isotonic():
    levels = quality_classifier.isotonic(np.array([1.0, 2, 1, 1]), np.array([0.0, 0.6, 0.3, 1.0]))
    assert levels.tolist() == pytest.approx([0, 0.5, 0.5, 1])

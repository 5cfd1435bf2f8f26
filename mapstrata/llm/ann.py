"""Approximate nearest neighbours by a permutation index.

Every vector is represented by the order of its nearest pivots. Rows are dealt over blocks; a block posts its vectors in
one inverted file per pivot, as the ranks of that pivot in their orders. A query adds up, over the files of its own
nearest pivots, what the ranks say about the footrule distance, keeps the ``RERANK`` share of the block, and at least
``LEAST_RERANKED`` vectors, with the smallest distance, and reranks it by the inner product of the original vectors in double precision. A vector that stands
for half as many ids as a query wants, or more, is always reranked: to miss it would cost that many answers.

Pivots are a bounded sample: the ``PIVOTS`` distinct vectors with the smallest hashes, of each of the four most frequent
lengths. Every vector is indexed; a block of vectors of another length is reranked whole.
Equal vectors are one vector in the index and stand for their ids afterwards; a query needs no more than the
``k + 1`` smallest ids of each, so no list grows with the copies.

Vectors that are null, empty or zero, or hold null or non-finite components, take no part, nor do rows without id. Vectors
of different lengths are not compared. Repeated rows count once; a query never returns its own id. Ties go to smaller
ids. An empty table gives no row. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mapstrata.session import cut_lineage

PIVOTS, PREFIX, RERANK = 256, 128, 0.3
LEAST_RERANKED = 512
BLOCK, QUERY_BLOCK = 16384, 512


def usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) of the rows that take part, vectors as doubles."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    vectors = vectors.select("id", F.col("vector").cast("array<double>").alias("vector"))
    return vectors.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite & some, F.lit(False))).distinct()


def nearest_ranks(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Rank of each pivot in the order of each vector, nearest first; ``prefix`` for all beyond."""
    order = np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :prefix]
    ranks = np.full((len(vectors), len(pivots)), prefix, dtype=np.int16)
    np.put_along_axis(ranks, order, np.arange(order.shape[1], dtype=np.int16)[None, :], axis=1)
    return ranks


class Postings:
    """The inverted files of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, always: np.ndarray, pivots: np.ndarray, prefix: int) -> None:
        self.ids, self.vectors, self.always, self.prefix = ids, vectors, np.flatnonzero(always), prefix
        # file of pivot p: by how much p's rank in each vector's order lies before the prefix ends
        self.files = np.ascontiguousarray((prefix - nearest_ranks(vectors, pivots, prefix)).T)

    def nearest(self, query: np.ndarray, ranks: np.ndarray, share: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and scores of the ``k`` best, best first. The footrule distance of two prefixes is
        L (L + 1) - 2 sum(L - max(rank, rank')) over the pivots of both, so the largest sums are nearest."""
        near = np.flatnonzero(ranks < self.prefix)
        # the ranks of one order differ, so that all files together add up to L (L + 1) / 2 at most
        sums = np.zeros(len(self.ids), dtype=np.int16 if self.prefix <= 255 else np.int32)
        level, least = np.empty_like(self.files[0]), np.empty_like(self.files[0])
        for p, ahead in zip(near.tolist(), (self.prefix - ranks[near]).tolist()):
            level.fill(ahead)  # the minimum of two arrays takes a quarter of that of an array and a number
            np.minimum(self.files[p], level, out=least)
            np.add(sums, least, out=sums)
        keep = max(k, LEAST_RERANKED, int(np.ceil(share * len(sums))))
        reranked = np.ones(len(sums), dtype=bool)
        if keep < len(sums):
            reranked[:] = False
            reranked[np.argpartition(-sums.astype(np.int32), keep - 1)[:keep]] = True
            reranked[self.always] = True
        best = np.flatnonzero(reranked)
        scores = np.einsum("ij,j->i", self.vectors[best], query)
        if k < len(scores):  # only what may be among the best is put in order; not a number comes last
            some = np.flatnonzero(~(-scores > np.partition(-scores, k - 1)[k - 1]))
            best, scores = best[some], scores[some]
        order = np.lexsort((self.ids[best], -scores))[:k]
        return best[order], scores[order]


def _searching(pivots: dict[int, np.ndarray], prefix: int, share: float, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def stacked(table: pa.Table, column: str) -> np.ndarray:
        flat = table.column(column).combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(left) and len(right):
            vectors, queries = stacked(left, "vector"), stacked(right, "vector")
            ids, query_ids = left.column("rep").to_numpy(), right.column("query").to_numpy()
            own = pivots.get(vectors.shape[1], vectors[:1])
            part = share if vectors.shape[1] in pivots else 1.0  # without pivots, all are reranked
            length = min(prefix, len(own))
            always = left.column("copies").to_numpy() * 2 >= k
            block = Postings(ids, vectors, always, own, length)
            for query_id, query, ranks in zip(query_ids, queries, nearest_ranks(queries, own, length)):
                at, scores = block.nearest(query, ranks, part, k)
                out.append((np.full(len(at), query_id), ids[at], scores))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table(dict(zip(["query", "rep", "score"], map(pa.array, columns))))

    return search


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    share: float = RERANK,
) -> DataFrame:
    """(query_id, rank, id, score): for every row of ``queries`` the ``k`` rows of ``vectors`` found nearest, without the
    query's own. Both have the columns id and vector, a number and an array of numbers."""
    vectors, queries = usable(vectors), usable(queries)
    first = Window.partitionBy("vector").orderBy("id")
    some = vectors.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    grouped = some.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    distinct = cut_lineage(grouped.select(F.col("ids")[0].alias("rep"), "vector", "ids", F.size("vector").alias("dim")))
    # one query a distinct vector, named by a number of its own
    asked = cut_lineage(queries.groupBy("vector").agg(F.min("id").alias("query")))
    n_vectors, n_queries = distinct.count(), asked.count()
    blocks, query_blocks = max(1, -(-n_vectors // BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))

    hashed = distinct.select("dim", "vector", F.xxhash64("vector").alias("h"))
    by_hash = Window.partitionBy("dim").orderBy("h")
    sample = hashed.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= pivots)
    # vectors of the most frequent lengths only, so that the sample stays bounded whatever the lengths are
    lengths = [r["dim"] for r in distinct.groupBy("dim").count().orderBy(F.desc("count"), "dim").limit(4).collect()]
    table = sample.where(F.col("dim").isin(lengths) if lengths else F.lit(False)).select("dim", "vector").collect()
    chosen = {d: np.array([r["vector"] for r in table if r["dim"] == d]) for d in lengths}

    def dealt(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")

    left = distinct.select(
        "dim", "rep", "vector", F.size("ids").alias("copies"), dealt("rep", blocks).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block")
    )
    right = asked.select(
        F.size("vector").alias("dim"), "query", "vector", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        dealt("query", query_blocks).alias("query_block"),
    )
    keys = ["dim", "block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        _searching(chosen, prefix, share, k + 1), "query long, rep long, score double"
    )

    def best(df: DataFrame, group: str, column: str, n: int) -> DataFrame:
        w = Window.partitionBy(group).orderBy(F.desc("score"), column)
        return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)

    merged = best(found, "query", "rep", k + 1).drop("rank")
    named = merged.join(distinct.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("id"))
    named = cut_lineage(best(named, "query", "id", k + 1).drop("rank"))
    each = queries.join(asked, "vector").select(F.col("id").alias("query_id"), "query")
    pairs = each.join(named, "query").where("id <> query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return best(pairs, "query_id", "id", k).select("query_id", "rank", "id", "score")

"""Exact top-k by inner product with the threshold algorithm over sorted lists.

Candidates are dealt over blocks, queries too, and every block of queries meets every block of
candidates. A block keeps one list per dimension, sorted by that component. For a query all lists are
read from the end that its sign prefers, some rows deeper each round; vectors seen anywhere are scored in
full, and what the components at the current depth would give together bounds all unseen ones. Reading
stops when the kth score found beats that bound, ties included.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from cellframe.llm.vectors import best, candidates, for_queries, valid_vectors, vector_key
from cellframe.session import write_through

BLOCK, QUERY_BLOCK = 2048, 1024
FIRST_DEPTH = 16


class SortedLists:
    """Vectors of one block with a list per dimension. Ids ascend, so that ties go to smaller ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.lists = np.argsort(self.vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(self.vectors, self.lists, axis=0)
        self.most = int(np.abs(self.vectors).max(initial=0))
        # Sums of products below 2^53 are exact in doubles, and those are multiplied faster.
        self.doubles = self.vectors.astype(np.float64)

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if self.most * int(np.abs(query).max(initial=0)) * len(query) < 1 << 53:
            return (self.doubles[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ query

    def top(self, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best, best first."""
        n = len(self.ids)
        high, low = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, before = min(FIRST_DEPTH, n), 0
        while True:
            new = np.zeros(n, bool)
            new[self.lists[n - depth:n - before][:, high]] = True
            new[self.lists[before:depth][:, low]] = True
            if depth == n:
                new[:] = True
            fresh = np.flatnonzero(new & ~seen)
            seen |= new
            rows = np.concatenate([rows, fresh])
            scores = np.concatenate([scores, self.scores(query, fresh)])
            if len(rows) > k:
                keep = np.lexsort((rows, -scores))[:k]
                rows, scores = rows[keep], scores[keep]
            bound = int(query[high] @ self.values[n - depth, high] + query[low] @ self.values[depth - 1, low])
            if depth == n or seen.all() or len(rows) == k and scores.min() > bound:
                order = np.lexsort((rows, -scores))
                return self.ids[rows[order]], scores[order]
            depth, before = min(n, depth * 2), depth


def top_inner_products(rows: DataFrame, is_query, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query selects, the k best of all others.

    Components are floor(scale * x). Equal vectors are searched once, and of equal candidates only the
    k + 1 with the smallest ids can matter. Ties go to the smaller vec_id. See valid_vectors for what takes
    no part: null or non-finite vectors, rows without id, other lengths; a repeated id counts once. Fewer
    than k others give fewer rows; an empty table gives an empty result. Other columns are ignored.
    """
    vectors = write_through(valid_vectors(rows, lambda x: F.floor(x * scale).cast("long")), "vectors")
    held = write_through(candidates(vectors, k + 1), "candidates")
    queries = write_through(vectors.where(is_query).select("vec_id", "vector", vector_key().alias("key")), "queries")
    asked = write_through(queries.groupBy("key").agg(F.min("vector").alias("vector")), "asked")
    blocks = max(1, -(-held.count() // BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = held.select(
        "vec_id", "vector", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"))
    asking = asked.select(
        "key", "vector", F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int").alias("query_block"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def search(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        keys, ids, scores = [], [], []
        if len(held) and len(asking):
            lists = SortedLists(held.vec_id.to_numpy(), np.stack(held.vector.to_list()).astype(np.int64))
            for key, query in zip(asking.key, asking.vector):
                found, score = lists.top(np.asarray(query, np.int64), k + 1)
                keys += [key] * len(found)
                ids.append(found)
                scores.append(score)
        return pd.DataFrame({"key": np.array(keys, object), "vec_id": np.concatenate([np.empty(0, np.int64), *ids]),
                             "score": np.concatenate([np.empty(0, np.int64), *scores])})

    by = ["block", "query_block"]
    found = dealt.groupBy(*by).cogroup(asking.groupBy(*by)).applyInPandas(search, "key string, vec_id long, score long")
    results = write_through(best(found, k + 1), "results")
    return for_queries(queries.select("vec_id", "key"), results, k)

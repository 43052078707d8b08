"""Approximate nearest neighbours by cosine over balanced posting lists.

Centroids come from splitting a bounded sample again and again into clusters of about equal size, as many
as the table needs for lists of `LIST` vectors. Every vector goes into the list of its nearest centroid
and, near a border, into further lists: those whose centroid is hardly further away and not closer to a
centroid already taken. Centroids are found by best-first search in a graph of their neighbours, which
every task holds in memory (at most `MOST_CENTROIDS`, a fixed bound). A query opens the lists whose
centroids are within a ratio of the nearest one's distance, and compares itself with all their vectors.

Fitted on at most `SAMPLE` vectors, drawn by a hash of the id; every vector is indexed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellframe.llm.vectors import best, candidates, for_queries, valid_vectors, vector_key
from cellframe.session import write_through

SAMPLE, MOST_CENTROIDS, LIST = 100_000, 1 << 16, 128
REPLICAS, REPLICA_RATIO = 6, 1.15
PROBES, PROBE_RATIO, LEAST_OPENED = 64, 1.35, 1024
DEGREE, BEAM = 24, 96
BLOCK = 4096
#: Rows searched at a time: each holds the vectors of about a hundred centroids.
ROWS = 512


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _split(x: np.ndarray, parts: int, draw: np.random.Generator) -> np.ndarray:
    """Cluster of each row; clusters are held near equal size by a growing price on the full ones."""
    centroids = x[draw.choice(len(x), parts, replace=False)]
    price = np.zeros(parts)
    for _ in range(10):
        near = (((x[:, None] - centroids) ** 2).sum(axis=2) if len(x) * parts < 4096 else
                2 - 2 * x @ centroids.T).__add__(price).argmin(axis=1)
        sizes = np.bincount(near, minlength=parts)
        price += 0.05 * (sizes * parts / len(x) - 1)
        for c in np.flatnonzero(sizes):
            mean = x[near == c].mean(axis=0)
            centroids[c] = mean / max(np.linalg.norm(mean), 1e-12)
    return near


def balanced_centroids(x: np.ndarray, count: int, seed: int = 5) -> np.ndarray:
    """About `count` unit centroids of unit rows."""
    draw = np.random.default_rng(seed)
    size, todo, done = max(1.0, len(x) / count), [np.arange(len(x))], []
    while todo:
        rows = todo.pop()
        parts = min(16, round(len(rows) / size), len(rows))
        near = _split(x[rows], parts, draw) if parts > 1 else np.zeros(len(rows), int)
        found = [rows[near == c] for c in range(max(1, parts)) if (near == c).any()]
        if len(found) == 1 or parts < 2:
            mean = x[rows].mean(axis=0)
            done.append(mean / np.linalg.norm(mean) if np.linalg.norm(mean) > 1e-9 else x[rows[0]])
        else:
            todo += found
    return np.array(done)


@dataclass
class CentroidGraph:
    """Unit centroids, the neighbours of each, and the entries where a search begins."""

    centroids: np.ndarray
    neighbours: np.ndarray
    entries: np.ndarray

    @staticmethod
    def of(centroids: np.ndarray, seed: int = 5) -> "CentroidGraph":
        n, draw = len(centroids), np.random.default_rng(seed)
        near = min(DEGREE, n - 1)
        links = [np.argpartition(-(centroids[at:at + 1024] @ centroids.T), near, axis=1)[:, :near + 1]
                 for at in range(0, n, 1024)] if n > 1 else [np.zeros((1, 1), int)]
        # A few links at random keep distant parts within reach of each other.
        far = draw.integers(0, n, (n, 4))
        return CentroidGraph(centroids, np.c_[np.concatenate(links), far], draw.permutation(n)[:max(1, int(n ** 0.5))])

    def search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, distances), nearest first, about the `width` nearest of each unit row."""
        parts = [self._search(x[at:at + ROWS], width) for at in range(0, len(x), ROWS)]
        ids, distances = zip(*parts)
        return np.concatenate(ids), np.concatenate(distances)

    def _search(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first for all rows at once: in each round every row opens its nearest unopened centroids."""
        n, m = len(self.centroids), len(x)
        width = min(width, n)
        held = np.full((m, width), -1)
        score = np.full((m, width), -np.inf)
        opened = np.zeros((m, width), bool)
        new = np.broadcast_to(self.entries, (m, len(self.entries)))
        while True:
            value = np.einsum("md,mcd->mc", x, self.centroids[new])
            ids = np.concatenate([held, new], axis=1)
            value = np.concatenate([score, value], axis=1)
            known = np.concatenate([opened, np.zeros(new.shape, bool)], axis=1)
            # One place for each centroid, the opened one if there is one.
            order = np.lexsort((~known, ids), axis=1)
            ids, value, known = (np.take_along_axis(c, order, 1) for c in (ids, value, known))
            value[:, 1:][ids[:, 1:] == ids[:, :-1]] = -np.inf
            order = np.argsort(-value, axis=1, kind="stable")[:, :width]
            held, score, opened = (np.take_along_axis(c, order, 1) for c in (ids, value, known))
            waiting = ~opened & np.isfinite(score)
            if not waiting.any():
                return held, np.sqrt(np.maximum(0, 2 - 2 * score))
            pick = np.argsort(~waiting, axis=1, kind="stable")[:, :4]
            np.put_along_axis(opened, pick, True, axis=1)
            new = self.neighbours[np.take_along_axis(held, pick, 1)].reshape(m, -1)

    def lists_of(self, x: np.ndarray) -> list[list[int]]:
        """The lists that hold each row."""
        ids, distances = self.search(x, max(BEAM // 3, REPLICAS))
        out = []
        for row, near in zip(ids, distances):
            taken: list[int] = []
            for c, d in zip(row, near):
                if not np.isfinite(d) or c < 0 or len(taken) == REPLICAS or taken and d > REPLICA_RATIO * near[0]:
                    break
                gaps = self.centroids[taken] @ self.centroids[c] if taken else np.empty(0)
                if not taken or (np.sqrt(np.maximum(0, 2 - 2 * gaps)) >= d).all():
                    taken.append(int(c))
            out.append(taken)
        return out

    def opened_by(self, x: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
        """The lists that each query opens: within the ratio, and at least so many vectors' worth."""
        ids, distances = self.search(x, BEAM)
        out = []
        for row, near in zip(ids, distances):
            taken, held = [], 0
            for c, d in zip(row, near):
                if c < 0 or not np.isfinite(d):
                    break
                if held >= LEAST_OPENED and (d > PROBE_RATIO * near[0] or len(taken) >= PROBES):
                    break
                taken.append(int(c))
                held += int(sizes[c])
            out.append(taken)
        return out


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column]) if len(column) else np.empty((0, 0))


def fit(vectors: DataFrame, count: int) -> CentroidGraph:
    """vectors: (vec_id, vector) of unequal vectors, `count` of them."""
    draw = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 40)) / float(1 << 40)
    sample = vectors.where(draw < SAMPLE / max(count, 1)).orderBy("vec_id").select("vector").toPandas().vector
    if not len(sample):
        return CentroidGraph.of(np.ones((1, 1)))
    wanted = max(1, min(MOST_CENTROIDS, count // LIST, len(sample)))
    return CentroidGraph.of(balanced_centroids(unit(_matrix(sample)), wanted))


def nearest(rows: DataFrame, is_query, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that is_query selects, the k nearest others found.

    Score is the cosine in doubles; ties go to the smaller vec_id. Equal vectors are searched once, and of
    equal candidates the k + 1 with the smallest ids are kept, all that can matter. Zero vectors take no
    part, nor do those that valid_vectors leaves out: null or non-finite, without id, of another length; a
    repeated id counts once. With fewer than k others there are fewer rows; an empty table gives an empty
    result. Other columns are ignored.
    """
    vectors = write_through(valid_vectors(rows, lambda x: x).where(F.exists("vector", lambda x: x != 0)), "vectors")
    held = write_through(candidates(vectors, k + 1), "candidates")
    queries = write_through(vectors.where(is_query).select("vec_id", "vector", vector_key().alias("key")), "queries")
    asked = write_through(queries.groupBy("key").agg(F.min("vector").alias("vector")), "asked")
    graph = fit(held, held.count())

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                lists = graph.lists_of(unit(_matrix(batch["vector"].to_pylist())))
                at = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"].take(pa.array(at)), batch["vector"].take(pa.array(at)),
                     pa.array([c for v in lists for c in v], pa.int32())], names=["vec_id", "vector", "list"])

    placed = write_through(held.select("vec_id", "vector").mapInArrow(
        place, "vec_id long, vector array<double>, list int"), "lists")
    sizes = np.zeros(len(graph.centroids), np.int64)
    for row in placed.groupBy("list").count().collect():  # at most MOST_CENTROIDS rows
        sizes[row["list"]] = row["count"]

    def probe(batches):
        for batch in batches:
            if batch.num_rows:
                lists = graph.opened_by(unit(_matrix(batch["vector"].to_pylist())), sizes)
                jobs = [(k, c, b) for k, v in enumerate(lists) for c in v for b in range(-(-int(sizes[c]) // BLOCK))]
                at = pa.array([j[0] for j in jobs], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch["key"].take(at), batch["vector"].take(at), pa.array([j[1] for j in jobs], pa.int32()),
                     pa.array([j[2] for j in jobs], pa.int64())], names=["key", "vector", "list", "block"])

    def block_of(batches):
        for batch in batches:
            parts = -(-sizes[batch["list"].to_numpy()] // BLOCK)
            block = batch["at"].to_numpy() % np.maximum(parts, 1)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("vec_id", "vector", "list")), pa.array(block, pa.int64())],
                                             names=["vec_id", "vector", "list", "block"])

    # Long lists are dealt over blocks, and their queries go to each.
    blocks = placed.withColumn("at", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))).mapInArrow(
        block_of, "vec_id long, vector array<double>, list int, block long")
    probes = asked.mapInArrow(probe, "key string, vector array<double>, list int, block long")

    def search(held: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        keys, ids, scores = [], [np.empty(0, np.int64)], [np.empty(0)]
        if len(held) and len(asking):
            x, own = _matrix(held.vector), held.vec_id.to_numpy()
            norms = np.sqrt((x * x).sum(axis=1))
            for key, query in zip(asking.key, asking.vector):
                query = np.asarray(query, np.float64)
                score = (x * query).sum(axis=1) / (norms * np.sqrt((query * query).sum()))
                top = np.lexsort((own, -score))[:k + 1]
                keys += [key] * len(top)
                ids.append(own[top])
                scores.append(score[top])
        return pd.DataFrame({"key": np.array(keys, object), "vec_id": np.concatenate(ids), "score": np.concatenate(scores)})

    by = ["list", "block"]
    found = blocks.groupBy(*by).cogroup(probes.groupBy(*by)).applyInPandas(search, "key string, vec_id long, score double")
    results = write_through(best(found, k + 1), "results")
    return for_queries(queries.select("vec_id", "key"), results, k)

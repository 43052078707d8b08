import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellframe.llm import ann, topk
from cellframe.llm.ann import nearest
from cellframe.llm.topk import SortedLists, top_inner_products

IS_QUERY = "vec_id % 50 = 0"


@pytest.fixture(scope="module")
def vectors(spark):
    """Many copies of one vector, ties, and rows that take no part."""
    draw = np.random.default_rng(1)
    rows = [(k, [float(x) for x in draw.normal(size=8).astype(np.float32)]) for k in range(600)]
    rows += [(k, [0.5, -0.25, 1.0, 0.0, 2.0, -1.0, 0.125, 0.75]) for k in range(600, 900)]
    bad = [(1000, None), (1050, []), (1001, [float("nan")] * 8), (1100, [1.0] * 7 + [float("inf")]), (1002, [1.0] * 7 + [None]),
           (None, [1.0] * 8), (1150, [1.0] * 5), (1003, [0.0] * 8)]
    df = spark.createDataFrame(rows + bad + rows[:60], "vec_id long, embedding array<float>")
    return rows, df.withColumn("key", F.lit(1)).withColumn("vector", F.lit("x")).repartition(6)


def reference(rows, score, k=5):
    out = set()
    for q, x in rows:
        if q % 50 == 0:
            ranked = sorted((-score(x, y), i) for i, y in rows if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("blocks", [(2048, 1024), (100, 7)])
def test_topk(vectors, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[1])
    rows, df = vectors
    rows = rows + [(1003, [0.0] * 8)]
    ints = [(i, [math.floor(256 * v) for v in x]) for i, x in rows]
    want = reference(ints, lambda x, y: sum(a * b for a, b in zip(x, y)))
    got = top_inner_products(df, IS_QUERY).collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert top_inner_products(df.limit(0), IS_QUERY).count() == 0
    assert top_inner_products(df.where("vec_id in (50, 51)"), IS_QUERY).count() == 1


def test_threshold_algorithm_stops_early_and_is_exact():
    draw = random.Random(3)
    for _ in range(60):
        n = draw.randint(1, 300)
        x = np.array([[draw.randint(-4, 4) for _ in range(4)] for _ in range(n)], np.int64)
        ids = np.array(draw.sample(range(1000), n))
        q = np.array([draw.choice([0, 0, 3, -2, 1]) for _ in range(4)], np.int64)
        found, scores = SortedLists(ids, x).top(q, 6)
        want = sorted(zip((-(x @ q)).tolist(), ids.tolist()))[:6]
        assert list(zip((-scores).tolist(), found.tolist())) == want


def test_ann_on_copies_and_odd_rows(vectors):
    rows, df = vectors
    cosine = lambda x, y: sum(a * b for a, b in zip(x, y)) / math.sqrt(sum(a * a for a in x) * sum(b * b for b in y))
    want = {(q, i): s for q, _, i, s in reference(rows, cosine)}
    got = nearest(df, IS_QUERY).collect()
    assert len(got) == len(want) and {r.rank for r in got} == {1, 2, 3, 4, 5}
    hits = [r for r in got if (r.query_id, r.vec_id) in want]
    assert len(hits) >= 0.95 * len(want)
    assert all(abs(r.score - want[r.query_id, r.vec_id]) < 1e-12 for r in hits)
    assert nearest(df.limit(0), IS_QUERY).count() == 0
    assert nearest(df.where("vec_id in (50, 51)"), IS_QUERY).count() == 1


def test_ann_recall_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST", 32)
    monkeypatch.setattr(ann, "BLOCK", 50)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = df.orderBy("vec_id").toPandas()
    ids, x = data.vec_id.to_numpy(), np.stack(data.embedding).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in nearest(df, IS_QUERY).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = total = 0
    for q in np.flatnonzero(ids % 50 == 0):
        score = x @ x[q]
        score[q] = -9
        hits += len(found[ids[q]] & set(ids[np.lexsort((ids, -score))[:5]].tolist()))
        total += 5
    assert hits >= 0.9 * total

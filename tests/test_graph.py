import pytest

import cellframe as cf
from cellframe.operators import graph as graph_module
from conftest import close, entries


def naive(edges, n, turns, alpha=0.85):
    degree = {}
    for i, _ in edges:
        degree[i] = degree.get(i, 0) + 1
    r = [1.0 / n] * n
    for _ in range(turns):
        lost = sum(r[i] for i in range(n) if i not in degree)
        y = [0.0] * n
        for i, j in edges:
            if i < n and j < n:
                y[j] += r[i] / degree[i]
        r = [alpha * v + (1 - alpha) / n + alpha * lost / n for v in y]
    return dict(enumerate(r))


def graph(spark, edges, n=None):
    n = n if n is not None else max(i for i, _ in edges) + 1
    return cf.CooMatrix.from_cells(spark, [(i, j, 1.0) for i, j in edges], n, n)


EDGES = [(0, 1), (0, 1), (0, 2), (1, 2), (2, 0), (4, 0), (4, 2), (4, 4)]


def test_statistics(spark):
    g = graph(spark, EDGES)
    assert tuple(cf.graph_stats(g).first()) == (4, 0, 4, 8)
    assert {r.i: r.degree for r in cf.out_degree(g).collect()} == {0: 3, 1: 1, 2: 1, 4: 3}
    assert [r.i for r in cf.dangling_nodes(g).collect()] == [3]
    assert cf.dangling_nodes(g, nodes="endpoints").count() == 0
    weights = sorted((r.i, r.j, r.v) for r in cf.transition_matrix(g).df.collect() if r.i == 0)
    assert weights == [(0, 1, 1 / 3), (0, 1, 1 / 3), (0, 2, 1 / 3)]


def test_id_range(spark):
    g = graph(spark, EDGES)
    cf.require_id_range(g, 0, 4)
    with pytest.raises(ValueError, match="smallest node id 1"):
        cf.require_id_range(g, 1, 4)
    with pytest.raises(ValueError, match="largest node id 99"):
        cf.require_id_range(g, 0, 99)


@pytest.mark.parametrize("turns", [0, 1, 2, 10])
def test_ranks_follow_the_definition(spark, turns):
    g = graph(spark, EDGES)
    ranks = cf.pagerank(g, iterations=turns)
    close(entries(ranks), naive(EDGES, 5, turns), 1e-12)
    assert abs(cf.total_rank(ranks).first().mass - 1) < 1e-12
    if turns == 1:
        close(entries(cf.pagerank_step(g)), naive(EDGES, 5, 1), 1e-12)


def test_a_target_beyond_the_last_source_is_not_a_node(spark):
    edges = [(0, 1), (1, 0), (1, 7)]
    ranks = cf.pagerank(graph(spark, edges), iterations=3)
    close(entries(ranks), naive(edges, 2, 3), 1e-12)
    assert cf.total_rank(ranks).first().mass < 1
    whole = cf.pagerank(graph(spark, edges), iterations=3, nodes="endpoints")
    assert set(entries(whole)) == {0, 1, 7}
    assert abs(cf.total_rank(whole).first().mass - 1) < 1e-12


def test_a_hub_is_cut_and_ranks_stay_the_same(spark, monkeypatch):
    edges = [(0, j) for j in range(1, 60)] + [(j, (j * 7) % 60) for j in range(1, 50)]
    monkeypatch.setattr(graph_module, "EDGES_PER_TASK", 8)
    walk = graph_module._prepare(graph(spark, edges, 60), 0.85, "range")
    largest = walk.links.groupBy("i", "cut").count().agg({"count": "max"}).first()[0]
    assert largest < 24
    close(entries(cf.pagerank(graph(spark, edges, 60), iterations=4)), naive(edges, 60, 4), 1e-12)


def test_graph_without_dangling_and_graph_of_dangling_only(spark):
    ring = [(k, (k + 1) % 5) for k in range(5)]
    close(entries(cf.pagerank(graph(spark, ring), iterations=3)), {k: 0.2 for k in range(5)}, 1e-12)
    g = cf.CooMatrix(graph(spark, ring).df.where("false"), 3, 3)
    close(entries(cf.pagerank(g, iterations=2)), {k: 1 / 3 for k in range(3)}, 1e-12)


def test_top_prefers_the_larger_id_among_equals(spark):
    ranks = cf.Vector.from_entries(spark, [(0, 0.1), (1, 0.3), (2, 0.3), (3, 0.2)], 4)
    assert [r.i for r in cf.top_ranked(ranks, 3).collect()] == [2, 1, 3]


def test_unknown_node_set(spark):
    with pytest.raises(ValueError, match="unknown node set"):
        cf.pagerank(graph(spark, EDGES), nodes="all")


def test_a_turn_moves_no_links(spark):
    """The links are read in their buckets; what is exchanged is the first ranks and the partial sums."""
    g = cf.CooMatrix.from_cells(spark, [(k, (3 * k + 1) % 40, 1.0) for k in range(30)], 40, 40)
    walk = graph_module._prepare(g, 0.85, "range")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with graph_module.stored_in_buckets(walk.links, buckets, walk.keys, "links") as walk.links:
        state = walk.nodes.select("i", "v", "cuts")
        for turns in (1, 2, 3):
            state = graph_module._turn(walk, state, "shuffle_hash")
            plan = state._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == turns + 1 and "ReusedExchange" not in plan
    assert not any(t.name.startswith("links_") for t in spark.catalog.listTables())

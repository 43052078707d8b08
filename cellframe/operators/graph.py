"""PageRank on the matrix-vector product, and the graph statistics around it.

A graph is a coordinate matrix with an edge i -> j per cell; values are ignored and repeated edges
count each time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, Vector
from cellframe.session import stored_in_buckets, write_through

EDGES_PER_TASK = 4_000_000
ALPHA = 0.85
ITERATIONS = 10
TURNS_PER_WRITE = 5
RANKS_IN_MEMORY = 500_000
POOL = -(2 ** 63)  # no graph uses this id


def graph_stats(g: CooMatrix) -> DataFrame:
    """``<n_nodes, min_id, max_id, n_edges>``; a node is any id that occurs in an edge."""
    ends = (
        g.df.select(F.explode(F.array("i", "j")).alias("id"))
        .groupBy("id").agg(F.count("*").alias("n"))
    )
    return ends.agg(
        F.count("*").alias("n_nodes"), F.min("id").alias("min_id"), F.max("id").alias("max_id"),
        F.coalesce(F.expr("sum(n) div 2"), F.lit(0)).alias("n_edges"),
    )


def require_id_range(g: CooMatrix, min_id: int, max_id: int) -> None:
    """Fail unless the smallest and largest node id are as expected."""
    found = graph_stats(g).first()
    if found.min_id != min_id:
        raise ValueError(f"expected smallest node id {min_id} but got {found.min_id}")
    if found.max_id != max_id:
        raise ValueError(f"expected largest node id {max_id} but got {found.max_id}")


def out_degree(g: CooMatrix) -> DataFrame:
    """``<i, degree>`` for every node with an edge out."""
    return g.df.groupBy("i").agg(F.count("*").alias("degree"))


def transition_matrix(g: CooMatrix) -> CooMatrix:
    """Each edge with value 1 / out-degree of its source; repeated edges stay repeated."""
    weight = F.lit(1.0) / F.col("degree").cast("double")
    # Written first: Spark then splits a hub's edges over tasks, which it does not do beside an aggregate.
    degree = write_through(out_degree(g), "degree")
    edges = g.df.join(degree, "i").select("i", "j", weight.alias("v"))
    return g.with_df(edges)


def _nodes(g: CooMatrix, nodes: str) -> DataFrame:
    if nodes == "range":
        return g.df.sparkSession.range(g.n_rows).select(F.col("id").alias("i"))
    if nodes == "endpoints":
        return g.df.select(F.explode(F.array("i", "j")).alias("i")).distinct()
    raise ValueError(f"unknown node set {nodes!r}: use 'range' or 'endpoints'")


def dangling_nodes(g: CooMatrix, nodes: str = "range") -> DataFrame:
    """``<i>`` of the nodes without an edge out."""
    return _nodes(g, nodes).join(g.df.select("i").distinct(), "i", "left_anti")


@dataclass
class _Walk:
    """PageRank as a plain product: r' = base + W^T r over the nodes and one more, the pool.

    The pool stands for the rank held by dangling nodes, which every node gets an even share of in the
    next turn. It is a node like any other: a link that ends in a dangling node also adds to the
    pool, and the pool links to all nodes. So a turn is one join and one grouped sum, with no
    number to fetch first.
    """

    nodes: DataFrame  # <i, v, base, cuts>: start value, constant part, and cuts of the node's links
    links: DataFrame  # <i, cut, j, w>, alpha included
    n: int
    size: int  # links, those of the pool among them
    keys: list[str]  # what ranks and links meet on: the cut counts only where some node has several


def _cuts(fan: Column) -> Column:
    return F.ceil(fan / F.lit(EDGES_PER_TASK)).cast("int")


def _prepare(g: CooMatrix, alpha: float, nodes: str) -> _Walk:
    """Merge repeated edges, weigh them, and add the pool.

    A source with more than EDGES_PER_TASK links is cut by a hash of the target, so that no task
    holds all of a hub; the hub's rank is then sent once per cut.
    """
    spark = g.df.sparkSession
    merged = write_through(g.df.groupBy("i", "j").agg(F.count("*").alias("copies")), "edges")
    degree = merged.groupBy("i").agg(F.sum("copies").alias("degree"), F.count("*").alias("fan"))
    known = _nodes(CooMatrix(merged, g.n_rows, g.n_cols), nodes).join(degree, "i", "left").select(
        "i", "degree", F.coalesce("fan", F.lit(0)).alias("fan"))
    # Written first, so that Spark splits the edges of a hub in the joins with it.
    known = write_through(known, "nodes")
    count = known.agg(F.count("*").alias("n"), F.count_if(F.col("fan") == 0).alias("dangling"),
                      F.coalesce(F.sum("fan"), F.lit(0)).alias("links"), F.max("fan").alias("widest")).first()
    n, dangling = count.n, count.dangling
    if n == 0:
        raise ValueError("PageRank needs at least one node")
    pool_cuts = max(1, -(-(n + 1) // EDGES_PER_TASK))
    cut = pool_cuts > 1 or count.widest + 1 > EDGES_PER_TASK

    weight = F.lit(alpha) * F.col("copies") / F.col("degree")
    sources = known.where("fan > 0").select("i", "degree", _cuts(F.col("fan") + 1).alias("cuts"))
    ends = known.select(F.col("i").alias("j"), (F.col("fan") == 0).alias("ends"))
    # A link into a dangling node is one into the pool as well.
    into = F.when(F.col("ends"), F.array("j", F.lit(POOL))).otherwise(F.array("j"))
    steps = merged.join(sources, "i").join(ends, "j").select("i", "cuts", F.explode(into).alias("j"), weight.alias("w"))
    targets = known.select("i", F.lit(1).alias("share")).unionByName(
        spark.range(1).select(F.lit(POOL).alias("i"), F.lit(dangling).alias("share")))
    from_pool = targets.select(
        F.lit(POOL).alias("i"), F.lit(pool_cuts).alias("cuts"), F.col("i").alias("j"),
        (F.lit(alpha) * F.col("share") / F.lit(float(n))).alias("w"))
    links = steps.unionByName(from_pool).select(
        "i", F.pmod(F.xxhash64("j"), "cuts").cast("int").alias("cut"), "j", "w")
    # A dangling node has no links, so it has no cut to send its rank to.
    rest = (1.0 - alpha) / n
    table = known.select(
        "i", F.lit(1.0 / n).alias("v"), F.lit(rest).alias("base"),
        F.when(F.col("fan") > 0, _cuts(F.col("fan") + 1)).otherwise(F.lit(0)).alias("cuts"))
    pool = spark.range(1).select(
        F.lit(POOL).alias("i"), F.lit(dangling / n).alias("v"), F.lit(rest * dangling).alias("base"),
        F.lit(pool_cuts).alias("cuts"))
    return _Walk(table.unionByName(pool), links, n, count.links + 2 * n, ["i", "cut"] if cut else ["i"])


def _turn(walk: _Walk, state: DataFrame, join: str = "merge") -> DataFrame:
    """One turn on ``<i, v, cuts>``. The constant part of each node enters the grouped sum as a row,
    which also keeps the nodes that nothing links to."""
    sent = state.where("cuts > 0").select("i", "v", *[
        F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")] * ("cut" in walk.keys))
    flow = walk.links.join(sent.hint(join), walk.keys).select(
        F.col("j").alias("i"), (F.col("w") * F.col("v")).alias("v"), F.lit(0).alias("cuts"))
    base = walk.nodes.select("i", F.col("base").alias("v"), "cuts")
    return flow.unionByName(base).groupBy("i").agg(F.sum("v").alias("v"), F.max("cuts").alias("cuts"))


def _ranks(walk: _Walk, state: DataFrame) -> Vector:
    return Vector(state.where(F.col("i") != POOL).select("i", "v"), walk.n, dense=True, unique=True)


def pagerank_step(g: CooMatrix, alpha: float = ALPHA, nodes: str = "range") -> Vector:
    """Ranks after one turn from the uniform start."""
    walk = _prepare(g, alpha, nodes)
    return _ranks(walk, _turn(walk, walk.nodes))


def pagerank(g: CooMatrix, iterations: int = ITERATIONS, alpha: float = ALPHA, nodes: str = "range") -> Vector:
    """Ranks after a fixed number of turns: r' = alpha M^T r + (1 - alpha)/n + alpha dangling/n.

    ``nodes="range"`` takes every id below ``g.n_rows`` as a node; ``"endpoints"`` takes the ids
    that occur. The links are stored once, in buckets by source. The ranks of a turn come out of their sum
    hashed alike, so they meet the links where they are, and the partial sums are all that a turn moves.
    Every few turns the ranks, one row per node, are written to the shared folder: plans stay
    short, and losing an executor replays those few turns at most.
    """
    spark = g.df.sparkSession
    walk = _prepare(g, alpha, nodes)
    if not iterations:
        return _ranks(walk, walk.nodes)
    # As many buckets as sums have partitions, unless that leaves a bucket too many links.
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(walk.size / EDGES_PER_TASK))
    # A hash table of the ranks of a bucket where it is small; else both sides are sorted, which can spill.
    join = "shuffle_hash" if walk.n / buckets <= RANKS_IN_MEMORY else "merge"
    with stored_in_buckets(walk.links, buckets, walk.keys, "links") as walk.links:
        state = walk.nodes.select("i", "v", "cuts")
        for turn in range(1, iterations + 1):
            state = _turn(walk, state, join)
            if turn % TURNS_PER_WRITE == 0 or turn == iterations:
                state = write_through(state, "ranks")
    return _ranks(walk, state)


def total_rank(ranks: Vector) -> DataFrame:
    """``<mass>``; 1.0 for a graph all of whose targets are nodes."""
    return ranks.df.agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("mass"))


def top_ranked(ranks: Vector, k: int = 10) -> DataFrame:
    """The k nodes of highest rank, larger id first among equals."""
    return ranks.df.orderBy(F.desc("v"), F.desc("i")).limit(k)

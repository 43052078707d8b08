"""The registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import cellframe as cf
from cellframe.model import CooMatrix, CooTensor, Vector
from cellframe.operators.layout import positions
from cellframe.session import fresh_path
from cellframe.workload.oracle import (
    MONTH,
    N_MONTHS,
    N_PARTS,
    N_SUPPLIERS,
    below_sql,
    mttkrp_sql,
    pagerank_sql,
    records_sql,
    uniform_sql,
    with_views,
)
from cellframe.workload.views import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the table views under a name."""

    def register(make: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return make

    return register


def _big(column: str, alias: str):
    return F.col(column).cast("bigint").alias(alias)


# Matrix x vector.

SPMV_SPARSE = with_views("a xs", "SELECT a.i, sum(a.v * xs.v) AS v FROM a JOIN xs ON a.j = xs.i GROUP BY 1")
SPMV_DENSE = with_views("a xd", "SELECT a.i, sum(a.v * coalesce(xd.v, 0)) AS v FROM a LEFT JOIN xd ON a.j = xd.i GROUP BY 1")
SPMV_SHORT = with_views("a xshort", "SELECT a.i, sum(a.v * coalesce(x.v, 0)) AS v FROM a LEFT JOIN xshort x ON a.j = x.i GROUP BY 1")


@query("spmv_coo_sparse", SPMV_SPARSE)
def spmv_coo_sparse(t: Tables) -> DataFrame:
    return cf.spmv(t.a, t.x_sparse).df


@query("spmv_csr_sparse", SPMV_SPARSE)
def spmv_csr_sparse(t: Tables) -> DataFrame:
    return cf.spmv(t.a, t.x_sparse, format="csr").df


@query("spmv_coo_dense", SPMV_DENSE)
def spmv_coo_dense(t: Tables) -> DataFrame:
    return cf.spmv(t.a, t.x_dense).df


@query("spmv_csr_dense", SPMV_DENSE)
def spmv_csr_dense(t: Tables) -> DataFrame:
    return cf.spmv(t.a, t.x_dense, format="csr").df


@query("spmv_coo_dense_short", SPMV_SHORT)
def spmv_coo_dense_short(t: Tables) -> DataFrame:
    return cf.spmv(t.a, t.x_short).df


@query("csr_row_dot", SPMV_SHORT)
def csr_row_dot(t: Tables) -> DataFrame:
    return cf.csr_row_dot(cf.pack_rows(t.a), t.x_short)


@query("spmv_dataframe", SPMV_SPARSE)
def spmv_dataframe(t: Tables) -> DataFrame:
    a = t.a.df.withColumnRenamed("j", "k").withColumnRenamed("v", "v_a")
    x = t.x_sparse.df.withColumnRenamed("i", "k").withColumnRenamed("v", "v_x")
    return a.join(x, "k").groupBy("i").agg(F.sum(F.col("v_a") * F.col("v_x")).alias("v"))


@query("spmv_sql", SPMV_SPARSE)
def spmv_sql(t: Tables) -> DataFrame:
    return cf.spmv_sql(t.a, t.x_sparse)


# Matrix x matrix.

SPMM = with_views("ab", "SELECT i, j, v FROM ab")


@query("spmm_coo", SPMM)
def spmm_coo(t: Tables) -> DataFrame:
    return cf.spmm(t.a, t.b).df


@query("spmm_csr", SPMM)
def spmm_csr(t: Tables) -> DataFrame:
    return cf.spmm(t.a, t.b, format="csr").df


@query("spmm_csc", SPMM)
def spmm_csc(t: Tables) -> DataFrame:
    return cf.spmm(t.a, t.b, format="csc").df


@query("spmm_csr_csc", SPMM)
def spmm_csr_csc(t: Tables) -> DataFrame:
    return cf.spmm(t.a, t.b, format="csr_csc").df


@query("spmm_partitions", SPMM)
def spmm_partitions(t: Tables) -> DataFrame:
    return cf.spmm(t.a, t.b, partitions=16).df


@query("spmm_dataframe_sorted", SPMM + " ORDER BY i, j")
def spmm_dataframe_sorted(t: Tables) -> DataFrame:
    return cf.spmm_sorted(t.a, t.b)


@query("spmm_sql", SPMM)
def spmm_sql(t: Tables) -> DataFrame:
    return cf.spmm_sql(t.a, t.b)


@query("spmm_dense", with_views(
    "a d", "SELECT a.i, d.r, sum(a.v * d.v) AS v FROM a JOIN d ON a.j = d.i GROUP BY 1, 2"))
def spmm_dense(t: Tables) -> DataFrame:
    return cf.spmm_dense(t.a, t.d).cells()


@query("spmm_dense_embeddings", (
    "WITH cells AS (SELECT label, unnest(range(64))::BIGINT AS r, unnest(embedding)::DOUBLE AS v FROM embeddings) "
    "SELECT label::BIGINT AS i, r, round(sum(v), 6) AS v FROM cells GROUP BY 1, 2"))
def spmm_dense_embeddings(t: Tables) -> DataFrame:
    return cf.spmm_dense(t.label_members, t.vectors).cells().withColumn("v", F.round("v", 6))


# Tensors.

def _mttkrp_query(name: str, tensor: str, order: int, mode: int, method: str) -> None:
    @query(name, mttkrp_sql(order, mode))
    def run(t: Tables) -> DataFrame:
        x: CooTensor = getattr(t, tensor)
        return cf.mttkrp(x, t.factors(x), mode, method=method).cells()


for _mode in range(3):
    _mttkrp_query(f"mttkrp_coo_mode{_mode}", "tensor3", 3, _mode, "coo")
    _mttkrp_query(f"mttkrp_fiber_mode{_mode}", "tensor3", 3, _mode, "fiber")
_mttkrp_query("mttkrp_4way", "tensor4", 4, 2, "fiber")
_mttkrp_query("mttkrp_4way_coo", "tensor4", 4, 2, "coo")
_mttkrp_query("mttkrp_1way", "tensor1", 1, 0, "fiber")


@query("tensor_fibers", with_views("t", (
    "SELECT i0, i2, (row_number() OVER (PARTITION BY i0, i2 ORDER BY i1) - 1)::BIGINT AS pos, i1 AS t, v "
    "FROM (SELECT i0, i1, i2, sum(v) AS v FROM t GROUP BY ALL)")))
def tensor_fibers(t: Tables) -> DataFrame:
    fibers = cf.tensor_fibers(t.tensor3, 1)
    return positions(fibers).select("i0", "i2", "pos", "c.t", "c.v")


# Layouts.

@query("coo_to_csr", with_views("a", (
    "SELECT i, (row_number() OVER (PARTITION BY i ORDER BY j, v) - 1)::BIGINT AS pos, j, v FROM a")))
def coo_to_csr(t: Tables) -> DataFrame:
    return positions(cf.pack_rows(t.a).df).select("i", "pos", "c.j", "c.v")


@query("coo_to_csc", with_views("a", (
    "SELECT j, (row_number() OVER (PARTITION BY j ORDER BY i, v) - 1)::BIGINT AS pos, i, v FROM a")))
def coo_to_csc(t: Tables) -> DataFrame:
    return positions(cf.pack_cols(t.a).df).select("j", "pos", "c.i", "c.v")


@query("csr_to_coo", with_views("a", "SELECT i, j, v FROM a"))
def csr_to_coo(t: Tables) -> DataFrame:
    return cf.unpack(cf.pack_rows(t.a)).df


@query("csc_to_coo", with_views("a", "SELECT i, j, v FROM a"))
def csc_to_coo(t: Tables) -> DataFrame:
    return cf.unpack(cf.pack_cols(t.a)).df


@query("transpose", with_views("a", "SELECT j AS i, i AS j, v FROM a"))
def transpose(t: Tables) -> DataFrame:
    return t.a.T.df


@query("merge_duplicates", with_views("a", "SELECT i, j, sum(v) AS v FROM a GROUP BY 1, 2"))
def merge_duplicates(t: Tables) -> DataFrame:
    return cf.merge_duplicates(t.a).df


@query("repartition_matrix", with_views("a", "SELECT i, j, v FROM a"))
def repartition_matrix(t: Tables) -> DataFrame:
    return cf.repartition_matrix(t.a, 16, "j").df


@query("drop_zeros", "SELECT l_suppkey AS i, l_partkey AS j, l_discount AS v FROM lineitem WHERE l_discount <> 0")
def drop_zeros(t: Tables) -> DataFrame:
    discounts = t.table("lineitem").select(
        F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_discount").alias("v"))
    return cf.drop_zeros(t.a.with_df(discounts)).df


@query("scale_rows", with_views("d xd", "SELECT d.i, d.r, d.v * xd.v AS v FROM d JOIN xd ON d.i = xd.i"))
def scale_rows(t: Tables) -> DataFrame:
    return cf.scale_rows(t.d, t.x_dense).cells()


# Statistics and chains.

EST_AB = f"nnz_a / {N_PARTS}::DOUBLE * (nnz_b / {N_PARTS}::DOUBLE) * {N_PARTS}::DOUBLE"
EST_BC = f"nnz_b / {N_MONTHS}::DOUBLE * (nnz_c / {N_MONTHS}::DOUBLE) * {N_MONTHS}::DOUBLE"


def _costs_sql(c: str) -> tuple[str, list[tuple[str, str]]]:
    counts = ("counts", (
        "SELECT (SELECT count(*) FROM a)::DOUBLE AS nnz_a, (SELECT count(*) FROM b)::DOUBLE AS nnz_b, "
        f"(SELECT count(*) FROM {c})::DOUBLE AS nnz_c"))
    costs = ("costs", f"SELECT *, {EST_AB} AS ab, {EST_BC} AS bc FROM counts")
    return f"a b {c}", [counts, costs]


def _plan_sql(c: str) -> str:
    names, extra = _costs_sql(c)
    return with_views(names, (
        "SELECT CASE WHEN ab <= bc THEN 'AB_then_C' ELSE 'A_then_BC' END AS plan, least(ab, bc) AS first_cost, "
        f"CASE WHEN ab <= bc THEN floor(ab + 0.5) / {N_MONTHS}::DOUBLE * (nnz_c / {N_MONTHS}::DOUBLE) * {N_MONTHS}::DOUBLE "
        f"ELSE nnz_a / {N_PARTS}::DOUBLE * (floor(bc + 0.5) / {N_PARTS}::DOUBLE) * {N_PARTS}::DOUBLE END AS second_cost "
        "FROM costs"), extra)


@query("matrix_stats", (
    f"SELECT {N_SUPPLIERS} AS n_rows, {N_PARTS} AS n_cols, count(*) AS nnz FROM lineitem"))
def matrix_stats(t: Tables) -> DataFrame:
    return cf.matrix_stats(t.a)


@query("chain_cost", with_views(_costs_sql("c_raw")[0], "SELECT nnz_a, nnz_b, nnz_c, ab, bc FROM costs",
                                _costs_sql("c_raw")[1]))
def chain_cost(t: Tables) -> DataFrame:
    return cf.chain_costs(t.a, t.b, t.c_raw)


@query("chain_plan_ab", _plan_sql("c_raw"))
def chain_plan_ab(t: Tables) -> DataFrame:
    return cf.chain_plan(t.a, t.b, t.c_raw)


@query("chain_plan_bc", _plan_sql("c_sum"))
def chain_plan_bc(t: Tables) -> DataFrame:
    return cf.chain_plan(t.a, t.b, t.c_sum)


CHAIN = with_views("ab c_sum", (
    "SELECT ab.i, c_sum.j, sum(ab.v * c_sum.v) AS v FROM ab JOIN c_sum ON ab.j = c_sum.i GROUP BY 1, 2"))


@query("spmm_chain3", CHAIN)
def spmm_chain3(t: Tables) -> DataFrame:
    return cf.spmm_chain3(t.a, t.b, t.c_sum).df


@query("spmm_chain3_ab_first", CHAIN)
def spmm_chain3_ab_first(t: Tables) -> DataFrame:
    return cf.spmm_chain3(t.a, t.b, t.c_raw, order="AB_then_C").df


@query("spmm_chain3_bc_first", CHAIN)
def spmm_chain3_bc_first(t: Tables) -> DataFrame:
    return cf.spmm_chain3(t.a, t.b, t.c_sum, order="A_then_BC").df


# Graphs.

@query("graph_stats", with_views("e", (
    "SELECT count(DISTINCT id) AS n_nodes, min(id) AS min_id, max(id) AS max_id, (SELECT count(*) FROM e) AS n_edges "
    "FROM (SELECT i AS id FROM e UNION ALL SELECT j FROM e)")))
def graph_stats(t: Tables) -> DataFrame:
    return cf.graph_stats(t.graph)


@query("out_degree", with_views("deg", "SELECT i, degree FROM deg"))
def out_degree(t: Tables) -> DataFrame:
    return cf.out_degree(t.graph)


@query("transition_matrix", with_views("m", "SELECT i, j, round(v, 9) AS v FROM m"))
def transition_matrix(t: Tables) -> DataFrame:
    return cf.transition_matrix(t.graph).df.withColumn("v", F.round("v", 9))


@query("dangling_nodes", with_views("dangling", "SELECT i FROM dangling"))
def dangling_nodes(t: Tables) -> DataFrame:
    return cf.dangling_nodes(t.graph)


@query("pagerank_step", pagerank_sql(1, "SELECT i, round(v, 10) AS v FROM final"))
def pagerank_step(t: Tables) -> DataFrame:
    return cf.pagerank_step(t.graph).df.withColumn("v", F.round("v", 10))


@query("pagerank", pagerank_sql(10, "SELECT i, round(v, 10) AS v FROM final"))
def pagerank(t: Tables) -> DataFrame:
    return cf.pagerank(t.graph).df.withColumn("v", F.round("v", 10))


@query("pagerank_mass", pagerank_sql(10, "SELECT round(sum(v), 9) AS mass FROM final"))
def pagerank_mass(t: Tables) -> DataFrame:
    return cf.total_rank(cf.pagerank(t.graph)).select(F.round("mass", 9).alias("mass"))


@query("pagerank_top10", pagerank_sql(
    10, "SELECT i, round(v, 10) AS v FROM (SELECT i, v FROM final ORDER BY v DESC, i DESC LIMIT 10)"))
def pagerank_top10(t: Tables) -> DataFrame:
    return cf.top_ranked(cf.pagerank(t.graph), 10).select("i", F.round("v", 10).alias("v"))


# Comparisons.

@query("vector_max_diff", with_views("a xs xd", (
    "SELECT coalesce(max(abs(coalesce(p.v, 0) - coalesce(q.v, 0))), 0) AS max_diff "
    "FROM (SELECT a.i, sum(a.v * xs.v) AS v FROM a JOIN xs ON a.j = xs.i GROUP BY 1) p FULL JOIN "
    "(SELECT a.i, sum(a.v * xd.v) AS v FROM a JOIN xd ON a.j = xd.i GROUP BY 1) q ON p.i = q.i")))
def vector_max_diff(t: Tables) -> DataFrame:
    return cf.vector_max_diff(cf.spmv(t.a, t.x_sparse), cf.spmv(t.a, t.x_dense))


@query("matrix_max_diff", with_views("a", (
    "SELECT coalesce(max(abs(coalesce(p.v, 0) - coalesce(q.v, 0))), 0) AS max_diff "
    "FROM (SELECT i, j, sum(v) AS v FROM a GROUP BY 1, 2) p FULL JOIN "
    "(SELECT l_suppkey AS i, l_partkey AS j, sum(l_linenumber)::DOUBLE AS v FROM lineitem GROUP BY 1, 2) q "
    "ON p.i = q.i AND p.j = q.j")))
def matrix_max_diff(t: Tables) -> DataFrame:
    numbers = t.table("lineitem").select(
        F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j"), F.col("l_linenumber").cast("double").alias("v"))
    return cf.matrix_max_diff(cf.merge_duplicates(t.a), cf.merge_duplicates(t.a.with_df(numbers)))


@query("dense_max_diff", with_views("a d t ranks", (
    "SELECT coalesce(max(abs(p.v - q.v)), 0) AS max_diff FROM "
    "(SELECT a.i, d.r, sum(a.v * d.v) AS v FROM a JOIN d ON a.j = d.i GROUP BY 1, 2) p JOIN "
    "(SELECT i0 AS i, r, sum(v * ((i1 * 7 + r * 3 + 1) % 11 - 5) * ((i2 * 7 + r * 3 + 2) % 11 - 5)) AS v "
    "FROM t CROSS JOIN ranks GROUP BY 1, 2) q ON p.i = q.i AND p.r = q.r")))
def dense_max_diff(t: Tables) -> DataFrame:
    return cf.dense_max_diff(cf.spmm_dense(t.a, t.d), cf.mttkrp(t.tensor3, t.factors(t.tensor3), 0))


@query("nonfinite_count", "SELECT count(*) AS bad FROM lineitem WHERE l_discount = 0 OR l_tax = 0")
def nonfinite_count(t: Tables) -> DataFrame:
    v = (F.when(F.col("l_discount") == 0, float("nan")).when(F.col("l_tax") == 0, float("-inf"))
         .otherwise(F.col("l_quantity")))
    return cf.nonfinite_count(t.table("lineitem").select(v.alias("v")))


# Text round trips: write a whole view to the shared folder and read it back.

def _with_dims(m: CooMatrix) -> DataFrame:
    return m.df.select("i", "j", "v", F.lit(m.n_rows).cast("bigint").alias("n_rows"),
                       F.lit(m.n_cols).cast("bigint").alias("n_cols"))


@query("read_coo", with_views("a", (
    "SELECT i, j, v, (SELECT max(i) + 1 FROM a) AS n_rows, (SELECT max(j) + 1 FROM a) AS n_cols FROM a")))
def read_coo(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "coo")
    cf.write_coo(t.a, path)
    return _with_dims(cf.read_coo(t.spark, path))


@query("read_vector", with_views("xd", "SELECT i, v, (SELECT max(i) + 1 FROM xd) AS length FROM xd"))
def read_vector(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "vector")
    cf.write_vector(t.x_dense, path)
    x: Vector = cf.read_vector(t.spark, path)
    return x.df.select("i", "v", F.lit(x.length).cast("bigint").alias("length"))


@query("read_dense_csv", with_views("d", (
    f"SELECT i, r AS j, v, {N_PARTS} AS n_rows, 4::BIGINT AS n_cols FROM d WHERE v <> 0")))
def read_dense_csv(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "dense-csv")
    cf.write_dense_rows(t.d, path)
    return _with_dims(cf.read_dense_csv(t.spark, path))


@query("read_dense_rows", (
    "SELECT vec_id AS i, unnest(range(64))::BIGINT AS r, unnest(embedding)::DOUBLE AS v FROM embeddings"))
def read_dense_rows(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "dense-rows")
    cf.write_dense_rows(t.vectors, path)
    return cf.read_dense_rows(t.spark, path).cells()


@query("read_tensor", with_views("t", "SELECT i0, i1, i2, v FROM t"))
def read_tensor(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "tensor")
    cf.write_tensor(t.tensor3, path)
    return cf.read_tensor(t.spark, path).df


# Generators, sized by the tables and joined to them, cell by cell.

def _on_rows(cells: DataFrame, rows: DataFrame, column: str, value: str) -> DataFrame:
    return cells.join(rows.select(F.col("i").alias(column), F.col("v").alias(value)), column)


@query("random_coo", with_views("xshort xd", (
    "SELECT c.i, c.j, c.v, xshort.v AS nation, xd.v AS size FROM ("
    f"SELECT {below_sql('id', N_SUPPLIERS, 0, 42)} AS i, {below_sql('id', N_PARTS, 1, 42)} AS j, "
    f"{uniform_sql('id', 2, 42)} * 10 AS v FROM ("
    + records_sql(f"greatest(1, floor({N_SUPPLIERS} * {N_PARTS} * 0.01::DOUBLE))")
    + ")) c JOIN xshort ON c.i = xshort.i JOIN xd ON c.j = xd.i")))
def random_coo(t: Tables) -> DataFrame:
    return cf.random_coo(t.spark, t.size("supplier"), t.size("part"), 0.01, seed=42,
                         known={"i": ("nation", t.x_short), "j": ("size", t.x_dense)}).df


@query("random_tensor", with_views("xshort xd", (
    "SELECT c.i0, c.i1, c.i2, c.v, xshort.v AS nation, xd.v AS size FROM ("
    f"SELECT {below_sql('id', N_SUPPLIERS, 0, 42)} AS i0, {below_sql('id', N_PARTS, 1, 42)} AS i1, "
    f"{below_sql('id', N_MONTHS, 2, 42)} AS i2, {uniform_sql('id', 3, 42)} AS v FROM ("
    + records_sql(f"greatest(1, floor({N_SUPPLIERS} * {N_PARTS} * {N_MONTHS} * 0.0002::DOUBLE + 0.5))")
    + ")) c JOIN xshort ON c.i0 = xshort.i JOIN xd ON c.i1 = xd.i")))
def random_tensor(t: Tables) -> DataFrame:
    return cf.random_tensor(t.spark, t.tensor3.shape, 0.0002, seed=42,
                            known={"i0": ("nation", t.x_short), "i1": ("size", t.x_dense)}).df


@query("random_dense", with_views("xd", (
    "SELECT c.i, c.r, c.v, xd.v AS size FROM ("
    f"SELECT id // 8 AS i, id % 8 AS r, {uniform_sql('id', 0, 42)} AS v FROM (" + records_sql(f"{N_PARTS} * 8")
    + ")) c JOIN xd ON c.i = xd.i")))
def random_dense(t: Tables) -> DataFrame:
    cells = cf.random_dense(t.spark, t.size("part"), 8, seed=42).cells()
    return _on_rows(cells, t.x_dense.df, "i", "size").select("i", "r", "v", "size")

"""Sparse matrix and tensor algebra as Spark DataFrame plans."""

from cellframe.model import CooMatrix, CooTensor, DenseRows, PackedMatrix, Vector
from cellframe.operators.compare import (
    dense_max_diff,
    matrix_max_diff,
    nonfinite_count,
    vector_max_diff,
)
from cellframe.operators.graph import (
    dangling_nodes,
    graph_stats,
    out_degree,
    pagerank,
    pagerank_step,
    require_id_range,
    top_ranked,
    total_rank,
    transition_matrix,
)
from cellframe.operators.layout import (
    csr_row_dot,
    drop_zeros,
    merge_duplicates,
    pack_cols,
    pack_rows,
    repartition_matrix,
    scale_rows,
    tensor_fibers,
    unpack,
)
from cellframe.operators.products import spmm, spmm_dense, spmm_sorted, spmm_sql, spmv, spmv_sql
from cellframe.operators.tensor import mttkrp
from cellframe.plans.chain import chain_costs, chain_plan, est_pairs, matrix_stats, spmm_chain3
from cellframe.sources.random import random_coo, random_dense, random_tensor
from cellframe.sources.text import read_coo, read_dense_csv, read_dense_rows, read_tensor, read_vector
from cellframe.sources.writers import write_coo, write_dense_rows, write_tensor, write_vector

__all__ = [
    "CooMatrix", "CooTensor", "DenseRows", "PackedMatrix", "Vector",
    "chain_costs", "chain_plan", "csr_row_dot", "dangling_nodes", "dense_max_diff", "drop_zeros", "est_pairs",
    "graph_stats", "matrix_max_diff", "matrix_stats", "merge_duplicates", "mttkrp",
    "nonfinite_count", "out_degree", "pack_cols", "pack_rows", "pagerank", "pagerank_step",
    "random_coo", "random_dense", "random_tensor", "read_coo", "read_dense_csv",
    "read_dense_rows", "read_tensor", "read_vector", "repartition_matrix", "require_id_range",
    "scale_rows", "spmm", "spmm_chain3", "spmm_dense", "spmm_sorted", "spmm_sql", "spmv",
    "spmv_sql", "tensor_fibers", "top_ranked", "total_rank", "transition_matrix", "unpack",
    "vector_max_diff", "write_coo", "write_dense_rows", "write_tensor", "write_vector",
]

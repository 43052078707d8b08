"""Statistics, and the order of a three-matrix product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooMatrix
from cellframe.operators.products import bounded_product, require_compatible, spmm
from cellframe.session import write_through

# The names of the plans in results.
AB_FIRST = "AB_then_C"
BC_FIRST = "A_then_BC"


def matrix_stats(m: CooMatrix) -> DataFrame:
    """``<n_rows, n_cols, nnz>``; duplicates count as stored."""
    return m.df.agg(F.count("*").alias("nnz")).select(
        F.lit(m.n_rows).cast("bigint").alias("n_rows"), F.lit(m.n_cols).cast("bigint").alias("n_cols"), "nnz")


def est_pairs(nnz_a: Column, cols_a: int, nnz_b: Column, rows_b: int) -> Column:
    """Join pairs expected if cells were spread evenly over the shared index; 0 for an empty dimension."""
    if cols_a == 0 or rows_b == 0:
        return F.lit(0.0)
    return nnz_a / F.lit(float(cols_a)) * (nnz_b / F.lit(float(rows_b))) * F.lit(float(min(cols_a, rows_b)))


def chain_costs(a: CooMatrix, b: CooMatrix, c: CooMatrix) -> DataFrame:
    """``<nnz_a, nnz_b, nnz_c, ab, bc>`` in one row: cell counts and the estimated cost of A B and B C."""
    one = F.lit(1)
    tagged = a.df.select(F.lit("a").alias("m")).unionByName(b.df.select(F.lit("b").alias("m")))
    tagged = tagged.unionByName(c.df.select(F.lit("c").alias("m")))
    counts = tagged.agg(*[
        F.count(F.when(F.col("m") == name, one)).cast("double").alias(f"nnz_{name}") for name in "abc"
    ])
    return counts.select(
        "*",
        est_pairs(F.col("nnz_a"), a.n_cols, F.col("nnz_b"), b.n_rows).alias("ab"),
        est_pairs(F.col("nnz_b"), b.n_cols, F.col("nnz_c"), c.n_rows).alias("bc"),
    )


def chain_plan(a: CooMatrix, b: CooMatrix, c: CooMatrix) -> DataFrame:
    """``<plan, first_cost, second_cost>`` for A B C in one row.

    The cheaper first product goes first, A B on a tie. The second cost assumes the first result has
    as many cells as its estimate; it is reported and does not decide.
    """
    ab_first = F.col("ab") <= F.col("bc")
    nnz_ab, nnz_bc = F.floor(F.col("ab") + 0.5), F.floor(F.col("bc") + 0.5)
    return chain_costs(a, b, c).select(
        F.when(ab_first, F.lit(AB_FIRST)).otherwise(F.lit(BC_FIRST)).alias("plan"),
        F.when(ab_first, F.col("ab")).otherwise(F.col("bc")).alias("first_cost"),
        F.when(ab_first, est_pairs(nnz_ab, b.n_cols, F.col("nnz_c"), c.n_rows))
        .otherwise(est_pairs(F.col("nnz_a"), a.n_cols, nnz_bc, b.n_rows)).alias("second_cost"),
    )


def _kept(m: CooMatrix) -> CooMatrix:
    """The intermediate is read twice, to measure the second product and to make it."""
    return m.with_df(write_through(m.df, "chain"))


def _expected(nnz_a: int, cols_a: int, nnz_b: int, rows_b: int) -> float:
    """:func:`est_pairs` of counts that are known."""
    return nnz_a / cols_a * (nnz_b / rows_b) * min(cols_a, rows_b) if cols_a and rows_b else 0.0


def _cell_counts(*matrices: CooMatrix) -> list[int]:
    """Stored cells of each matrix, in one job without a shuffle of cells."""
    tagged = [m.df.select(F.lit(n).alias("m")) for n, m in enumerate(matrices)]
    cells = tagged[0]
    for more in tagged[1:]:
        cells = cells.unionByName(more)
    counts = cells.agg(*[F.count_if(F.col("m") == n).alias(f"n{n}") for n in range(len(matrices))]).first()
    return list(counts)


def spmm_chain3(a: CooMatrix, b: CooMatrix, c: CooMatrix, format: str = "coo",
                order: str | None = None) -> CooMatrix:
    """A B C, the cheaper product first; ``order`` overrides the choice.

    Cells are counted once. The counts and dimensions bound the first product, its result and the second
    product; where the bounds are good enough to lay both out, that one count is all that runs before the
    result. Elsewhere the cells are counted by shared index, and the intermediate is written and counted.
    """
    if order not in (None, AB_FIRST, BC_FIRST):
        raise ValueError(f"unknown order {order!r}: use {AB_FIRST!r} or {BC_FIRST!r}")
    cells_a, cells_b, cells_c = _cell_counts(a, b, c)
    if order is None:
        cost_ab = _expected(cells_a, a.n_cols, cells_b, b.n_rows)
        cost_bc = _expected(cells_b, b.n_cols, cells_c, c.n_rows)
        order = AB_FIRST if cost_ab <= cost_bc else BC_FIRST
    first = (a, b, cells_a, cells_b) if order == AB_FIRST else (b, c, cells_b, cells_c)
    require_compatible("spmm_chain3", (a.n_rows, a.n_cols), (b.n_rows, b.n_cols))
    require_compatible("spmm_chain3", (b.n_rows, b.n_cols), (c.n_rows, c.n_cols))
    bounded = bounded_product(*first) if format in ("coo", "csr_csc") else None
    if bounded is None:
        middle = _kept(spmm(*first[:2], format))
    else:
        middle, most = bounded
        whole = bounded_product(middle, c, most, cells_c) if order == AB_FIRST else bounded_product(a, middle, cells_a, most)
        if whole is not None:
            return whole[0]
        middle = _kept(middle)
    return spmm(middle, c, format) if order == AB_FIRST else spmm(a, middle, format)

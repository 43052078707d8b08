"""MTTKRP: matricized tensor times Khatri-Rao product, on tensors of any order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooTensor, DenseRows
from cellframe.operators.layout import tensor_fibers
from cellframe.operators.products import MAX_FUSED_WIDTH, sum_rows
from cellframe.plans.lookup import look_up

def require_factors(t: CooTensor, factors: Sequence[DenseRows], mode: int) -> int:
    """Check the factors against the tensor and return their rank."""
    if len(factors) != t.order:
        raise ValueError(f"got {len(factors)} factors for a tensor of order {t.order}")
    if not 0 <= mode < t.order:
        raise ValueError(f"there is no mode {mode} in a tensor of order {t.order}")
    rank = factors[0].n_cols
    for m, factor in enumerate(factors):
        if factor.n_cols != rank:
            raise ValueError(f"factors differ in rank: mode {m} has {factor.n_cols} columns, mode 0 has {rank}")
        if factor.n_rows != t.shape[m]:
            raise ValueError(f"the factor of mode {m} needs {t.shape[m]} rows but has {factor.n_rows}")
    return rank


def _checked(factor: DenseRows, m: int, rank: int) -> DataFrame:
    """``<im, fm>``, one row per id, so no join with it fans out. A row that is too short is an error."""
    rows = factor.df.select(F.col("i").alias(f"i{m}"), F.col("row").alias(f"f{m}"))
    short = F.coalesce(F.size(f"f{m}"), F.lit(0)) < rank
    fail = F.raise_error(F.concat(F.lit(f"a row of factor {m} is shorter than {rank}: id "), F.col(f"i{m}").cast("string")))
    return rows.where(F.when(short, fail).otherwise(F.lit(True)))


def _product(value: Column, arrays: Sequence[str], r: int) -> Column:
    """``value`` times the r-th value of each array; plain products, which stay in generated code."""
    for name in arrays:
        value = value * F.get(name, F.lit(r))
    return value


def _cell_sums(t: CooTensor, factors: Sequence[DenseRows], mode: int, others: list[int], rank: int) -> DataFrame:
    """Every cell looks up the factor rows of all other modes and sums their products by target."""
    df = t.df
    for m in others:
        df = look_up(df, _checked(factors[m], m, rank), f"i{m}", factors[m].n_rows * rank, t.df)
    rows = [f"f{m}" for m in others]
    return df.groupBy(f"i{mode}").agg(*[F.sum(_product(F.col("v"), rows, r)).alias(f"s{r}") for r in range(rank)])


def _tree_sums(t: CooTensor, factors: Sequence[DenseRows], mode: int, others: list[int], rank: int) -> DataFrame:
    """The cells as a tree with the target at its root and a level for each other mode, summed upwards.

    A node's row is the sum of its children's rows, each times the factor row of the child, so that a
    factor row is looked up and multiplied once per node and not once per cell below it. The shortest modes
    are next to the root, where nodes are then fewest. Each level is a grouped sum with map-side sums, so a node
    with very many children arrives as one row per task.
    """
    levels = sorted(others, key=lambda m: t.shape[m])
    df, values = t.df, [F.col("v")] * rank
    while levels:
        m = levels.pop()
        sums = [F.sum(_product(values[r], [f"f{m}"], r)).alias(f"s{r}") for r in range(rank)]
        met = look_up(df, _checked(factors[m], m, rank), f"i{m}", factors[m].n_rows * rank, t.df)
        df = met.groupBy(f"i{mode}", *[f"i{k}" for k in levels]).agg(*sums)
        values = [F.col(f"s{r}") for r in range(rank)]
    return df


def _joined(df: DataFrame, factors: Sequence[DenseRows], modes: Sequence[int], rank: int) -> DataFrame:
    """The product of the factor rows of all modes as one array ``p``, for ranks too wide for one aggregate."""
    for n, m in enumerate(modes):
        kept = [c for c in df.columns if c not in ("p", f"i{m}")]
        product = F.zip_with("p", f"f{m}", lambda x, y: x * y) if n else F.col(f"f{m}")
        df = df.join(_checked(factors[m], m, rank), f"i{m}").select(*kept, product.alias("p"))
    return df


def mttkrp(t: CooTensor, factors: Sequence[DenseRows], mode: int, method: str = "fiber") -> DenseRows:
    """out[t, r] = sum over entries of v * product over the other modes m of F_m[i_m, r].

    ``method="coo"`` looks factors up per entry; ``method="fiber"`` sums the entries up a tree of
    prefixes and looks a factor row up once per node. Wider ranks than MAX_FUSED_WIDTH carry products as arrays, and
    the second then groups the entries that differ only in the target index, multiplies once per
    group and opens it. Target ids that do not occur in the tensor are absent. The target's own factor is
    only checked.
    """
    rank = require_factors(t, factors, mode)
    others = [m for m in range(t.order) if m != mode]
    if method not in ("coo", "fiber"):
        raise ValueError(f"unknown method {method!r} for mttkrp: use 'fiber' or 'coo'")
    target = f"i{mode}"
    if others and 0 < rank <= MAX_FUSED_WIDTH:
        sums = (_cell_sums if method == "coo" else _tree_sums)(t, factors, mode, others, rank)
        rows = sums.select(target, F.array(*[f"s{r}" for r in range(rank)]).alias("row"))
        return DenseRows(rows.withColumnRenamed(target, "i"), t.shape[mode], rank)
    if method == "coo":
        joined = _joined(t.df, factors, others, rank)
    else:
        target = "t"
        fibers = _joined(tensor_fibers(t, mode), factors, others, rank)
        joined = fibers.selectExpr(*["p"] * bool(others), "inline(cells) as (t, v)")
    rows = sum_rows(joined, target, lambda r: F.col("v") * F.get("p", r) if others else F.col("v"), rank)
    return DenseRows(rows.withColumnRenamed(target, "i"), t.shape[mode], rank)

"""Matrix x vector and matrix x matrix products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, DenseRows, PackedMatrix, Vector
from cellframe.operators.layout import LOOKUP, pack_cols, pack_rows, packed_dot, unpack
from cellframe.plans import fanout
from cellframe.plans.lookup import look_up
from cellframe.session import write_through

FORMATS = ("coo", "csr", "csc", "csr_csc")
# Whole-stage code generation stops at 100 columns (spark.sql.codegen.maxFields).
MAX_FUSED_WIDTH = 64


def require_compatible(op: str, left: tuple[int, int], right: tuple[int, int]) -> None:
    if left[1] != right[0]:
        raise ValueError(
            f"incompatible dimensions for {op}: left is {left[0]}x{left[1]}, "
            f"right is {right[0]}x{right[1]} (the left columns must equal the right rows)"
        )


def _entries(x: Vector) -> DataFrame:
    """x as ``<j, xv>``, one entry per index, so that the join with it has a fan-out of one."""
    df = x.df.select(F.col("i").alias("j"), F.col("v").alias("xv"))
    # Sums are written first, so that Spark splits a column with very many cells in the join with them.
    return df if x.unique else write_through(df.groupBy("j").agg(F.sum("xv").alias("xv")), "entries")


def spmv(a: CooMatrix | PackedMatrix, x: Vector, format: str = "coo") -> Vector:
    """y = A x.

    A sparse x is joined: rows of A that meet no entry of x are absent. A dense x reads 0.0
    where it has no entry, so every non-empty row of A is present. Dimensions are not checked.
    """
    if format not in ("coo", "csr"):
        raise ValueError(f"unknown format {format!r} for spmv: use 'coo' or 'csr'")
    if isinstance(a, CooMatrix) and format == "csr":
        a = pack_rows(a)
    if isinstance(a, PackedMatrix):
        if a.axis == "row":
            entries = x if x.unique or x.length <= LOOKUP else Vector(
                _entries(x).toDF("i", "v"), x.length, x.dense, unique=True)
            return Vector(packed_dot(a, entries), a.n_rows, unique=True)
        a = unpack(a)
    if x.dense:
        joined = a.df.join(_entries(x), "j", "left")
        term = F.col("v") * F.coalesce("xv", F.lit(0.0))
    else:
        joined = a.df.join(_entries(x), "j")
        term = F.col("v") * F.col("xv")
    return Vector(joined.groupBy("i").agg(F.sum(term).alias("v")), a.n_rows, unique=True)


def spmv_sql(a: CooMatrix, x: Vector) -> DataFrame:
    """A x, sparse x, as SQL text over the two frames."""
    return a.df.sparkSession.sql(
        "SELECT a.i, SUM(a.v * x.v) AS v FROM {a} a JOIN {x} x ON a.j = x.i GROUP BY a.i", a=a.df, x=x.df)


def _left(m: CooMatrix) -> DataFrame:
    return m.df.select(F.col("j").alias("k"), "i", F.col("v").alias("va"))


def _right(m: CooMatrix) -> DataFrame:
    return m.df.select(F.col("i").alias("k"), "j", F.col("v").alias("vb"))


def _sum_cells(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("i", "j").agg(F.sum(F.col("va") * F.col("vb")).alias("v"))


def _coo_product(a: CooMatrix | PackedMatrix, b: CooMatrix | PackedMatrix, fan: fanout.FanOut | None = None) -> DataFrame:
    left, right, keys = _spread(a, b, fan)
    return _sum_cells(left.join(right, keys))


def _spread(a: CooMatrix | PackedMatrix, b: CooMatrix | PackedMatrix,
            fan: fanout.FanOut | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    return fanout.spread(_left(_coo(a)), _right(_coo(b)), a.unique, b.unique, float(a.n_rows) * b.n_cols,
                         fan or _measure(a, b))


def bounded_product(a: CooMatrix, b: CooMatrix, cells_a: int, cells_b: int) -> tuple[CooMatrix, int] | None:
    """A B laid out from the cell counts alone, and how many cells it has at most; None where that is not safe."""
    left, right, unique_a, unique_b = _left(a), _right(b), a.unique, b.unique
    # A small matrix with duplicates has them summed first, without which there is no bound.
    if not unique_b and min(cells_b, a.n_cols * b.n_cols) <= fanout.MIN_PAIRS_PER_TASK:
        right, unique_b = fanout.merge_cells(right, "j", "vb"), True
    elif not unique_a and min(cells_a, a.n_rows * a.n_cols) <= fanout.MIN_PAIRS_PER_TASK:
        left, unique_a = fanout.merge_cells(left, "i", "va"), True
    cells_a = min(cells_a, a.n_rows * a.n_cols) if unique_a else cells_a
    cells_b = min(cells_b, b.n_rows * b.n_cols) if unique_b else cells_b
    most = fanout.most_pairs(cells_a, cells_b, unique_a, unique_b, a.n_rows, b.n_cols)
    layout = fanout.spread_bounded(left, right, cells_a, cells_b, most)
    if layout is None:
        return None
    left, right, keys = layout
    return CooMatrix(_sum_cells(left.join(right, keys)), a.n_rows, b.n_cols, unique=True), min(most, a.n_rows * b.n_cols)


def _measure(a: CooMatrix | PackedMatrix, b: CooMatrix | PackedMatrix) -> fanout.FanOut:
    return fanout.measure(_left(_counted(a)), _right(_counted(b)))


def _counted(m: CooMatrix | PackedMatrix) -> CooMatrix:
    return m.source if isinstance(m, PackedMatrix) and m.source is not None else _coo(m)


def _packed_by_blocks(left: DataFrame, right: DataFrame, side: str, tasks: int, fan: fanout.FanOut) -> DataFrame:
    left, right, keys = fanout.spread_over(left, right, tasks, fan)
    cells, other, cell = (left, right, ("j", "vb")) if side == "right" else (right, left, ("i", "va"))
    packed = other.groupBy(*keys).agg(F.collect_list(F.struct(*cell)).alias("cells"))
    kept = [c for c in cells.columns if c not in keys]
    return _sum_cells(cells.join(packed, keys).selectExpr(*kept, f"inline(cells) as ({', '.join(cell)})"))


def _packed_product(a: CooMatrix | PackedMatrix, b: CooMatrix | PackedMatrix, side: str,
                    fan: fanout.FanOut | None = None) -> DataFrame:
    """Join single cells with packed records and open the records after the join.

    ``side="right"`` packs B by row, so each cell of A meets a whole row of B; ``side="left"`` packs A
    by column. Where one key has more pairs than a task should take, the packed side is packed by block,
    so that its records are cut, and the single cells meet each block.
    """
    left, right = _left(_coo(a)), _right(_coo(b))
    fan = fan or _measure(a, b)
    merging = fan.pairs_per_cell > fanout.MERGE_RATIO and not (a.unique and b.unique)
    if merging:
        left = left if a.unique else fanout.merge_cells(left, "i", "va")
        right = right if b.unique else fanout.merge_cells(right, "j", "vb")
        fan = fanout.measure(left, right)
    tasks = fanout.task_count(left.sparkSession, fan.load)
    if merging or tasks and fan.widest > fanout.task_limit(fan, tasks):
        return _packed_by_blocks(left, right, side, max(1, tasks), fan)
    if side == "right":
        rows = b if isinstance(b, PackedMatrix) and b.axis == "row" else pack_rows(
            _coo(b), longest=fan.longest_right)
        cells, packed, opened = left, rows.df.select(F.col("i").alias("k"), "cells"), "(j, vb)"
        own_id, loose, packed_is_smaller = "i", right, fan.right_cells <= fan.left_cells
    else:
        cols = a if isinstance(a, PackedMatrix) and a.axis == "col" else pack_cols(
            _coo(a), longest=fan.longest_left)
        cells, packed, opened = right, cols.df.select(F.col("j").alias("k"), "cells"), "(i, va)"
        own_id, loose, packed_is_smaller = "j", left, fan.left_cells <= fan.right_cells
    if tasks:
        beside = None
        if packed_is_smaller:
            beside = fanout.beside_broadcast(cells, own_id, loose, fan, tasks, float(a.n_rows) * b.n_cols)
        if beside is not None:
            cells, packed = beside, F.broadcast(packed)
        else:
            cells, packed = cells.repartition(tasks, "k"), packed.repartition(tasks, "k").hint("merge")
    kept = [c for c in cells.columns if c != "k"]
    return _sum_cells(cells.join(packed, "k").selectExpr(*kept, f"inline(cells) as {opened}"))


def _coo(m: CooMatrix | PackedMatrix) -> CooMatrix:
    return unpack(m) if isinstance(m, PackedMatrix) else m


def spmm(a: CooMatrix | PackedMatrix, b: CooMatrix | PackedMatrix, format: str = "coo",
         partitions: int | None = None, fan: fanout.FanOut | None = None) -> CooMatrix:
    """C = A B for sparse A and B, by layout; every layout gives the same matrix.

    "coo" joins cells with cells; "csr" joins cells of A with packed rows of B; "csc" joins packed
    columns of A with cells of B; "csr_csc" takes A packed by rows and B by columns, and since
    neither is packed by the shared index, joins their cells. A cell is present when at least one product fell on it, even if they cancel
    to 0.0. ``partitions`` fixes the number of join tasks instead of deriving it from the work; ``fan`` is
    the product's measurement, if it has been made.
    """
    if format not in FORMATS:
        raise ValueError(f"unknown format {format!r} for spmm: use one of {', '.join(FORMATS)}")
    require_compatible(f"spmm ({format})", (a.n_rows, a.n_cols), (b.n_rows, b.n_cols))
    if partitions is not None:
        left, right, keys = fanout.spread_over(_left(_coo(a)), _right(_coo(b)), partitions, fan or _measure(a, b))
        df = _sum_cells(left.join(right, keys))
    elif format == "csr":
        df = _packed_product(a, b, "right", fan)
    elif format == "csc":
        df = _packed_product(a, b, "left", fan)
    else:
        df = _coo_product(a, b, fan)
    return CooMatrix(df, a.n_rows, b.n_cols, unique=True)


def spmm_sorted(a: CooMatrix, b: CooMatrix) -> DataFrame:
    """A B as a DataFrame ``<i, j, v>`` sorted by (i, j)."""
    return spmm(a, b).df.orderBy("i", "j")


def spmm_sql(a: CooMatrix, b: CooMatrix) -> DataFrame:
    """A B as SQL text over the two frames, which are laid out for the join."""
    require_compatible("spmm (sql)", (a.n_rows, a.n_cols), (b.n_rows, b.n_cols))
    left, right, keys = _spread(a, b)
    return left.sparkSession.sql(
        "SELECT i, j, SUM(va * vb) AS v FROM {a} JOIN {b} USING (" + ", ".join(keys) + ") GROUP BY i, j", a=left, b=right)


def sum_rows(df: DataFrame, key: str, terms, width: int) -> DataFrame:
    """Elementwise sum by ``key`` of rows of ``width`` values: ``<key, row ARRAY<DOUBLE>>``.

    ``terms(r)`` is the r-th value of a record. Up to MAX_FUSED_WIDTH all sums are columns of one
    aggregate; a wider row is summed one record per value and put together again.
    """
    if width == 0:
        return df.select(key).distinct().select(key, F.array().cast("array<double>").alias("row"))
    if width <= MAX_FUSED_WIDTH:
        sums = [F.sum(terms(F.lit(r))).alias(f"s{r}") for r in range(width)]
        return df.groupBy(key).agg(*sums).select(
            key, F.array(*[f"s{r}" for r in range(width)]).alias("row"))
    values = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), terms)
    return (
        df.select(key, F.posexplode(values).alias("r", "v"))
        .groupBy(key, "r").agg(F.sum("v").alias("v"))
        .groupBy(key).agg(F.sort_array(F.collect_list(F.struct("r", "v"))).alias("cells"))
        .select(key, F.transform("cells", lambda c: c["v"]).alias("row"))
    )


def spmm_dense(a: CooMatrix, d: DenseRows) -> DenseRows:
    """Sparse A times dense D. Rows of A that meet no row of D are absent; short rows count as 0-padded."""
    require_compatible("spmm (coo x dense)", (a.n_rows, a.n_cols), (d.n_rows, d.n_cols))
    rows = d.df.select(F.col("i").alias("j"), "row")
    joined = look_up(a.df, rows, "j", d.n_rows * d.n_cols)

    def term(r):
        return F.col("v") * F.coalesce(F.get("row", r), F.lit(0.0))

    return DenseRows(sum_rows(joined, "i", term, d.n_cols), a.n_rows, d.n_cols)

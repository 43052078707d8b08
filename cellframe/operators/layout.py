"""Layout conversions between coordinate, row-packed, column-packed and fiber form."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, CooTensor, DenseRows, PackedMatrix, Vector
from cellframe.session import write_through

MAX_CELLS = 1_000_000
# Values of a vector that goes to packed rows as one array: 8 MB.
LOOKUP = 1 << 20


def merge_duplicates(m: CooMatrix) -> CooMatrix:
    """Sum the values of equal coordinates."""
    if m.unique:
        return m
    summed = m.df.groupBy("i", "j").agg(F.sum("v").alias("v"))
    return CooMatrix(summed, m.n_rows, m.n_cols, unique=True)


def drop_zeros(m: CooMatrix) -> CooMatrix:
    """Keep the cells whose value is not 0 (NaN stays)."""
    return m.with_df(m.df.where(F.col("v") != 0))


def repartition_matrix(m: CooMatrix, n: int, *keys: str) -> CooMatrix:
    return m.with_df(m.df.repartition(n, *keys))


def _pack(df: DataFrame, keys: list[str], other: str, max_cells: int, longest: int | None) -> DataFrame:
    """``<keys, seg, cells>``: the cells of each key in order of (other, v), ``max_cells`` to a record.

    Record ``seg`` starts at position seg * max_cells of its key.
    """
    if longest is None:
        longest = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    whole = F.sort_array(F.collect_list(F.struct(other, "v"))).alias("cells")
    if longest <= max_cells:
        return df.groupBy(*keys).agg(F.lit(0).cast("bigint").alias("seg"), whole)
    # Some key has too many cells for one record. Lengths are written first, so that Spark splits such a
    # key in the joins with them.
    lengths = write_through(df.groupBy(*keys).agg(F.count("*").alias("total")), "lengths")
    long_keys = lengths.where(F.col("total") > max_cells).select(*keys)
    short = df.join(lengths.where(F.col("total") <= max_cells).select(*keys), keys, "left_semi")
    short = short.groupBy(*keys).agg(F.lit(0).cast("bigint").alias("seg"), whole)
    # Equal cells are counted before they move. Ranges of (key, other, v) hold near equal numbers of them;
    # a cell's position is its place in its range plus the cells of the key in earlier ranges.
    counted = df.join(long_keys, keys, "left_semi").groupBy(*keys, other, "v").agg(F.count("*").alias("n"))
    ranges = write_through(
        counted.repartitionByRange(*keys, other, "v").withColumn("part", F.spark_partition_id()), "ranges")
    in_part = Window.partitionBy(*keys, "part").orderBy(other, "v").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = write_through(ranges.groupBy(*keys, "part").agg(F.sum("n").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n"), "before")
    start = F.col("before") + F.coalesce(F.sum("n").over(in_part), F.lit(0))
    placed = ranges.join(before, [*keys, "part"]).select(*keys, other, "v", "n", start.alias("start"))
    runs = placed.select(*keys, other, "v", "n", "start", F.explode(F.sequence(
        F.expr(f"start div {max_cells}"), F.expr(f"(start + n - 1) div {max_cells}"))).alias("seg"))
    low, high = F.greatest("start", F.col("seg") * max_cells), F.least(F.col("start") + F.col("n"), (F.col("seg") + 1) * max_cells)
    repeated = F.flatten(F.transform(
        "runs", lambda x: F.array_repeat(F.struct(x[other].alias(other), x["v"].alias("v")), x["len"])))
    cut = (
        runs.withColumn("len", (high - low).cast("int"))
        .groupBy(*keys, "seg").agg(F.sort_array(F.collect_list(F.struct(other, "v", "len"))).alias("runs"))
        .select(*keys, "seg", repeated.alias("cells"))
    )
    return short.unionByName(cut)


def positions(packed: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """Packed records opened: ``pos`` is a cell's place among all cells of its key, and ``c`` the cell."""
    kept = [c for c in packed.columns if c not in ("seg", "cells")]
    return packed.select(*kept, "seg", F.posexplode("cells").alias("at", "c")).select(
        *kept, (F.col("seg") * max_cells + F.col("at")).alias("pos"), "c")


def _bounded(width: int, m: CooMatrix, max_cells: int, longest: int | None) -> int | None:
    """A bound of the longest row where the dimensions give one that needs no cut."""
    return width if longest is None and m.unique and width <= max_cells else longest


def pack_rows(m: CooMatrix, max_cells: int = MAX_CELLS, longest: int | None = None) -> PackedMatrix:
    """One record per row, its cells sorted by column, duplicates kept.

    A row with more than ``max_cells`` cells is held in several records (``seg`` 0, 1, ...), consecutive
    stretches of it, so that no task has to hold an unbounded row. ``longest`` is the length of the longest
    row; it is counted when not given.
    """
    return PackedMatrix(_pack(m.df, ["i"], "j", max_cells, _bounded(m.n_cols, m, max_cells, longest)), m.n_rows, m.n_cols, "row", m.unique, m)


def pack_cols(m: CooMatrix, max_cells: int = MAX_CELLS, longest: int | None = None) -> PackedMatrix:
    """One record per column, its cells sorted by row; see :func:`pack_rows`."""
    return PackedMatrix(_pack(m.df, ["j"], "i", max_cells, _bounded(m.n_rows, m, max_cells, longest)), m.n_rows, m.n_cols, "col", m.unique, m)


def unpack(p: PackedMatrix) -> CooMatrix:
    """Back to coordinate form."""
    key, other = ("i", "j") if p.axis == "row" else ("j", "i")
    cells = p.df.selectExpr(key, f"inline(cells) as ({other}, v)").select("i", "j", "v")
    return CooMatrix(cells, p.n_rows, p.n_cols, p.unique)


def _lookup(x: Vector) -> Column:
    """A vector of at most LOOKUP values as one array, null where it has no entry: 8 bytes a value."""
    spark, entries = x.df.sparkSession, x.df
    if not x.unique:
        entries = entries.groupBy("i").agg(F.sum("v").alias("v"))
    places = spark.range(x.length).withColumnRenamed("id", "i").join(entries, "i", "left")
    in_order = F.sort_array(F.collect_list(F.struct("i", "v")))
    return places.agg(F.transform(in_order, lambda e: e["v"])).scalar()


def packed_dot(p: PackedMatrix, x: Vector) -> DataFrame:
    """Dot product of each packed row with a sparse or dense vector: ``<i, v>``.

    A vector of at most LOOKUP values goes to the rows as one array. Nothing is joined then, and since packing
    has put a row's records in one task, opening and summing its cells needs no further shuffle. Entries
    at or beyond the vector's length are not read. A longer vector is joined: cells are shuffled by
    column where Spark finds the vector too large to broadcast, and summed by row.
    """
    if p.axis != "row":
        raise ValueError("a row dot product needs a row-packed matrix")
    cells = p.df.selectExpr("i", "inline(cells) as (j, v)")
    if 0 < x.length <= LOOKUP:
        at = F.when(F.col("j").between(0, x.length - 1), F.col("j").cast("int"))
        met = cells.select("i", "v", F.get(_lookup(x), at).alias("xv"))
        if not x.dense:
            met = met.where("xv IS NOT NULL")
    else:
        entries = x.df.select(F.col("i").alias("j"), F.col("v").alias("xv"))
        met = cells.join(entries, "j", "left" if x.dense else "inner")
    value = F.coalesce("xv", F.lit(0.0)) if x.dense else F.col("xv")
    return met.groupBy("i").agg(F.sum(F.col("v") * value).alias("v"))


def csr_row_dot(p: PackedMatrix, x: Vector) -> DataFrame:
    """Dot product of each packed row with x read as dense: every row is present; see :func:`packed_dot`."""
    return packed_dot(p, replace(x, dense=True))


def scale_rows(d: DenseRows, by: Vector) -> DenseRows:
    """Multiply each dense row by the vector's value at that row."""
    scale = by.df.select("i", F.col("v").alias("s"))
    rows = d.df.join(scale, "i").select("i", F.transform("row", lambda x: x * F.col("s")).alias("row"))
    return DenseRows(rows, d.n_rows, d.n_cols)


def merge_tensor(t: CooTensor) -> CooTensor:
    """Sum the values of equal coordinates."""
    if t.unique:
        return t
    return CooTensor(t.df.groupBy(*t.modes).agg(F.sum("v").alias("v")), t.shape, unique=True)


def tensor_fibers(t: CooTensor, target: int, max_cells: int = MAX_CELLS) -> DataFrame:
    """Group a tensor by all modes but ``target``: ``<other modes, seg, cells ARRAY<STRUCT<t, v>>>``.

    Duplicates are summed and cells sorted by t. A fiber with more than ``max_cells`` cells, which takes a
    mode that long, is held in several consecutive records.
    """
    prefix = [c for m, c in enumerate(t.modes) if m != target]
    cells = merge_tensor(t).df.withColumnRenamed(f"i{target}", "t")
    if not prefix:  # one fiber: the key is a constant
        return _pack(cells.withColumn("_one", F.lit(0)), ["_one"], "t", max_cells, t.shape[target]).drop("_one")
    longest = None if t.shape[target] > max_cells else t.shape[target]
    return _pack(cells, prefix, "t", max_cells, longest)

"""The data model: a DataFrame in coordinate form plus its dimensions.

A cell that is not listed is 0. A coordinate that is listed more than once means the sum of its
values. ``unique=True`` records that every coordinate is known to occur once, which lets the
products skip merging duplicates; it is set on everything that comes out of a grouped sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATRIX_SCHEMA = "i bigint, j bigint, v double"
VECTOR_SCHEMA = "i bigint, v double"
DENSE_SCHEMA = "i bigint, row array<double>"


def _max_plus_one(df: DataFrame, *cols: str) -> list[int]:
    """Largest id + 1 of each column, all in one job."""
    found = df.agg(*[F.max(c).alias(c) for c in cols]).first()
    if any(found[c] is None for c in cols):
        raise ValueError("cannot infer dimensions: the input has no valid entry")
    return [int(found[c]) + 1 for c in cols]


@dataclass(frozen=True)
class CooMatrix:
    """Sparse matrix ``<i, j, v>``."""

    df: DataFrame
    n_rows: int
    n_cols: int
    unique: bool = False

    @classmethod
    def of(cls, df: DataFrame, n_rows: int | None = None, n_cols: int | None = None,
           unique: bool = False) -> CooMatrix:
        """Wrap a DataFrame with columns i, j, v; dimensions not given are read off the ids."""
        df = df.select(F.col("i").cast("bigint"), F.col("j").cast("bigint"), F.col("v").cast("double"))
        if n_rows is None or n_cols is None:
            rows, cols = _max_plus_one(df, "i", "j")
            n_rows = rows if n_rows is None else n_rows
            n_cols = cols if n_cols is None else n_cols
        return cls(df, int(n_rows), int(n_cols), unique)

    @classmethod
    def from_cells(cls, spark: SparkSession, cells: Sequence[tuple], n_rows: int, n_cols: int) -> CooMatrix:
        rows = [(int(i), int(j), float(v)) for i, j, v in cells]
        return cls(spark.createDataFrame(rows, MATRIX_SCHEMA), n_rows, n_cols)

    @property
    def T(self) -> CooMatrix:
        swapped = self.df.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")
        return CooMatrix(swapped, self.n_cols, self.n_rows, self.unique)

    def register(self, name: str) -> CooMatrix:
        self.df.createOrReplaceTempView(name)
        return self

    def with_df(self, df: DataFrame) -> CooMatrix:
        return replace(self, df=df)


@dataclass(frozen=True)
class Vector:
    """Vector ``<i, v>``.

    ``dense`` says how a missing entry is meant in a product: a sparse vector joins (rows that
    meet no entry are absent from the result), a dense one reads 0.0 there.
    """

    df: DataFrame
    length: int
    dense: bool = False
    unique: bool = False

    @classmethod
    def of(cls, df: DataFrame, length: int | None = None, dense: bool = False,
           unique: bool = False) -> Vector:
        df = df.select(F.col("i").cast("bigint"), F.col("v").cast("double"))
        if length is None:
            (length,) = _max_plus_one(df, "i")
        return cls(df, int(length), dense, unique)

    @classmethod
    def from_entries(cls, spark: SparkSession, entries: Sequence[tuple], length: int) -> Vector:
        rows = [(int(i), float(v)) for i, v in entries]
        return cls(spark.createDataFrame(rows, VECTOR_SCHEMA), length)

    @classmethod
    def from_values(cls, spark: SparkSession, values: Sequence[float]) -> Vector:
        """A dense vector from values the caller holds locally."""
        rows = [(i, float(v)) for i, v in enumerate(values)]
        return cls(spark.createDataFrame(rows, VECTOR_SCHEMA), len(rows), dense=True, unique=True)

    def register(self, name: str) -> Vector:
        self.df.createOrReplaceTempView(name)
        return self


@dataclass(frozen=True)
class DenseRows:
    """Dense matrix held one row per record: ``<i, row ARRAY<DOUBLE>>``."""

    df: DataFrame
    n_rows: int
    n_cols: int

    @classmethod
    def from_rows(cls, spark: SparkSession, rows: Sequence[Sequence[float]]) -> DenseRows:
        records = [(i, [float(x) for x in row]) for i, row in enumerate(rows)]
        width = len(records[0][1]) if records else 0
        return cls(spark.createDataFrame(records, DENSE_SCHEMA), len(records), width)

    def cells(self) -> DataFrame:
        """One record per value: ``<i, r, v>``."""
        return self.df.select("i", F.posexplode("row").alias("r", "v")).select(
            "i", F.col("r").cast("bigint").alias("r"), "v")


@dataclass(frozen=True)
class PackedMatrix:
    """Row-packed (``axis="row"``) or column-packed (``axis="col"``) sparse matrix.

    Row-packed: ``<i, seg, cells ARRAY<STRUCT<j, v>>>``; column-packed: ``<j, seg, cells
    ARRAY<STRUCT<i, v>>>``. ``seg`` is 0 unless a row (column) is too long for one record.
    ``source`` is the matrix it was packed from, if any; counting its cells needs no packing.
    """

    df: DataFrame
    n_rows: int
    n_cols: int
    axis: str
    unique: bool = False
    source: CooMatrix | None = None


@dataclass(frozen=True)
class CooTensor:
    """N-way sparse tensor ``<i0, ..., i(N-1), v>`` with its shape."""

    df: DataFrame
    shape: tuple[int, ...]
    unique: bool = False

    def __post_init__(self) -> None:
        if not self.shape:
            raise ValueError("a tensor needs at least one dimension")

    @property
    def order(self) -> int:
        return len(self.shape)

    @property
    def modes(self) -> list[str]:
        return [f"i{m}" for m in range(self.order)]

    @classmethod
    def from_entries(cls, spark: SparkSession, entries: Sequence[tuple], shape: Sequence[int]) -> CooTensor:
        """``entries`` are pairs (coordinates, value)."""
        shape = tuple(int(s) for s in shape)
        schema = "".join(f"i{m} bigint, " for m in range(len(shape))) + "v double"
        rows = [(*[int(c) for c in coords], float(v)) for coords, v in entries]
        return cls(spark.createDataFrame(rows, schema), shape)

    @classmethod
    def from_coords(cls, df: DataFrame, shape: Sequence[int]) -> CooTensor:
        """From ``<coords ARRAY, v>``."""
        shape = tuple(int(s) for s in shape)
        modes = [F.col("coords")[m].cast("bigint").alias(f"i{m}") for m in range(len(shape))]
        return cls(df.select(*modes, F.col("v").cast("double")), shape)

    def with_coords(self) -> DataFrame:
        """As ``<coords ARRAY<BIGINT>, v>``."""
        return self.df.select(F.array(*self.modes).alias("coords"), "v")

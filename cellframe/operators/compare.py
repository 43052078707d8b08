"""Difference and quality checks. Each returns a one-row DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, DenseRows, Vector


def _max_diff(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    # a - b as one grouped sum: the full outer join with zero fill, without a join to skew,
    # and duplicates on either side count as their sum.
    signed = a.select(*keys, "v").unionByName(b.select(*keys, (-F.col("v")).alias("v")))
    diff = signed.groupBy(*keys).agg(F.sum("v").alias("d"))
    return diff.agg(F.coalesce(F.max(F.abs("d")), F.lit(0.0)).alias("max_diff"))


def vector_max_diff(a: Vector, b: Vector) -> DataFrame:
    """Largest absolute difference; a missing entry is 0; 0.0 for two empty vectors."""
    return _max_diff(a.df, b.df, ["i"])


def matrix_max_diff(a: CooMatrix, b: CooMatrix) -> DataFrame:
    """Largest absolute difference; a missing cell is 0."""
    return _max_diff(a.df, b.df, ["i", "j"])


def dense_max_diff(a: DenseRows, b: DenseRows) -> DataFrame:
    """Largest absolute difference of rows present in both, over their common length."""
    n = F.least(F.size("ra"), F.size("rb"))
    diffs = F.zip_with(F.slice("ra", F.lit(1), n), F.slice("rb", F.lit(1), n), lambda x, y: F.abs(x - y))
    joined = a.df.withColumnRenamed("row", "ra").join(b.df.withColumnRenamed("row", "rb"), "i")
    return joined.agg(F.coalesce(F.max(F.array_max(diffs)), F.lit(0.0)).alias("max_diff"))


def nonfinite_count(v: DataFrame) -> DataFrame:
    """How many values of column v are NaN or infinite."""
    bad = F.isnan("v") | (F.abs("v") == float("inf"))
    return v.agg(F.count_if(bad).alias("bad"))

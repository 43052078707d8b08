"""Text writers. They replace what is at the path, as directories of part files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellframe.model import CooMatrix, CooTensor, DenseRows, Vector


def _write_lines(df: DataFrame, line: Column, path: str) -> None:
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def _joined(*columns: str) -> Column:
    return F.concat_ws(",", *[F.col(c).cast("string") for c in columns])


def _whole(line: Column, missing: Column) -> Column:
    """The line, or an error where something is missing: a line cannot say so, and would be read as another.

    It is part of the written column, not a filter, which could run ahead of the filters of the input.
    """
    return F.when(missing, F.raise_error(F.lit("a null cannot be written as text"))).otherwise(line)


def _line(*columns: str) -> Column:
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return _whole(_joined(*columns), missing)


def write_coo(m: CooMatrix, path: str) -> None:
    """Lines ``i,j,v``."""
    _write_lines(m.df, _line("i", "j", "v"), path)


def write_vector(x: Vector, path: str) -> None:
    """Lines ``i,v``."""
    _write_lines(x.df, _line("i", "v"), path)


def write_dense_rows(d: DenseRows, path: str) -> None:
    """One comma-separated line per row, in row order."""
    line = F.concat_ws(",", F.transform("row", lambda x: x.cast("string")))
    missing = F.col("i").isNull() | F.col("row").isNull() | F.exists("row", lambda x: x.isNull())
    _write_lines(d.df.orderBy("i"), _whole(line, missing), path)


def write_tensor(t: CooTensor, path: str) -> None:
    """A shape header and lines ``i0,i1,...,v``."""
    header = "# Shape: " + ",".join(str(s) for s in t.shape)
    lines = t.df.select(_line(*t.modes, "v").alias("value"))
    head = t.df.sparkSession.createDataFrame([(header,)], "value string")
    head.unionByName(lines).write.mode("overwrite").text(path)

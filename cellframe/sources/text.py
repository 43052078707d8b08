"""Text readers for matrices, vectors, dense rows and tensors."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from cellframe.functions import parsing as P
from cellframe.model import CooMatrix, CooTensor, DenseRows, Vector
from cellframe.session import write_through


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(P.trimmed(F.col("value")).alias("line"))


def _records(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """Lines of ids and a value v. A line is kept when its fields parse; a blank or a comment never does."""
    f = P.once(P.fields(F.col("line"), P.CELL_DELIMITERS)).alias("f")
    parsed = [P.as_integer(F.get("f", F.lit(n))).alias(name) for n, name in enumerate(ids)]
    parsed.append(P.as_number(F.get("f", F.lit(len(ids)))).alias("v"))
    records = _lines(spark, path).select(f).select(P.once(F.struct(*parsed)).alias("p")).select("p.*")
    return records.where(" and ".join(f"{c} is not null" for c in [*ids, "v"]))


def read_coo(spark: SparkSession, path: str, n_rows: int | None = None,
             n_cols: int | None = None) -> CooMatrix:
    """Lines ``i,j,v``. Lines that do not fit, headers among them, are dropped; further fields are
    ignored. Dimensions not given are the largest id + 1, and then an empty input is an error."""
    return CooMatrix.of(_records(spark, path, ["i", "j"]), n_rows, n_cols)


def read_vector(spark: SparkSession, path: str, length: int | None = None) -> Vector:
    """Lines ``i,v``; see :func:`read_coo`."""
    return Vector.of(_records(spark, path, ["i"]), length)


def _kept_lines(spark: SparkSession, path: str, keep: Column) -> DataFrame:
    """``<file, start, id, line>`` of the kept lines, from one scan that is written down.

    Where a file is cut depends on the cores at hand when a scan starts, so a second scan could be cut
    elsewhere; everything that numbers lines reads this one. Ids rise along each block.
    """
    return write_through(
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("id"), P.trimmed(F.col("value")).alias("line"))
        .where(keep), "lines")


def _numbered(lines: DataFrame) -> DataFrame:
    """Kept lines with their ordinal over all files: ``<i, line>``.

    It is enough to number the lines of each block (file, start offset), add the blocks' counts up in
    file order, and look up each line's block: no sort of the lines over files, and the only ordered
    table has one row per file. The block table has one row per scan split; Spark broadcasts it while it is
    small and otherwise shuffles the lines by block, which are of even size.
    """
    blocks = lines.groupBy("file", "start").agg(F.count("*").alias("n"))
    in_file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    over_files = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(F.sum("n").alias("total")).select(
        "file", F.coalesce(F.sum("total").over(over_files), F.lit(0)).alias("before"))
    offsets = blocks.join(files, "file").select(
        "file", "start", (F.col("before") + F.coalesce(F.sum("n").over(in_file), F.lit(0))).alias("offset"))
    in_block = Window.partitionBy("file", "start").orderBy("id")
    placed = lines.withColumn("k", F.row_number().over(in_block) - 1).join(offsets, ["file", "start"], "left")
    lost = F.raise_error(F.concat(F.lit("a line lost its block: "), "line"))
    return placed.where(F.when(F.col("offset").isNull(), lost).otherwise(F.lit(True))).select(
        (F.col("k") + F.col("offset")).alias("i"), "line")


def _line_count_and_width(lines: DataFrame, width: Column) -> tuple[int, int]:
    """The number of lines and the width of the first one, without numbering them."""
    found = lines.agg(F.count("*").alias("n"), F.min_by(width, F.struct("file", "start", "id")).alias("w")).first()
    if not found.n:
        raise ValueError("cannot infer dimensions: the input has no valid line")
    return int(found.n), int(found.w)


def read_dense_csv(spark: SparkSession, path: str, n_rows: int | None = None,
                   n_cols: int | None = None) -> CooMatrix:
    """A dense matrix, one row per line, as its non-zero cells. Fields that are not numbers are
    skipped. Dimensions not given are the number of lines and the width of the first one."""
    lines = _kept_lines(spark, path, P.is_data(F.col("line")))
    fields = P.fields(F.col("line"), P.CELL_DELIMITERS)
    rows = _numbered(lines).select("i", P.once(fields).alias("f"))
    if n_rows is None or n_cols is None:
        count, width = _line_count_and_width(lines, F.size(fields))
        n_rows = count if n_rows is None else n_rows
        n_cols = width if n_cols is None else n_cols
    cells = (
        rows.select("i", F.posexplode("f").alias("j", "x"))
        .select("i", F.col("j").cast("bigint").alias("j"), P.as_number(F.col("x")).alias("v"))
        .where("v <> 0")
    )
    return CooMatrix(cells, n_rows, n_cols, unique=True)


def read_dense_rows(spark: SparkSession, path: str, n_rows: int | None = None,
                    n_cols: int | None = None) -> DenseRows:
    """A dense matrix, one comma-separated row per line, as dense rows. No comments; a field that is
    not a number is an error when the data is read."""
    lines = _kept_lines(spark, path, F.col("line") != "")
    rows = _numbered(lines).select("i", "line", P.once(F.transform(
        P.fields(F.col("line"), P.ROW_DELIMITERS), P.as_number)).alias("row"))
    bad = F.exists("row", lambda x: x.isNull())
    # In a filter the check cannot be pruned away.
    rows = rows.where(F.when(bad, F.raise_error(F.concat(F.lit("not a row of numbers: "), "line")))
                      .otherwise(F.lit(True))).select("i", "row")
    if n_rows is None or n_cols is None:
        count, width = _line_count_and_width(lines, F.size(P.fields(F.col("line"), P.ROW_DELIMITERS)))
        n_rows = count if n_rows is None else n_rows
        n_cols = width if n_cols is None else n_cols
    return DenseRows(rows, n_rows, n_cols)


def _first_header(spark: SparkSession, path: str) -> str | None:
    """The first header in file order.

    It mostly stands at the top of the first file, where the search stops after a few lines. Only when
    that file has none are the files read for it.
    """
    files = sorted(spark.read.text(path).inputFiles())
    if not files:
        return None
    name = re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(files[0]))
    head = spark.read.text(name).select(P.trimmed(F.col("value")).alias("line")).where(
        F.col("line").rlike(P.SHAPE_HEADER)).first()
    if head is not None or len(files) == 1:
        return head and head.line
    place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.col("id"))
    headers = (
        spark.read.text(path)
        .select(P.trimmed(F.col("value")).alias("line"), F.monotonically_increasing_id().alias("id"), "_metadata")
        .where(F.col("line").rlike(P.SHAPE_HEADER))
    )
    return headers.agg(F.min_by("line", place)).first()[0]


def _read_shape(spark: SparkSession, path: str) -> tuple[int, ...]:
    line = _first_header(spark, path)
    if line is None:
        raise ValueError(f"no `# Shape:` line found in {path}")
    rest = re.match(P.SHAPE_HEADER, line).group(1)
    dims = [d for d in re.split(f"[{P.TENSOR_DELIMITERS}]", rest) if d]
    if not dims:
        raise ValueError("a tensor needs at least one dimension")
    for d in dims:
        if not re.match(P.INTEGER, d):
            raise ValueError(f"dimension `{d}` is not an integer in `{line}`")
    return tuple(int(d) for d in dims)


def read_tensor(spark: SparkSession, path: str) -> CooTensor:
    """A ``# Shape: n0,n1,...`` header and lines ``i0,i1,...,v``. Zeros are dropped; a line that does
    not fit the shape is an error when the data is read."""
    shape = _read_shape(spark, path)
    order = len(shape)
    modes = [f"i{m}" for m in range(order)]
    words = P.once(P.words(F.col("line"), P.TENSOR_DELIMITERS)).alias("f")
    record = F.struct(
        F.size("f").alias("n"), *[P.as_integer(F.get("f", F.lit(m))).alias(c) for m, c in enumerate(modes)],
        P.as_number(F.get("f", F.lit(order))).alias("v"))
    parsed = (
        _lines(spark, path).where(P.is_data(F.col("line"))).select("line", words)
        .select("line", P.once(record).alias("p")).select("line", "p.*")
    )

    def fail(text: str) -> Column:
        return F.raise_error(F.concat(F.lit(text + " in `"), "line", F.lit("`")))

    check = F.when(F.col("n") != order + 1, fail(f"expected {order} indices plus a value"))
    for m, size in enumerate(shape):
        check = check.when(F.col(f"i{m}").isNull(), fail(f"index of mode {m} is not an integer"))
        check = check.when(~F.col(f"i{m}").between(0, size - 1), fail(f"index out of bounds for mode {m} of size {size}"))
    check = check.when(F.col("v").isNull(), fail("value is not numeric"))
    valid = parsed.where(check.otherwise(F.lit(True)))
    return CooTensor(valid.where("v <> 0").select(*modes, "v"), shape)

"""Looking up a row for every cell, in tasks that stay small however many cells there are.

Left to itself, Spark sorts the cells of a join in as many tasks as there are cores, so that a task grows with the
table. Where the rows are too many to be broadcast, the cells are counted first and dealt over enough tasks. Cells
that are made from a number need not move at all: they are made where a block of the values is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellframe.model import Vector

# Sorting cells and summing them by the rest of their coordinates takes up to about 230 bytes a cell.
CELLS_PER_TASK = 500_000
# Values of the rows (10 MB) up to which the join is left to Spark, which then mostly broadcasts them.
FEW_VALUES = 1_250_000
# Cells are counted by buckets of their ids, which takes no memory; ids only where a bucket is heavy.
BUCKETS = 1 << 16

# Places of a vector that a task holds as arrays, 9 bytes a place, in a few copies; they are put together by stretches.
BLOCK, STRETCH = 1 << 22, 1 << 10
# Numbers that a task lists at a time, and in all for a block.
LISTED, NUMBERS_PER_TASK = 1 << 18, 1 << 26


def look_up(df: DataFrame, rows: DataFrame, key: str, values: int, cells: DataFrame | None = None) -> DataFrame:
    """``df`` joined with ``rows``, which have one row per ``key`` and ``values`` values in all.

    ``cells`` has at least as many rows of each key as ``df`` and is cheaper to count; ``df`` itself if not given.
    A key with more cells than a task should take is not dealt: its cells stay where they are and meet its row,
    of which there are then few, in a broadcast.
    """
    if values <= FEW_VALUES:
        return df.join(rows, key)
    spark = df.sparkSession
    cells = (df if cells is None else cells).where(F.col(key).isNotNull()).select(
        key, F.pmod(F.hash(key), F.lit(BUCKETS)).alias("bucket"))
    buckets = cells.groupBy("bucket").agg(F.count("*").alias("n"))
    total, widest = buckets.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    tasks = math.ceil(total / CELLS_PER_TASK)
    if tasks <= spark.sparkContext.defaultParallelism:
        return df.join(rows, key)
    hot = []
    if widest > CELLS_PER_TASK:
        heavy = buckets.where(F.col("n") > CELLS_PER_TASK).select("bucket")
        ids = cells.join(F.broadcast(heavy), "bucket", "left_semi").groupBy(key).agg(F.count("*").alias("n"))
        hot = ids.where(F.col("n") > CELLS_PER_TASK).select(key).collect()  # fewer than tasks
    few = F.broadcast(spark.createDataFrame(hot, f"{key} bigint"))
    dealt = (df.join(few, key, "left_anti") if hot else df).where(F.col(key).isNotNull())
    joined = dealt.repartition(tasks, key).join(rows.repartition(tasks, key).hint("merge"), key)
    if not hot:
        return joined
    beside = F.broadcast(rows.join(few, key, "left_semi"))
    return joined.unionByName(df.join(few, key, "left_semi").join(beside, key))


def make_cells(spark: SparkSession, records: int, made: Mapping[str, Column],
               known: Mapping[str, tuple[str, Vector]]) -> DataFrame:
    """Cells made from the numbers ``id`` below ``records``, joined with vectors: ``<made, names of known>``.

    ``known`` has, by the column of ``made`` that is a vector's index, a name for its values and the vector. Cells
    without an entry are dropped. A vector of many values is cut into blocks, and the cells are made once for each: a
    task keeps those that lie in its block, so blocks move and cells do not. Where entries of it repeat, and where it is
    longer than the cells are many, the join is left to Spark.
    """
    placed = [c for c, (_, x) in known.items() if FEW_VALUES < x.length < records and _distinct(x)]
    cells = spark.range(records)
    if placed:
        splits = max(math.ceil(records / NUMBERS_PER_TASK), spark.sparkContext.defaultParallelism)
        cells = spark.range(0, records, LISTED, splits)
        for c in placed:
            cells = cells.crossJoin(_blocks(known[c][1], c).hint("shuffle_replicate_nl"))
        numbers = F.sequence(F.col("id"), F.least(F.col("id") + LISTED, F.lit(records)) - 1)
        cells = cells.withColumn("id", F.explode(numbers))
    # Outside its block a cell's place is one where the arrays have nothing.
    place = {c: F.least(F.greatest(made[c] - F.col(f"{c}_first"), F.lit(-1)), F.lit(BLOCK)).cast("int") for c in placed}
    for c in placed:
        cells = cells.where(F.get(f"{c}_held", place[c]))
    cells = cells.select(*[column.alias(c) for c, column in made.items()],
                         *[F.get(f"{c}_values", place[c]).alias(known[c][0]) for c in placed])
    for c, (name, x) in known.items():
        if c not in placed:
            cells = cells.join(x.df.select(F.col("i").alias(c), F.col("v").alias(name)), c)
    return cells.select(*made, *[name for name, _ in known.values()])


def _distinct(x: Vector) -> bool:
    return x.df.groupBy("i").count().where("i IS NOT NULL AND count > 1").isEmpty()


def _blocks(x: Vector, c: str) -> DataFrame:
    """By BLOCK places: the first of them, which have an entry, and the values, in one task a block or so."""
    entries = x.df.select(F.col("i").alias("id"), "v", F.lit(True).alias("held"))
    places = x.df.sparkSession.range(x.length).join(entries, "id", "left").withColumn("held", F.col("held").isNotNull())
    stretches = places.groupBy(F.expr(f"id div {STRETCH}").alias("stretch")).agg(
        F.sort_array(F.collect_list(F.struct("id", "held", "v"))).alias("e")).select("stretch", "e.held", "e.v")
    blocks = stretches.groupBy(F.expr(f"stretch div {BLOCK // STRETCH}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("stretch", "held", "v"))).alias("e"))
    return blocks.select((F.col("block") * BLOCK).alias(f"{c}_first"), F.flatten("e.held").alias(f"{c}_held"),
                         F.flatten("e.v").alias(f"{c}_values")).repartition(math.ceil(x.length / BLOCK), f"{c}_first")

"""Spreading a many-to-many join by the work it causes.

A product joins cells on a shared index k and makes (cells of A at k) x (cells of B at k) pairs. The
pairs, not the bytes of the inputs, are the work, and byte-based planning cannot see them: a key
with 100,000 cells on each side is a few megabytes of input and ten billion pairs. So the key counts
are measured first, with one small aggregate, and the join is laid out from exact numbers:

* both sides are hashed on k over enough tasks for the pairs and merge-joined, which may spill. A key
  with more pairs than one task should take is cut into a grid of blocks, each joined on its own;
* a side of checked size is broadcast where that saves something: when partial sums would be many,
  the other side is hashed on its own output index, so that sums are complete where they are
  made and no second shuffle follows; and a far larger other side need not be hashed on k.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAIRS_PER_TASK = 16_000_000
MIN_PAIRS_PER_TASK = 500_000
CELL_BYTES = 56  # a cell in a broadcast hash table
BROADCAST_BYTES = 64 * 1024 * 1024
SUMS_PER_TASK = 32_000  # half of what the generated hash table of an aggregate holds
# Merging duplicates costs one shuffle of the cells, twice; it pays once a cell meets this many partners.
MERGE_RATIO = 256
# Pairs per cell up to which a bound on the pairs may stand for their count.
BOUND_RATIO = 64


@dataclass(frozen=True)
class FanOut:
    """Exact size of a join on k. ``widest`` is the largest work of one key: its pairs, or its cells
    where the other side has none, since they have to be moved all the same."""

    left_cells: int
    right_cells: int
    pairs: float
    widest: float
    longest_left: int
    longest_right: int
    per_key: DataFrame

    @property
    def load(self) -> float:
        return self.pairs + self.left_cells + self.right_cells

    @property
    def pairs_per_cell(self) -> float:
        return self.pairs / max(1, self.left_cells + self.right_cells)


def _work() -> Column:
    """Work of one key; the works of all keys add up to ``FanOut.load`` at most."""
    return F.greatest(F.col("l"), F.lit(1)).cast("double") * F.greatest(F.col("r"), F.lit(1))


def measure(left: DataFrame, right: DataFrame) -> FanOut:
    """Count the cells per key ``k`` on both sides, in one small job."""
    return measure_all([(left, right)])[0]


def measure_all(products: list[tuple[DataFrame, DataFrame]]) -> list[FanOut]:
    """The same for several products, still in one job."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = [
        side.select(F.lit(n).alias("of"), "k", *counts) for n, (left, right) in enumerate(products)
        for side, counts in ((left, (one.alias("l"), zero.alias("r"))), (right, (zero.alias("l"), one.alias("r"))))
    ]
    cells = sides[0]
    for side in sides[1:]:
        cells = cells.unionByName(side)
    per_key = cells.groupBy("of", "k").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    pairs = F.col("l").cast("double") * F.col("r")
    rows = {row["of"]: row for row in per_key.groupBy("of").agg(
        F.sum("l").alias("l"), F.sum("r").alias("r"), F.sum(pairs).alias("pairs"), F.max(_work()).alias("widest"),
        F.max("l").alias("max_l"), F.max("r").alias("max_r"),
    ).collect()}  # a row for each product
    return [
        FanOut(row.l, row.r, row.pairs, row.widest, row.max_l, row.max_r, per_key.where(F.col("of") == n).drop("of"))
        if (row := rows.get(n)) else FanOut(0, 0, 0.0, 0.0, 0, 0, per_key.where(F.col("of") == n).drop("of"))
        for n in range(len(products))
    ]


def task_count(spark: SparkSession, load: float) -> int:
    """Join tasks for that many pairs and cells, 0 when one task would do.

    The work decides: no task gets more than PAIRS_PER_TASK, however many tasks that takes. The cores known
    now only round the number up to whole waves, while a task keeps MIN_PAIRS_PER_TASK.
    """
    if load <= MIN_PAIRS_PER_TASK:
        return 0
    cores = spark.sparkContext.defaultParallelism
    waves = math.ceil(load / PAIRS_PER_TASK / cores)
    return min(cores * waves, math.ceil(load / MIN_PAIRS_PER_TASK))


def task_limit(fan: FanOut, tasks: int) -> float:
    """The most work of one key that is left in one task."""
    return min(PAIRS_PER_TASK, max(MIN_PAIRS_PER_TASK, fan.load / tasks))


def grid(left_cells: int, right_cells: int, limit: float) -> tuple[int, int]:
    """Cuts of the left and right side so that one block has about ``limit`` pairs.

    The longer side is cut first: every cut of one side copies the other side once more.
    """
    edge = math.sqrt(limit)
    left_cells, right_cells = max(1, left_cells), max(1, right_cells)
    pairs = left_cells * right_cells
    if right_cells <= edge:
        return math.ceil(pairs / limit), 1
    if left_cells <= edge:
        return 1, math.ceil(pairs / limit)
    return math.ceil(left_cells / edge), math.ceil(right_cells / edge)


def hot_key_cuts(spark: SparkSession, fan: FanOut, limit: float) -> DataFrame:
    """``<k, lcuts, rcuts>`` for the keys with more work than ``limit``.

    All keys together have at most ``fan.load`` work, so there are at most load / limit such keys,
    which is no more than the number of join tasks.
    """
    rows = fan.per_key.where(_work() > F.lit(float(limit))).select("k", "l", "r").collect()
    cuts = [(r.k, *grid(r.l, r.r, limit)) for r in rows]
    return spark.createDataFrame(cuts, "k bigint, lcuts int, rcuts int")


def cut_blocks(df: DataFrame, cuts: DataFrame, own: str, own_id: str, other: str) -> DataFrame:
    """Give each cell its block number on its own side and a copy per block of the other side."""
    one = F.lit(1)
    mine = F.pmod(F.xxhash64(own_id), F.coalesce(F.col(own + "cuts"), one)).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other + "cuts"), one) - one)
    kept = df.columns
    return (
        df.join(F.broadcast(cuts), "k", "left")
        .select(*kept, mine.alias(own + "block"), F.explode(copies).alias(other + "block"))
    )


def most_pairs(left_cells: int, right_cells: int, left_unique: bool, right_unique: bool, n_rows: int, n_cols: int) -> int:
    """Pairs that a product with ``n_rows`` and ``n_cols`` has at most, whatever its keys are.

    A cell meets no more cells of a matrix without duplicates than that has output ids.
    """
    most = left_cells * right_cells
    if right_unique:
        most = min(most, left_cells * n_cols)
    if left_unique:
        most = min(most, right_cells * n_rows)
    return most


def spread_bounded(left: DataFrame, right: DataFrame, left_cells: int, right_cells: int, most: int) \
        -> tuple[DataFrame, DataFrame, list[str]] | None:
    """A layout from cell counts and :func:`most_pairs` alone, or None where the keys have to be counted.

    It is good where the bound cannot be far off, since the number of tasks follows it, and where no hot key
    matters: one task does it all, or the smaller side is broadcast and the other one is not hashed.
    """
    tasks = task_count(left.sparkSession, most + left_cells + right_cells)
    if not tasks:
        return left, right, ["k"]
    if most > BOUND_RATIO * (left_cells + right_cells) or min(left_cells, right_cells) * CELL_BYTES > BROADCAST_BYTES:
        return None
    if left_cells < right_cells:
        return F.broadcast(left), right.repartition(tasks) if most > 2 * right_cells else right, ["k"]
    return left.repartition(tasks) if most > 2 * left_cells else left, F.broadcast(right), ["k"]


def merge_cells(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sum the duplicates of (k, key)."""
    return df.groupBy("k", key).agg(F.sum(value).alias(value))


def _widest_row(big: DataFrame, own_id: str, small: DataFrame) -> float:
    """Most work that falls on one value of ``own_id``; ``small`` is within the broadcast limit."""
    partners = small.groupBy("k").agg(F.count("*").cast("double").alias("n"))
    work = F.coalesce("n", F.lit(1.0))
    rows = big.join(F.broadcast(partners), "k", "left").groupBy(own_id).agg(F.sum(work).alias("n"))
    return rows.agg(F.coalesce(F.max("n"), F.lit(0.0))).first()[0]


def beside_broadcast(big: DataFrame, own_id: str, small: DataFrame, fan: FanOut, tasks: int,
                     out_cells: float) -> DataFrame | None:
    """The larger side laid out for a broadcast of the smaller one, or None when that is no gain.

    When partial sums would be many, the larger side is hashed on its own output index: each sum is
    then complete in one task. No index may hold too many pairs for that. Otherwise a broadcast
    only pays when it saves a shuffle of a side that is much larger.
    """
    big_cells, small_cells = max(fan.left_cells, fan.right_cells), min(fan.left_cells, fan.right_cells)
    if small_cells * CELL_BYTES > BROADCAST_BYTES:
        return None
    if tasks * out_cells > 4 * big_cells:
        if _widest_row(big, own_id, small) <= max(MIN_PAIRS_PER_TASK, 2 * fan.load / tasks):
            # Enough tasks for the sums, as long as each still has work for a task.
            sums = math.ceil(min(out_cells, fan.pairs) / SUMS_PER_TASK)
            return big.repartition(max(tasks, min(sums, math.ceil(fan.load / MIN_PAIRS_PER_TASK))), own_id)
    if big_cells < 20 * small_cells:
        return None
    return big.repartition(tasks) if fan.pairs > 2 * big_cells else big


def spread(left: DataFrame, right: DataFrame, left_unique: bool = False, right_unique: bool = False,
           out_cells: float = math.inf, fan: FanOut | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Lay out ``<k, i, va>`` and ``<k, j, vb>`` for their join; returns both and the join keys.

    Where the fan-out calls for it duplicates are summed before they are paired, so there may be
    fewer pairs than in the plain join; a sum over the pairs is the same. ``out_cells`` bounds the
    number of different (i, j); ``fan`` is the measurement, if it has been made.
    """
    spark = left.sparkSession
    fan = fan or measure(left, right)
    mergeable = not (left_unique and right_unique)

    def merged() -> tuple[DataFrame, DataFrame]:
        return (left if left_unique else merge_cells(left, "i", "va"),
                right if right_unique else merge_cells(right, "j", "vb"))

    if mergeable and fan.pairs_per_cell > MERGE_RATIO:
        left, right = merged()
        mergeable = False
        fan = measure(left, right)
    tasks = task_count(spark, fan.load)
    if not tasks:
        return left, right, ["k"]
    if fan.left_cells < fan.right_cells:
        beside = beside_broadcast(right, "j", left, fan, tasks, out_cells)
        if beside is not None:
            return F.broadcast(left), beside, ["k"]
    else:
        beside = beside_broadcast(left, "i", right, fan, tasks, out_cells)
        if beside is not None:
            return beside, F.broadcast(right), ["k"]
    if mergeable and fan.widest > task_limit(fan, tasks):
        left, right = merged()
    return spread_over(left, right, tasks, fan)


def spread_over(left: DataFrame, right: DataFrame, tasks: int, fan: FanOut) -> tuple[DataFrame, DataFrame, list[str]]:
    """Hash both sides on k over a number of tasks, with keys of too much work cut into blocks."""
    limit = task_limit(fan, tasks)
    if fan.widest <= limit:
        return left.repartition(tasks, "k"), right.repartition(tasks, "k").hint("merge"), ["k"]
    cuts = hot_key_cuts(left.sparkSession, fan, limit)
    keys = ["k", "lblock", "rblock"]
    left = cut_blocks(left, cuts, "l", "i", "r").repartition(tasks, *keys)
    right = cut_blocks(right, cuts, "r", "j", "l").repartition(tasks, *keys)
    return left, right.hint("merge"), keys

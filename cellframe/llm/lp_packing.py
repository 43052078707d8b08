"""Packing token sequences into as few windows as possible by a configuration linear program.

Only the histogram of lengths decides: at most one number for each length under the window, whatever the
size of the corpus. A configuration says how often each length stands in one window. The program asks for
the fewest configurations that cover all lengths:

* Multiplicative weights. In each phase every length is to be covered for a share of its number; the shares
  rise to 1. A length's price falls by a constant factor for each step that it is ahead
  and rises for each step that it is behind.
* Pricing. A knapsack dynamic program over the window's tokens gives the most valuable content of every
  capacity at these prices. One table prices a configuration for each length that is behind: the length and
  the best content of the rest. Among equal contents the lengths that are least covered are taken. A step
  covers no length by more than the phase does.
* Rounding. Whole copies of each configuration are taken as far as all its places can be filled; then single
  copies of those with the largest fractions. What is left is a smaller histogram, which is solved again in
  fewer phases, and the last rest is filled longest first.

So every place is filled. Documents are numbered within their length, in parallel over buckets, and find
their place from the numbers: a configuration's copies take consecutive numbers of each of its lengths.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cellframe.llm.packing import END_ID, token_pieces
from cellframe.session import write_through

WINDOW = 4096
#: Shares to cover by the phases of the first program, and of those over what rounding left.
PHASES = tuple(tuple((k + 1) / n for k in range(n)) for n in (8, 4, 2, 1, 1, 1))
#: New prices within a phase.
PRICINGS = 3
DECAY = 0.15
#: Pieces that are numbered in one bucket.
BUCKET = 100_000

PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class Knapsack:
    """The most valuable content of every capacity, any number of each length."""

    def __init__(self, price: np.ndarray):
        """price[l]: of length l, -inf for lengths that are not there."""
        self.price = price
        there = np.flatnonzero(np.isfinite(price))
        self.shortest, self.longest = int(there[0]), int(there[-1])
        self.value = np.zeros(len(price))
        low, value = self.shortest, self.value
        for c in range(low, len(price)):
            high = min(c, self.longest)
            value[c] = max(value[c - 1], (price[low:high + 1] + value[c - high:c - low + 1][::-1]).max())

    def content(self, capacity: int, room: np.ndarray) -> list[int]:
        """Lengths of a best content; of equally good ones, those with the most room."""
        low, out = self.shortest, []
        while capacity >= low:
            high = min(capacity, self.longest)
            value = self.price[low:high + 1] + self.value[capacity - high:capacity - low + 1][::-1]
            best = np.flatnonzero(value >= self.value[capacity] - 1e-9)
            if not len(best):
                # Some tokens stay empty: go on at the next capacity that a length ends.
                capacity = int(np.searchsorted(self.value, self.value[capacity] - 1e-9))
                continue
            length = low + int(best[room[low + best].argmax()])
            out.append(length)
            capacity -= length
        return out


def configurations(number: np.ndarray, phases: tuple[float, ...]) -> dict[tuple, float]:
    """Fractional copies of configurations ((length, times), ...) that cover number[l] pieces of each length l."""
    window = len(number) - 1
    there = np.flatnonzero(number)
    lengths = np.arange(window + 1)
    covered, copies = np.zeros(window + 1), {}
    for share, before in zip(phases, (0, *phases)):
        goal, step = number * share, number * (share - before)
        for _ in range(PRICINGS):
            ahead = np.zeros(window + 1)
            ahead[there] = np.floor((covered[there] - goal[there]) / step[there] + 1e-6) + 1
            price = np.full(window + 1, -np.inf)
            price[there] = lengths[there] / window * np.exp(-DECAY * np.clip(ahead[there], -8, 8))
            knapsack = None
            for length in there[covered[there] < goal[there] * (1 - 1e-9)][::-1].tolist():
                if covered[length] >= goal[length] * (1 - 1e-9):
                    continue
                knapsack = knapsack or Knapsack(price)
                room = np.where(number > 0, (goal + step - covered) / np.maximum(step, 1e-300), -np.inf)
                found, times = np.unique([length, *knapsack.content(window - length, room)], return_counts=True)
                most = min(float((step[found] / times).min()), (goal[length] - covered[length]) / times[found == length][0])
                key = tuple(zip(found.tolist(), times.tolist()))
                copies[key] = copies.get(key, 0.0) + most
                covered[found] += most * times
            if knapsack is None:
                break
    return copies


def _take(left: np.ndarray, plan: list, key: tuple, most: int) -> None:
    n = min(most, *(left[length] // times for length, times in key))
    if n > 0:
        plan.append((int(n), key))
        for length, times in key:
            left[length] -= n * times


def _longest_first(left: np.ndarray) -> tuple:
    """A window filled with the longest pieces left that fit."""
    room, key = len(left) - 1, []
    for length in np.flatnonzero(left)[::-1].tolist():
        times = min(int(left[length]), room // length)
        if times:
            key.append((length, times))
            room -= times * length
    return tuple(key)


def plan_windows(number: np.ndarray, phases: tuple[tuple[float, ...], ...] = PHASES) -> list[tuple[int, tuple]]:
    """[(copies, ((length, times), ...))] with exactly number[l] places of each length l; number has window + 1 entries."""
    left, plan = number.astype(np.int64).copy(), []
    left[0] = 0
    for some in phases:
        if not left.any():
            break
        copies = configurations(left.astype(float), some)
        for key, x in copies.items():
            _take(left, plan, key, int(x + 1e-6))
        fill = {key: sum(length * times for length, times in key) for key in copies}
        for key in sorted(copies, key=lambda key: (-(fill[key] == len(left) - 1), -(copies[key] % 1), -key[-1][0])):
            if fill[key] >= 0.98 * (len(left) - 1):
                _take(left, plan, key, 1)
    while left.any():
        _take(left, plan, _longest_first(left), int(left.max()))
    return plan


@dataclass
class Places:
    """For each length, runs of consecutive piece numbers and where they go."""

    begin: np.ndarray  # runs of length l stand at begin[l]:begin[l + 1]
    first: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(plan: list[tuple[int, tuple]], window: int) -> "Places":
        rows, sequence = [], 0
        for copies, key in plan:
            offset = 0
            for length, times in key:
                rows.append((length, copies * times, sequence, copies, offset))
                offset += length * times
            sequence += copies
        length, size, start, copies, offset = np.array(sorted(rows, key=lambda r: r[0]), np.int64).reshape(-1, 5).T
        begin = np.searchsorted(length, np.arange(window + 2))
        total = np.cumsum(size) - size
        first = total - total[np.minimum(begin[length], len(total) - 1)] if len(rows) else total
        return Places(begin, first, start, copies, offset)

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of piece `number` of each length."""
        run = np.empty(len(length), np.int64)
        for one in np.unique(length):
            mine = np.flatnonzero(length == one)
            low, high = self.begin[one], self.begin[one + 1]
            run[mine] = low + np.searchsorted(self.first[low:high], number[mine], "right") - 1
        within = number - self.first[run]
        return (self.sequence[run] + within % self.copies[run],
                self.offset[run] + within // self.copies[run] * length)


def pack_into_fewest(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                     bucket: int = BUCKET) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document.

    Documents with more than `window` ids are cut into full windows and one rest; each full window is a
    sequence of its own, with a negative id. Each row of `docs` is a document of its own, also one without
    doc_id or with a repeated one; a null or empty text is the closing id alone. Columns other than doc_id
    and text are ignored; an empty table gives an empty result. Equal lengths are interchangeable.
    """
    spark = docs.sparkSession
    # The row number is written with the pieces, so that a task run again numbers them alike.
    pieces = write_through(token_pieces(docs, tokenizer, window, end_id).drop("doc_tokens").select(
        "*", F.expr(f"cast(start div {window} as int)").alias("piece"), F.monotonically_increasing_id().alias("row")), "pieces")
    rests = pieces.where(F.col("length") < window)
    buckets = max(1, -(-rests.count() // bucket))
    rests = rests.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)).cast("int"))
    counts = write_through(rests.groupBy("length", "bucket").agg(F.count("*").alias("n")), "lengths")
    number = np.zeros(window + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():  # one row for each length below the window
        number[length] = n
    places = spark.sparkContext.broadcast(Places.of(plan_windows(number), window))

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("length", "bucket").orderBy("row")
    numbered = (rests.withColumn("number", F.row_number().over(within) - 1).join(base, ["length", "bucket"])
                .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("number")).alias("number")))

    def place(batches):
        for batch in batches:
            sequence, offset = places.value.find(batch["length"].to_numpy(), batch["number"].to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    full = pieces.where(F.col("length") == window).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("row")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    return numbered.mapInArrow(place, PLACED).unionByName(full)

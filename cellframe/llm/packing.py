"""Packing token sequences into windows of a fixed size by best-fit decreasing.

A document's ids (its text's ids and one closing id) are cut into full windows, each a sequence of its
own, and one rest. Rests are packed longest first: a segment tree over remaining capacities finds the
open sequence that the rest fills most tightly, or none, and then a new one is opened. Full windows need
no packing, so only the rests move: one small row per document, dealt by a hash over tasks that each
pack tens of thousands. A task leaves its last few sequences open, which is the price of packing in
parallel and is shared by all it packed.
"""

from __future__ import annotations

import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellframe.llm.bpe_words import encoder, packed
from cellframe.session import write_through

WINDOW = 2048
END_ID = 1
RESTS_PER_TASK = 100_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"


class TightestFit:
    """Open sequences by remaining capacity, found through a segment tree over the capacities.

    Each node counts the open sequences below it; a leaf keeps the sequences of one capacity, last one
    first.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, sequence: int) -> None:
        if capacity:
            self.open[capacity].append(sequence)
            self._add(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The open sequence of least capacity that holds `length`, with that capacity."""
        count, node = self.count, self.leaves + length
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return self.open[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(sequence, offset) of each length; ties keep their order."""
    fit, placed, sequences = TightestFit(window), [(0, 0)] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = fit.take(lengths[k])
        if found is None:
            found, sequences = (sequences, window), sequences + 1
        sequence, capacity = found
        placed[k] = (sequence, window - capacity)
        fit.put(capacity - lengths[k], sequence)
    return placed


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """The pieces of every document: full windows, then one rest. A null text counts as empty."""

    def cut(batches):
        ids_of = encoder(tokenizer).ids
        end = packed([end_id])
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                ids = memoryview(ids_of(text or b"") + end)
                n = len(ids) // 4
                rows += [(doc_id, at, min(window, n - at), zlib.crc32(ids[4 * at:4 * (at + window)]), n)
                         for at in range(0, n, window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 5,
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = END_ID,
                   rests_per_task: int = RESTS_PER_TASK) -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Takes `doc_id` and `text` and ignores other columns. Nulls, empty texts, repeated rows: each row is a
    document of its own; a null or empty text is the closing id alone; a null doc_id is kept. An empty
    table gives an empty result. Sequence ids are unique, not dense.
    """
    pieces = write_through(token_pieces(docs, tokenizer, window, end_id), "pieces")
    tasks = max(1, -(-pieces.where(F.col("length") < window).count() // rests_per_task))

    def place(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        rows = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if rows is None:
            return
        placed = best_fit_decreasing(rows["length"].to_pylist(), window)
        rows = rows.append_column("sequence_id", pa.array([base + s for s, _ in placed], pa.int64()))
        yield from rows.append_column("offset", pa.array([o for _, o in placed], pa.int64())).to_batches()

    # The order within a task is fixed by the data, so that a task run again gives the same sequences.
    return (pieces.repartition(tasks, F.xxhash64("doc_id", "start", "ids_crc32"))
            .sortWithinPartitions("doc_id", "start", "ids_crc32", "length").mapInArrow(place, PLACED))

"""Ranked lexical search of many items over all documents, reversed: documents stream past the items.

The items' terms make a small inverted index (term -> items), which every task holds. Items are dealt over
as many groups as it takes for a group's terms to stay under `INDEX_BYTES`, and each group is a search of
its own; usually there is one group.

1. One pass over the texts counts, for each document, all its terms and those that some item has.
2. Document frequencies, the number of documents and their length are sums over that written table.
3. The term counts stream through the index. A task keeps the best k documents of each item, and only
   those leave it: at most k rows an item from each task.
4. The tasks' lists of an item are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cellframe.session import write_through

K = 10
#: Bytes of the distinct terms of a group of items, which bounds what is broadcast.
INDEX_BYTES = 32 << 20
#: Cells of (document, item) or of (document, term, item) that are scored at a time.
CELLS = 1 << 21
#: Bytes of a text that are cut into terms at a time.
CHUNK = 1 << 20
NO_DOC = np.iinfo(np.int64).max

# ASCII letters and digits and all bytes of other characters belong to terms; A-Z are lowered.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a UTF-8 text."""
    data, counts, at = (text or b"").translate(TERM_BYTES), Counter(), 0
    while at < len(data):
        end = data.find(b" ", at + CHUNK)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Index:
    """Items of each term: those of term t are item[begin[t]:begin[t + 1]], with their repeats."""

    terms: list[bytes]
    begin: np.ndarray
    item: np.ndarray
    repeats: np.ndarray
    n_items: int

    @staticmethod
    def of(items: list[Counter]) -> "Index":
        terms = sorted(set().union(*items))
        number = {t: k for k, t in enumerate(terms)}
        rows = sorted((number[t], i, n) for i, counts in enumerate(items) for t, n in counts.items())
        term, item, repeats = np.array(rows, np.int64).reshape(-1, 3).T
        return Index(terms, np.searchsorted(term, np.arange(len(terms) + 1)), item, repeats, len(items))


class Heaps:
    """The k best documents of each item: higher scores first, then smaller ids."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.score = np.zeros((n_items, k), np.int64)
        self.doc = np.full((n_items, k), NO_DOC, np.int64)

    def offer(self, docs: np.ndarray, scores: np.ndarray) -> None:
        """scores[d, i]: the score of document d for item i, 0 for none."""
        least, last = self.score[:, -1], self.doc[:, -1]
        if len(docs) > self.k:
            # No document under the kth of this batch can stay either.
            least = np.maximum(least, np.partition(scores, len(docs) - self.k, axis=0)[len(docs) - self.k])
        better = (scores > least) | (scores == least) & ((least > self.score[:, -1]) | (docs[:, None] < last))
        row, item = np.nonzero(better & (scores > 0))
        if not len(item):
            return
        hit = np.unique(item)
        items = np.concatenate([item, np.repeat(hit, self.k)])
        found = np.concatenate([scores[row, item], self.score[hit].ravel()])
        ids = np.concatenate([docs[row], self.doc[hit].ravel()])
        order = np.lexsort((ids, -found, items))
        items, found, ids = items[order], found[order], ids[order]
        place = np.arange(len(items)) - np.searchsorted(items, items)
        keep = place < self.k
        self.score[items[keep], place[keep]] = found[keep]
        self.doc[items[keep], place[keep]] = ids[keep]


def _scores(index: Index, weights: np.ndarray, exact: bool, begin, terms, tf, m) -> np.ndarray:
    """[document, item] of the documents whose (term, tf) stand at begin[d]:begin[d + 1]."""
    n = len(begin) - 1
    doc = np.repeat(np.arange(n), np.diff(begin))
    value = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    width = index.begin[terms + 1] - index.begin[terms]
    at = np.repeat(index.begin[terms] - (np.cumsum(width) - width), width) + np.arange(width.sum())
    cell = np.repeat(doc * index.n_items, width) + index.item[at]
    value = np.repeat(value, width) * index.repeats[at]
    if exact:  # sums below 2^53
        return np.bincount(cell, value, n * index.n_items).astype(np.int64).reshape(n, -1)
    out = np.zeros(n * index.n_items, np.int64)
    np.add.at(out, cell, value)
    return out.reshape(n, -1)


def _counted(docs: DataFrame, index) -> DataFrame:
    """(doc_id, n, terms, tf): all terms of each document, and those of the index."""
    def count(batches):
        number = {t: k for k, t in enumerate(index.value.terms)}
        for batch in batches:
            n, terms, tf = [], [], []
            for text in batch["text"].cast(pa.binary()):
                counts = term_counts(text.as_py())
                own = sorted((number[t], c) for t, c in counts.items() if t in number)
                n.append(counts.total())
                terms.append([t for t, _ in own])
                tf.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(tf, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        count, "doc_id long, n long, terms array<int>, tf array<bigint>").where("n > 0")


def _best(counted: DataFrame, index, weights: np.ndarray, n_docs: int, length: int, k: int) -> DataFrame:
    """(place, doc_id, score): the k best documents of each item in each task."""
    inner = index.value
    of_item = np.bincount(inner.item, (weights[np.repeat(np.arange(len(inner.terms)), np.diff(inner.begin))] * inner.repeats),
                          inner.n_items)
    exact = of_item.max(initial=0) * 1e6 < 2 ** 53

    def stream(batches):
        held = index.value
        widths, heaps, at_once = np.diff(held.begin), Heaps(held.n_items, k), max(1, CELLS // held.n_items)
        for batch in batches:
            ids = batch["doc_id"].to_numpy()
            terms, tf = batch["terms"].flatten().to_numpy().astype(np.int64), batch["tf"].flatten().to_numpy()
            begin = np.concatenate([[0], np.cumsum(batch["terms"].value_lengths().to_numpy())]).astype(np.int64)
            lengths, where = np.unique(batch["n"].to_numpy(), return_inverse=True)
            m = np.array([25 + 75 * n * n_docs // length for n in lengths.tolist()], np.int64)[where]
            cost = np.concatenate([[0], np.cumsum(widths[terms])])[begin]
            low = 0
            while low < len(ids):
                high = max(low + 1, min(low + at_once, int(np.searchsorted(cost, cost[low] + CELLS, "right")) - 1))
                part = slice(begin[low], begin[high])
                heaps.offer(ids[low:high], _scores(held, weights, exact, begin[low:high + 1] - begin[low],
                                                   terms[part], tf[part], m[low:high]))
                low = high
        place, rank = np.nonzero(heaps.score > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place, pa.int64()), pa.array(heaps.doc[place, rank]), pa.array(heaps.score[place, rank])],
            names=["place", "doc_id", "score"])

    return (counted.where("doc_id IS NOT NULL AND size(terms) > 0")
            .mapInArrow(stream, "place long, doc_id long, score long"))


def _grouped(items: DataFrame) -> tuple[DataFrame, list]:
    """items with the number of their group, and the groups: each of INDEX_BYTES at most, and one more item."""
    total = items.agg(F.sum("bytes")).first()[0] or 0
    if total <= INDEX_BYTES:
        return items.withColumn("group", F.struct(F.lit(0).alias("deal"), F.lit(0).alias("part"))), [(0, 0)] if total else []
    deal = F.pmod(F.xxhash64("item"), F.lit(-(-total // INDEX_BYTES))).cast("int")
    before = F.sum("bytes").over(Window.partitionBy("deal").orderBy("item")) - F.col("bytes")
    dealt = write_through(items.withColumn("deal", deal).withColumn("part", F.floor(before / INDEX_BYTES).cast("int"))
                          .withColumn("group", F.struct("deal", "part")).drop("deal", "part"), "item_groups")
    return dealt, [tuple(r) for r in dealt.select("group.*").distinct().sort("deal", "part").collect()]


def rank_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of items(item_id, text) its k best rows of docs(doc_id, text).

    Terms are runs of ASCII letters and digits and of characters above x7F, A-Z lowered. A document's score for
    an item is the sum over the item's terms, repeats included, of w * ((10^9 tf) div (1000 tf + 8 m)), with
    w = floor(1000 ln((2N + 2) / (2df + 1))) and m = 25 + (75 n N) div L. Scores of 0 give no row; equal
    scores go to the smaller doc_id. Null and empty texts have no terms: such items give no rows, such
    documents count nowhere. Repeated rows are documents, or items, of their own. A document without doc_id
    counts in N, L and df and is not ranked; an item without item_id is an item. Other columns are ignored; an
    empty table on either side gives an empty result.
    """
    spark = docs.sparkSession

    def own_terms(batches):
        for batch in batches:
            counts = [term_counts(t.as_py()) for t in batch["text"].cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch["item_id"], pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                 pa.array([sum(map(len, c)) + 16 * len(c) for c in counts], pa.int64())],
                names=["item_id", "terms", "repeats", "bytes"])

    kind = items.schema["item_id"].dataType.simpleString()
    wanted = items.select("item_id", F.col("text").cast("string").alias("text")).mapInArrow(
        own_terms, f"item_id {kind}, terms array<binary>, repeats array<bigint>, bytes long").where("bytes > 0")
    wanted, groups = _grouped(write_through(wanted.withColumn("item", F.monotonically_increasing_id()), "items"))
    results = []
    for deal, part in groups:
        rows = wanted.where(f"group.deal = {deal} AND group.part = {part}").orderBy("item").collect()
        index = spark.sparkContext.broadcast(Index.of([
            Counter(dict(zip(map(bytes, r["terms"]), r["repeats"]))) for r in rows]))
        counted = write_through(_counted(docs, index), "term_counts")
        n_docs, length = counted.agg(F.count("*"), F.sum("n")).first()
        df = dict(counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        if not df:
            continue
        weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(len(index.value.terms))], np.int64)
        found = _best(counted, index, weights, n_docs, length, k)
        places = spark.createDataFrame([(p, r["item"]) for p, r in enumerate(rows)], "place long, item long")
        order = Window.partitionBy("place").orderBy(F.desc("score"), "doc_id")
        merged = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        results.append(merged.join(places, "place").select("item", "rank", "doc_id", "score"))
    if not results:
        return wanted.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                                      F.lit(0).cast("long").alias("score"))
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionByName(more)
    return whole.join(wanted.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

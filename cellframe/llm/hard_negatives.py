"""Hard negatives by exact search over Hilbert-ordered blocks with zone maps.

1. Vectors are sorted along a Hilbert curve through their most varying dimensions and cut into blocks of
   `BLOCK` rows. A block is one Parquet row: its vectors, labels and ids, and its zone map, the least and
   greatest component of each dimension, which labels it holds and its smallest id.
2. An anchor asks for the best rows of some window of scores, with its label or without it. Interval
   arithmetic on a zone map bounds the scores that a block can hold. A block is read for an anchor if its
   interval meets the window, its labels fit, and its upper bound can still beat what the anchor has.
3. What an anchor has comes from its own block, whose rows are near on the curve: it is read first.
4. Positives first: no window, same label, best 5. Each positive's score then gives a window for negatives.

Asks are dealt over groups of about `ASKS`, zone maps over groups of `ZONES`, and blocks go to the groups
that asked for them, so that a task holds one block and one group, or one group of each. Only the best rows
of each ask leave a task. All numbers are integers; products are made in doubles where sums stay under 2^53.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cellframe.session import write_through

BLOCK, ASKS, ZONES = 2048, 512, 256
#: Dimensions of the Hilbert curve, and bits of each.
CURVE, BITS = 16, 3
POSITIVES, NEGATIVES = 5, 3
#: Scores of negatives, as hundredths of the positive's.
LEAST, MOST = 50, 95

LOW, HIGH = -(2 ** 62), 2 ** 62
NO_ID = np.iinfo(np.int64).max

ROWS = "vec_id long, label long, vector array<bigint>"
STORED = ("block long, n int, low_id long, ids binary, labels binary, vectors binary, anchors binary, "
          "low binary, high binary, own_labels array<bigint>")
FOUND = "ask long, window int, vec_id long, score long"


def packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, "<i8").tobytes()


def unpacked(data, width: int = 0) -> np.ndarray:
    x = np.frombuffer(data, "<i8")
    return x.reshape(-1, width) if width else x


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(asked: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that any vector within [low, high] of a zone can have with each asked vector."""
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on a Hilbert curve of each row of cell numbers under 2 ** bits; bits * columns is under 63."""
    x, n = cells.astype(np.int64).T.copy(), cells.shape[1]
    # From the coarsest bit on, each dimension reflects or swaps the finer bits of the first one.
    for bit in range(bits - 1, 0, -1):
        mask = (1 << bit) - 1
        for k in range(n):
            is_set = (x[k] >> bit) & 1 == 1
            swap = np.where(is_set, 0, (x[0] ^ x[k]) & mask)
            x[0] ^= np.where(is_set, mask, swap)
            x[k] ^= swap
    # The bits of one level are a Gray code across the dimensions, continued from level to level.
    for k in range(1, n):
        x[k] ^= x[k - 1]
    flip = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    key = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            key = key << 1 | (x[k] >> bit) & 1
    return key


def quantised(rows: DataFrame, scale: int, relabel) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part, one for each vec_id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(embedding) > 0").where(
        F.forall("embedding", finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("vector"))
    widths = clean.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1)
    found = widths.first()
    return clean.where(F.size("vector") == (found["width"] if found else 0)).groupBy("vec_id").agg(
        F.min(F.struct(relabel(F.col("vec_id"), F.col("label")).alias("label"), "vector")).alias("row")).select(
        "vec_id", "row.label", "row.vector")


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _spread(vectors: DataFrame) -> list[tuple[int, float, float]]:
    """(dimension, mean, deviation) of the most varying dimensions, from sums over tasks."""
    def sums(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["vector"]).astype(np.float64)
                mine = np.stack([np.full(x.shape[1], float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])
                total = mine if total is None else total + mine
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.shape[1]), pa.int64()), *map(pa.array, total)],
                                             names=["dimension", "n", "x", "xx"])

    rows = (vectors.select("vector").mapInArrow(sums, "dimension long, n double, x double, xx double")
            .groupBy("dimension").agg(F.sum("n").alias("n"), F.sum("x").alias("x"), F.sum("xx").alias("xx"))
            .select("dimension", (F.col("x") / F.col("n")).alias("mean"),
                    F.sqrt(F.greatest(F.lit(0.0), F.col("xx") / F.col("n") - F.pow(F.col("x") / F.col("n"), 2))).alias("deviation"))
            .orderBy(F.desc("deviation"), "dimension").limit(CURVE).collect())
    return [tuple(r) for r in rows]


def blocks_of(vectors: DataFrame, is_anchor) -> DataFrame:
    """The vectors in blocks along the curve, each one row with its zone map."""
    spread = _spread(vectors)
    if not spread:
        return vectors.sparkSession.createDataFrame([], STORED)
    chosen, means, deviations = (np.array(c) for c in zip(*spread))
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def keyed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = (_matrix(batch["vector"])[:, chosen] - means) / np.maximum(deviations, 1e-300)
            # Cells of equal width over two deviations to either side; what lies beyond is in the last ones.
            cells = np.clip(np.floor((x + 2) / 4 * (1 << BITS)), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cells, BITS))],
                                             names=[*batch.schema.names, "key"])

    def stored(batches):
        from pyspark import TaskContext

        block, held = TaskContext.get().partitionId() << 32, []

        def out(rows: pa.Table):
            nonlocal block
            order = np.argsort(rows["vec_id"].to_numpy(), kind="stable")  # ties then go to smaller ids
            rows = rows.take(pa.array(order)).combine_chunks()
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            x = _matrix(rows["vector"].chunk(0))
            anchors = np.flatnonzero(rows["anchor"].to_numpy())
            values = [block, len(ids), int(ids[0]), packed(ids), packed(labels), packed(x), packed(anchors),
                      packed(x.min(axis=0)), packed(x.max(axis=0)), np.unique(labels).tolist()]
            kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int64())]
            block += 1
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)],
                                              names=[c.split(" ")[0] for c in STORED.split(", ")])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                rows = pa.Table.from_batches(held)
                while rows.num_rows >= BLOCK:
                    yield out(rows.slice(0, BLOCK))
                    rows = rows.slice(BLOCK)
                held = rows.to_batches()
        if sum(b.num_rows for b in held):
            yield out(pa.Table.from_batches(held))

    rows = vectors.withColumn("anchor", F.coalesce(is_anchor, F.lit(False)))
    return write_through(
        rows.mapInArrow(keyed, f"{ROWS}, anchor boolean, key long").repartitionByRange(tasks, "key", "vec_id")
        .sortWithinPartitions("key", "vec_id").mapInArrow(stored, STORED), "blocks")


def anchors_of(blocks: DataFrame) -> DataFrame:
    """(anchor_id, label, vector, home) of all anchors."""
    def own(batches):
        for batch in batches:
            for block, ids, labels, vectors, at in zip(*(batch[c].to_pylist() for c in ("block", "ids", "labels", "vectors", "anchors"))):
                at, ids = unpacked(at), unpacked(ids)
                x = unpacked(vectors, len(vectors) // 8 // len(ids))[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array(unpacked(labels)[at]), pa.array([packed(v) for v in x], pa.binary()),
                     pa.array(np.full(len(at), block))], names=["anchor_id", "label", "vector", "home"])

    return (blocks.select("block", "ids", "labels", "vectors", "anchors")
            .mapInArrow(own, "anchor_id long, label long, vector binary, home long"))


def _vectors(asks: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(asks["vector"].to_pylist()), "<i8").reshape(asks.num_rows, -1)


def _number(asks: pa.Table, name: str) -> np.ndarray:
    return asks[name].to_numpy()


def best_in_block(stored: dict, asks: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the ask, id, score) of the best rows of a block for each ask, at most k of each."""
    ids, labels = unpacked(stored["ids"]), unpacked(stored["labels"])
    x = unpacked(stored["vectors"], len(stored["vectors"]) // 8 // len(ids))
    # Asks of one anchor share its scores.
    _, first, which = np.unique(_number(asks, "anchor_id"), return_index=True, return_inverse=True)
    scores = products(_vectors(asks)[first], x)[which]
    allowed = (labels == _number(asks, "label")[:, None]) == _number(asks, "same")[:, None]
    allowed &= ids != _number(asks, "anchor_id")[:, None]
    allowed &= (scores >= np.maximum(_number(asks, "lo"), _number(asks, "least"))[:, None]) & (scores <= _number(asks, "hi")[:, None])
    scores = np.where(allowed, scores, np.iinfo(np.int64).min)
    limit, out = _number(asks, "k"), []
    for n in range(int(limit.max())):
        at = scores.argmax(axis=1)  # the first of equals, which has the smallest id
        row = np.arange(len(at))
        value = scores[row, at]
        hit = (value > np.iinfo(np.int64).min) & (limit > n)
        out.append((row[hit], ids[at[hit]], value[hit]))
        scores[row, at] = np.iinfo(np.int64).min
    return tuple(np.concatenate(c) for c in zip(*out))


def read_blocks(asks: DataFrame, blocks: DataFrame) -> DataFrame:
    """FOUND of asks(block, part, ...): each block goes once to each part of the asks that wants it."""
    wanted = asks.select("block", "part").distinct().toDF("to_block", "to_part")
    held = blocks.select("block", "ids", "labels", "vectors").join(wanted, F.col("block") == F.col("to_block"))
    names = [c.split(" ")[0] for c in FOUND.split(", ")]

    def search(held: pa.Table, asks: pa.Table) -> pa.Table:
        row, ids, scores = best_in_block({c: held[c][0].as_py() for c in ("ids", "labels", "vectors")}, asks)
        return pa.table([pa.array(_number(asks, "ask")[row]), pa.array(_number(asks, "window")[row], pa.int32()),
                         pa.array(ids), pa.array(scores)], names=names)

    return held.groupBy("to_block", "to_part").cogroup(asks.groupBy("block", "part")).applyInArrow(search, FOUND)


def choose_blocks(asks: DataFrame, blocks: DataFrame, n_blocks: int, n_asks: int) -> DataFrame:
    """asks with each `block`, besides their home, that could hold rows they want."""
    zones_of = max(1, -(-n_blocks // ZONES))
    parts = max(1, -(-n_asks // ASKS))
    zones = blocks.select("block", "low_id", "low", "high", "own_labels",
                          F.pmod(F.xxhash64("block"), F.lit(zones_of)).cast("int").alias("zone"),
                          F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    asking = asks.select("*", F.explode(F.sequence(F.lit(0), F.lit(zones_of - 1))).alias("zone"))
    names = [*asks.columns, "block"]

    def choose(zones: pa.Table, asks: pa.Table) -> pa.Table:
        if not zones.num_rows or not asks.num_rows:
            return asks.slice(0, 0).append_column("block", pa.array([], pa.int64())).select(names)
        low, high = (np.frombuffer(b"".join(zones[c].to_pylist()), "<i8").reshape(zones.num_rows, -1) for c in ("low", "high"))
        least, most = bounds(_vectors(asks), low, high)
        kept, kept_id = _number(asks, "least")[:, None], _number(asks, "least_id")[:, None]
        meets = (least <= _number(asks, "hi")[:, None]) & (most >= _number(asks, "lo")[:, None])
        top = np.minimum(most, _number(asks, "hi")[:, None])
        meets &= (top > kept) | (top == kept) & (_number(zones, "low_id") < kept_id)
        meets &= _number(zones, "block") != _number(asks, "home")[:, None]
        own = zones["own_labels"].to_pylist()
        labels = _number(asks, "label")
        for z, held in enumerate(own):
            has = np.isin(labels, held)
            meets[:, z] &= np.where(_number(asks, "same"), has, ~has | (len(held) > 1))
        ask, zone = np.nonzero(meets)
        return asks.take(pa.array(ask)).append_column("block", zones["block"].take(pa.array(zone))).select(names)

    schema = asks.select("*", F.lit(0).cast("long").alias("block")).schema
    return zones.groupBy("zone", "part").cogroup(asking.groupBy("zone", "part")).applyInArrow(choose, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(asks: DataFrame, blocks: DataFrame, k: int, n_blocks: int, n_asks: int, label: str) -> DataFrame:
    """(ask, window, rank, vec_id, score): the k best of each ask, from its home first and then wherever they could be."""
    parts = max(1, -(-n_asks // ASKS))
    asks = asks.withColumn("part", F.pmod(F.xxhash64("ask"), F.lit(parts)).cast("int"))
    at_home = write_through(_best(read_blocks(asks.withColumn("block", F.col("home")), blocks), k), f"{label}_home")
    worst = at_home.where(F.col("rank") == k).select("ask", "window", F.col("score").alias("_s"), F.col("vec_id").alias("_i"))
    open_asks = asks.join(worst, ["ask", "window"], "left").select(*[
        F.coalesce("_s", c).alias(c) if c == "least" else F.coalesce("_i", c).alias(c) if c == "least_id" else c
        for c in asks.columns])
    chosen = write_through(choose_blocks(open_asks, blocks, n_blocks, n_asks), f"{label}_chosen")
    found = read_blocks(chosen, blocks).unionByName(at_home.drop("rank"))
    return write_through(_best(found, k), f"{label}_found")


def mine_negatives(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   least: int = LEAST, most: int = MOST, scale: int = 256, relabel=lambda vec_id, label: label) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of floor(scale * x). A row that is_anchor selects has as positives its best
    `positives` other rows of the same label. For each of them the best `negatives` rows of another label
    with least * p <= 100 * n <= most * p are returned. Equal scores go to the smaller vec_id. relabel
    (vec_id, label) gives the label to use.

    Rows with a null vec_id, label or vector, an empty vector or null or non-finite components take no part, nor
    do vectors of another length than the most frequent one. Repeated rows of one vec_id count once, as the one
    with the smallest label and vector. Anchors without positives, and positives without negatives, give no
    rows; an empty table gives an empty result. Other columns are ignored.
    """
    vectors = write_through(quantised(rows, scale, relabel), "vectors")
    blocks = blocks_of(vectors, is_anchor)
    n_blocks = blocks.count()
    anchors = write_through(anchors_of(blocks), "anchors")
    n_anchors = anchors.count()
    number = lambda x: F.lit(x).cast("long")
    asks = anchors.select(
        F.col("anchor_id").alias("ask"), "anchor_id", "label", "vector", "home", F.lit(0).alias("window"), F.lit(True).alias("same"),
        number(LOW).alias("lo"), number(HIGH).alias("hi"), F.lit(positives).alias("k"), number(LOW).alias("least"),
        number(NO_ID).alias("least_id"))
    found = search(asks, blocks, positives, n_blocks, n_anchors, "positives")
    # 50 p <= 100 n <= 95 p in integers: n from the smallest above to the greatest below.
    windows = found.select(
        F.col("ask").alias("anchor_id"), F.col("rank").alias("window"), F.expr(f"-((-{least} * score) div 100 - IF((-{least} * score) % 100 < 0, 1, 0))").alias("lo"),
        F.expr(f"({most} * score) div 100 - IF(({most} * score) % 100 < 0, 1, 0)").alias("hi")).where("lo <= hi")
    asks = anchors.join(windows, "anchor_id").select(
        F.col("anchor_id").alias("ask"), "anchor_id", "label", "vector", "home", "window", F.lit(False).alias("same"),
        "lo", "hi", F.lit(negatives).alias("k"), number(LOW).alias("least"), number(NO_ID).alias("least_id"))
    mined = search(asks, blocks, negatives, n_blocks, n_anchors, "negatives")
    return mined.join(found.select("ask", F.col("rank").alias("window"), F.col("vec_id").alias("positive_id"),
                                   F.col("score").alias("positive_score")), ["ask", "window"]).select(
        F.col("ask").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))

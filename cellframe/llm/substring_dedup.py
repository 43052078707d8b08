"""Removal of word sequences that occur earlier in the corpus, by partitioned suffix trees.

The trees hold suffixes cut at the window length (20 words), since a window repeats exactly when its
suffix meets another one at a node that deep. Suffixes are dealt over trees by a prefix that equal
windows share, and only suffixes whose prefix occurs twice are built into trees:

1. The prefix of a window is its core: of its runs of 5 words, the one with the smallest hash. Neighbour
   windows mostly have the same core, so a document has about one core for eight windows.
2. Cores are dealt by range and sorted by core, document and position. The bounds of the ranges are set
   once, from a sample of documents, so every evaluation deals alike; a core so frequent that it is a bound
   is spread over the ranges it touches. A core that occurs once closes its windows. A core with more
   occurrences than a tree should hold, or with several ranges, is cut into several trees.
3. The words of the windows with repeated cores are sent to their tree. Trees are built level by level,
   an edge of five words at a time; nodes with one suffix are leaves. In each node as deep as the window,
   all but the earliest suffix are repeats.
4. Where a core was cut into several trees, the earliest suffix of every node goes on with its full
   20-word prefix, by which the trees of one core meet.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StringType, StructType
from xxhash import xxh3_128_digest

from cellframe.llm.shingles import gram_hashes, word_hashes

WINDOW, CORE, EDGE = 20, 5, 5
#: Occurrences of one core that a tree may hold, and windows' stretches built at a time.
TREE = 1000
BUFFER = 20_000
#: Documents sampled for each range, and the share of their cores that are looked at.
SAMPLED, THIN = 64, 16
#: Bits of a core that its key keeps: few enough to be exact in a double. Cores of one key share trees.
CORE_BITS = 52
#: A place is the first window of a core times this, plus its number of windows (16 at most).
PLACE = 32

# A tree's number is odd if other trees hold the same core.
CORES = "part int, core long, place long, doc_id long, version int"
REPEATED = "doc_id long, version int, place long, tree long"
STRETCHES = REPEATED + ", words binary"
FOUND = "doc_id long, version int, first int, last int, k1 long, k2 long"
WORD_SPANS = re.compile(rb"[^\x20\x09-\x0D]+").finditer


def _batch(columns: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def cores_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(core hash, first window, number of windows) of each core of a text."""
    grams = gram_hashes(word_hashes(words), CORE)
    span = WINDOW - CORE + 1
    at = sliding_window_view(grams, span).argmin(axis=1) + np.arange(len(grams) - span + 1)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    return (grams[at[first]] >> np.uint64(64 - CORE_BITS)).view(np.int64), first, np.diff(first, append=len(at))


def _cores(bounds: list[int], step: int = 1):
    """The cores of the texts, or every step-th, with their ranges."""
    def cores(batches):
        for batch in batches:
            parts = []
            for doc_id, version, text in zip(batch["doc_id"].to_pylist(), batch["version"].to_pylist(),
                                             batch["text"].cast(pa.binary()).to_pylist()):
                words = (text or b"").split()
                if len(words) >= WINDOW:
                    # Not always the first one: texts may begin alike.
                    core, first, windows = (c[hash((doc_id, version)) % step::step] for c in cores_of(words))
                    parts.append((core, first * PLACE + windows, np.full(len(core), doc_id), np.full(len(core), version)))
            core, place, doc, version = [np.concatenate(c) for c in zip(*parts)] or [np.empty(0, np.int64)] * 4
            lowest = np.searchsorted(bounds, core, "left")
            ranges = np.searchsorted(bounds, core, "right") - lowest + 1
            part = lowest + (gram_hashes((doc ^ place << 32).view(np.uint64), 1) % ranges.view(np.uint64)).view(np.int64)
            yield _batch([part, core, place, doc, version],
                         [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()],
                         ["part", "core", "place", "doc_id", "version"])
    return cores


def range_bounds(known: DataFrame, ranges: int) -> list[int]:
    """Bounds that cut the cores into even ranges, from some documents; a very frequent core is several of them."""
    share = min(1.0, SAMPLED * ranges / max(known.count(), 1))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    points = [k / ranges for k in range(1, ranges)]
    if not points:
        return []
    cores = some.mapInArrow(_cores([], THIN), CORES)
    return cores.agg(F.percentile_approx("core", points, 100 * ranges)).first()[0] or []


def _repeated(batches):
    """Of sorted cores, those that occur twice or may go on in a neighbour task, each with its tree."""
    from pyspark import TaskContext

    tree = TaskContext.get().partitionId() << 40
    held, begun = None, True  # begun: the first held core may have occurred before

    def out(rows: pa.Table, begun: bool, goes_on: bool):
        nonlocal tree
        core = rows["core"].to_numpy()
        starts = np.flatnonzero(np.r_[True, core[1:] != core[:-1]])
        counts = np.diff(starts, append=len(core))
        index = np.arange(len(core)) - np.repeat(starts, counts)
        cut = counts > TREE
        cut[0] |= begun
        cut[-1] |= goes_on
        trees = np.cumsum(index % TREE == 0) + tree
        tree = int(trees[-1])
        keep = np.repeat((counts > 1) | cut, counts)
        rows = rows.drop_columns(["core"]).append_column("tree", pa.array(trees * 2 + np.repeat(cut, counts), pa.int64()))
        yield from rows.select(["doc_id", "version", "place", "tree"]).filter(pa.array(keep)).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        core = held["core"].to_numpy()
        whole = int(np.searchsorted(core, core[-1]))
        if whole:
            yield from out(held.slice(0, whole), begun, False)
            held, begun = held.slice(whole), False
        elif held.num_rows > TREE:
            yield from out(held, begun, True)
            held, begun = None, True
    if held is not None:
        yield from out(held, begun, True)


def _stretches(batches):
    """The words of all windows of each repeated core."""
    names = ["doc_id", "version", "place", "tree", "words"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        rows = []
        for doc_id, version, text, cores in zip(*(batch[c].to_pylist() for c in ("doc_id", "version", "text", "cores"))):
            words = text.encode().split()
            for c in cores:
                first, windows = divmod(c["place"], PLACE)
                rows.append((doc_id, version, c["place"], c["tree"], b" ".join(words[first:first + windows + WINDOW - 1])))
            if len(rows) >= BUFFER:
                yield _batch(list(zip(*rows)), kinds, names)
                rows = []
        if rows:
            yield _batch(list(zip(*rows)), kinds, names)


def deep_nodes(root: np.ndarray, hashes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Builds all trees of a buffer at once. root: the tree of each suffix; start: its place in hashes.

    Returns (suffixes in nodes of the window's depth that hold several, their node).
    """
    alive, node = np.arange(len(root)), root
    edges = gram_hashes(hashes, EDGE)
    for depth in range(0, WINDOW, EDGE):
        edge = edges[start[alive] + depth]
        order = np.lexsort((edge, node))
        alive, node, edge = alive[order], node[order], edge[order]
        new = np.ones(len(alive), bool)
        new[1:] = (node[1:] != node[:-1]) | (edge[1:] != edge[:-1])
        inner = np.bincount(np.cumsum(new) - 1)[np.cumsum(new) - 1] > 1 if len(alive) else new
        alive, node = alive[inner], np.cumsum(new)[inner]
    return alive, node


def repeats(rows: pa.Table) -> pa.RecordBatch:
    """Repeated windows of some whole trees, and the earliest windows of trees that were cut."""
    words = [w.split(b" ") for w in rows["words"].to_pylist()]
    first, windows = np.divmod(rows["place"].to_numpy(), PLACE)
    lengths = windows + WINDOW - 1
    hashes = np.concatenate([word_hashes(w) for w in words])
    stretch = np.repeat(np.arange(len(words)), windows)
    within = np.arange(len(stretch)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(np.cumsum(lengths) - lengths, windows) + within
    group = rows["tree"].to_numpy()
    doc, version = rows["doc_id"].to_numpy(), rows["version"].to_numpy()
    first = first[stretch] + within

    suffix, node = deep_nodes(group[stretch], hashes, start)
    order = np.lexsort((first[suffix], version[stretch[suffix]], doc[stretch[suffix]], node))
    suffix, node = suffix[order], node[order]
    leads = np.r_[True, node[1:] != node[:-1]][:len(node)]
    lead = suffix[np.maximum.accumulate(np.where(leads, np.arange(len(suffix)), 0))] if len(suffix) else suffix
    # A row given twice is one document: the same place is no repeat of itself.
    same = (doc[stretch[suffix]] == doc[stretch[lead]]) & (version[stretch[suffix]] == version[stretch[lead]]) & (
        first[suffix] == first[lead])
    repeated = np.zeros(len(stretch), bool)
    repeated[suffix[~same]] = True

    hit = np.flatnonzero(repeated)
    begins = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (np.diff(stretch[hit]) != 0)][:len(hit)])
    runs = hit[begins]
    ends = hit[np.r_[begins[1:] - 1, len(hit) - 1]] if len(hit) else hit

    going = np.flatnonzero(~repeated & (group % 2 == 1)[stretch])
    keys = np.frombuffer(b"".join(
        xxh3_128_digest(b" ".join(words[s][w:w + WINDOW])) for s, w in zip(stretch[going].tolist(), within[going].tolist())),
        np.int64).reshape(-1, 2)
    both = np.r_[runs, going]
    none = pa.nulls(len(runs), pa.int64())
    return pa.RecordBatch.from_arrays([
        pa.array(doc[stretch[both]], pa.int64()), pa.array(version[stretch[both]], pa.int32()),
        pa.array(first[both], pa.int32()), pa.array(first[np.r_[ends, going]], pa.int32()),
        *(pa.concat_arrays([none, pa.array(keys[:, k], pa.int64())]) for k in (0, 1))],
        names=["doc_id", "version", "first", "last", "k1", "k2"])


def _trees(batches):
    """Whole trees of a sorted task, some at a time."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
        if held.num_rows < BUFFER:
            continue
        tree = held["tree"].to_numpy()
        last = np.flatnonzero(tree != tree[-1])
        if len(last):
            yield repeats(held.slice(0, int(last[-1]) + 1))
            held = held.slice(int(last[-1]) + 1)
    if held is not None and held.num_rows:
        yield repeats(held)


def _cut_out(joined: bool):
    """Texts without the covered words; joined: the kept words with single spaces."""
    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["runs"].to_pylist()):
                text = text or b""
                words = text.split()
                n_words.append(len(words))
                if not runs:
                    n_removed.append(0)
                    kept.append(b" ".join(words) if joined else text)
                    continue
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, [r["first"] for r in runs], 1)
                np.add.at(edges, [r["last"] + WINDOW for r in runs], -1)
                stays = np.cumsum(edges)[:-1] == 0
                n_removed.append(int(len(words) - stays.sum()))
                if joined:
                    kept.append(b" ".join([words[k] for k in np.flatnonzero(stays).tolist()]))
                else:
                    starts = [m.start() for m in WORD_SPANS(text)] + [len(text)]
                    kept.append(text[:starts[0]] + b"".join(
                        [text[starts[k]:starts[k + 1]] for k in np.flatnonzero(stays).tolist()]))
            columns = [c for c in batch.schema.names if c not in ("text", "runs")]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in columns] + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                               pa.array([k.decode() for k in kept], pa.string())],
                names=columns + ["n_words", "n_removed", "kept_text"])
    return cut


def drop_repeated_passages(docs: DataFrame, joined: bool = False) -> DataFrame:
    """docs without `text`, with `n_words`, `n_removed` and `kept_text` (instead of columns so named).

    A word goes if a window of 20 words of its document covers it whose words also start earlier in the
    corpus: in a smaller doc_id, or before in the same document. Windows are judged on the input. The
    text between kept words stays as it is, or is one space if `joined`. Null, empty and short texts have
    no windows; null gives an empty kept_text. Repeated rows are one document and lose the same words; rows
    of one doc_id with different texts count in the order of a hash of the text. Rows without doc_id keep
    their words and are not compared. Other columns pass through; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    added = ("text", "n_words", "n_removed", "kept_text")
    passing = [c for c in docs.columns if c.lower() not in (*added, "doc_id")]
    named = {c: f"_in{k}" for k, c in enumerate(passing)}
    # No cast where none is needed: the planner drops its alias on one side only, and would move the texts twice.
    kinds = dict(docs.dtypes)
    texts = docs.select(*[c if kinds[c] == kind else F.col(c).cast(kind).alias(c) for c, kind in
                          (("doc_id", "bigint"), ("text", "string"))],
                        F.hash("text").alias("version"), *[F.col(c).alias(n) for c, n in named.items()])
    known = texts.where("doc_id IS NOT NULL")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    read = known.select("doc_id", "version", "text")
    cores = read.mapInArrow(_cores(range_bounds(read, tasks)), CORES).repartitionById(tasks, "part")
    repeated = (cores.sortWithinPartitions("core", "doc_id", "version", "place").drop("part")
                .mapInArrow(_repeated, REPEATED)
                .groupBy("doc_id", "version").agg(F.collect_list(F.struct("place", "tree")).alias("cores")))
    # The texts move once: both joins read the same exchange, which is why columns that nobody reads come along.
    stretches = known.join(repeated, ["doc_id", "version"]).mapInArrow(_stretches, STRETCHES)
    # Read by one branch only: trees are built once.
    found = (stretches.repartition(tasks, "tree").sortWithinPartitions("tree").mapInArrow(_trees, FOUND)
             .where("doc_id IS NOT NULL AND version IS NOT NULL"))
    at = F.struct("doc_id", "version", "first")
    # Repeats have no key and are all to be removed; a key of their own deals them out evenly.
    meeting = Window.partitionBy(F.coalesce("k1", F.xxhash64(at)), "k2").orderBy("doc_id", "version", "first")
    runs = (found.withColumn("lead", F.first(at).over(meeting)).where(F.col("k1").isNull() | (at != F.col("lead")))
            .groupBy("doc_id", "version").agg(F.collect_list(F.struct("first", "last")).alias("runs")))
    none = F.array().cast("array<struct<first:int,last:int>>")
    rows = (known.join(runs, ["doc_id", "version"], "left")
            .select("doc_id", *named.values(), "text", F.coalesce("runs", none).alias("runs")))
    rows = rows.unionByName(texts.where("doc_id IS NULL").select("doc_id", *named.values(), "text", none.alias("runs")))
    fields = [f for f in rows.schema.fields if f.name not in ("text", "runs")]
    schema = StructType(fields).add("n_words", LongType()).add("n_removed", LongType()).add("kept_text", StringType())
    back = {n: c for c, n in named.items()}
    return rows.mapInArrow(_cut_out(joined), schema).select(
        *[F.col(c).alias(back.get(c, c)) for c in schema.names])

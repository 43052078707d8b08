"""Near-duplicate documents by MinHash: minima, bands, signature check, confirmation, components.

1. One pass over the texts gives each document its number of shingles, a 128-bit key of its set, one
   byte of a hash of each minimum (the signature) and a key for each band of minima.
2. Documents with equal sets are one class; its smallest doc_id stands for it from here on.
3. Classes that share a band key are in one bucket. A bucket is not expanded into pairs: every member is
   paired with the bucket's smallest member, pairs are compared by signature, and what could be a link
   is confirmed on the full sets, for each class its most similar partner first. Components follow.
4. Members of a bucket that are then still in different components are compared directly: those outside
   the bucket's largest component, in blocks, against all its members, by signature first and then, with
   the sets of those that are left, in full. No pair of a bucket is left out, pairs never become rows, and
   a bucket of one component, however large, costs nothing here.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cellframe.llm.shingles import Minima, band_keys, set_key, shingle_set, signature_bytes
from cellframe.llm.stars import components
from cellframe.session import write_through

WORDS, PERCENT = 5, 80
# A pair of similarity 0.8 misses all bands with probability (1 - 0.8^6)^40 = 5e-6.
BANDS, ROWS = 40, 6
# Six standard deviations of the share of equal minima at 0.8.
SLACK = 6 * (0.16 / (BANDS * ROWS)) ** 0.5
BLOCK = 1024

SIGNED = "doc_id long, n_shingles long, set1 long, set2 long, signature binary, bands array<long>"


def _shingled(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def signed(docs: DataFrame, words: int) -> DataFrame:
    def sign(batches):
        minima = Minima(BANDS * ROWS)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                shingles = shingle_set(text, words)
                least = minima.of(shingles)
                rows.append((doc_id, len(shingles), *set_key(shingles), signature_bytes(least),
                             band_keys(least, ROWS) if len(shingles) else []))
            columns = list(zip(*rows)) or [[]] * 6
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "n_shingles", "set1", "set2", "signature", "bands"])

    return _shingled(docs).mapInArrow(sign, SIGNED)


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    def sets(batches):
        for batch in batches:
            found = [shingle_set(t, words).view(np.int64) for t in batch["text"].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.list_(pa.int64()))],
                                             names=["doc_id", "shingles"])

    return _shingled(docs).mapInArrow(sets, "doc_id long, shingles array<long>")


def similar(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose signatures allow the similarity, with the share of equal minima."""
    least = percent / 100 - SLACK

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            first, second = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                             for c in ("sig_a", "sig_b"))
            share = (first == second).mean(axis=1)
            keep = share >= least
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep)), pa.array(share[keep])],
                names=["a", "b", "share"])

    with_a = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("sig_a"))
    with_b = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("sig_b"))
    return (pairs.join(with_b, "b").join(with_a, "a").select("a", "b", "sig_a", "sig_b")
            .mapInArrow(compare, "a long, b long, share double"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have the similarity."""
    with_a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    with_b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    return (pairs.select("a", "b").join(with_b, "b").join(with_a, "a")
            .where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b"))


def _dealt(members: DataFrame) -> tuple[DataFrame, list[str]]:
    """Rows of buckets dealt over blocks: each member once for each block of those that ask.

    All members outside a bucket's largest component ask; they go to each block of members.
    """
    by_label = members.groupBy("band", "label").agg(F.count("*").alias("n"))
    buckets = write_through(by_label.groupBy("band").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("size")).select(
        "band", F.col("top.label").alias("top"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("size") - F.col("top.n")) / BLOCK).cast("int").alias("minor_blocks"))
        .where("minor_blocks > 0"), "buckets")
    dealt = members.join(buckets, "band").withColumn("minor", F.col("label") != F.col("top"))
    at, columns = F.xxhash64("doc_id"), [*members.columns, "minor"]
    held = dealt.select(*columns, F.lit(False).alias("asks"), F.pmod(at, F.col("blocks")).cast("int").alias("block"),
                        F.explode(F.sequence(F.lit(0), F.col("minor_blocks") - 1)).alias("minor_block"))
    asking = dealt.where("minor").select(
        *columns, F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.pmod(at, F.col("minor_blocks")).cast("int").alias("minor_block"))
    return held.unionByName(asking), ["band", "block", "minor_block"]


def _contests(rows: pd.DataFrame, percent: int):
    """For each asking row: its place, and the places of members that could be linked to it, best first.

    A pair that shares an earlier band, by the band's key, was met there.
    """
    least = percent / 100 - SLACK
    held = np.flatnonzero(~rows.asks.to_numpy())
    signatures = np.frombuffer(b"".join(rows.signature), np.uint8).reshape(len(rows), -1)
    bands, at = np.stack(rows.bands.to_list()), rows.band_at.to_numpy()
    theirs, their_bands = signatures[held], bands[held]
    ids, labels, minor = (rows[c].to_numpy() for c in ("doc_id", "label", "minor"))
    for q in np.flatnonzero(rows.asks.to_numpy()):
        other = np.flatnonzero((labels[held] != labels[q]) & (~minor[held] | (ids[held] > ids[q])))
        share = (theirs[other] == signatures[q]).mean(axis=1)
        other, share = other[share >= least], share[share >= least]
        first = (their_bands[other] == bands[q]).argmax(axis=1) == at[q]
        order = np.argsort(-share[first], kind="stable")
        if len(order):
            yield int(q), held[other[first][order]]


def contested(members: DataFrame, percent: int) -> DataFrame:
    """(band, doc_id) of members that could be linked across components, by their signatures."""
    rows, by = _dealt(members)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        found = {k for q, hits in _contests(rows, percent) for k in (q, *hits.tolist())}
        return rows.iloc[sorted(found)][["band", "doc_id"]]

    return rows.groupBy(*by).applyInPandas(compare, "band long, doc_id long").distinct()


def crossing_links(members: DataFrame, percent: int) -> DataFrame:
    """Links across components, confirmed on full sets where the block is; one for each two components."""
    rows, by = _dealt(members)

    def confirm(rows: pd.DataFrame) -> pd.DataFrame:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while x in parent:
                x = parent[x]
            return x

        sets, labels, ids, out = rows.shingles.to_list(), rows.label.tolist(), rows.doc_id.tolist(), []
        for q, hits in _contests(rows, percent):
            for k in hits.tolist():
                a, b = root(labels[q]), root(labels[k])
                if a == b:
                    continue
                both = np.intersect1d(sets[q], sets[k], assume_unique=True).size
                if 100 * both >= percent * (len(sets[q]) + len(sets[k]) - both):
                    parent[max(a, b)] = min(a, b)
                    out.append((min(ids[q], ids[k]), max(ids[q], ids[k])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    return rows.groupBy(*by).applyInPandas(confirm, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of docs.

    Documents are linked when 100 * common shingles >= percent * all shingles of the two, confirmed on
    full sets; component_id is the smallest doc_id reachable, and that document is kept. A null, empty or
    blank text has no shingles and no links. Rows that share a doc_id are one node. A row without doc_id
    is linked with nothing, has no component and is kept. Columns other than doc_id and text are ignored;
    an empty table gives an empty result.
    """
    all_docs = write_through(signed(docs, words), "signed")
    with_words = all_docs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = write_through(with_words.groupBy("set1", "set2").agg(F.min("doc_id").alias("doc_id")), "classes")
    members = write_through(
        with_words.join(classes, ["set1", "set2", "doc_id"], "left_semi").select("doc_id", "signature", "bands"), "members")
    signatures = members.select("doc_id", "signature")
    banded = members.select("doc_id", F.posexplode("bands").alias("band_at", "band"))

    heads = write_through(banded.groupBy("band").agg(
        F.min("doc_id").alias("head"), F.max("doc_id").alias("last")).where("head < last").select("band", "head"), "heads")
    shared = banded.join(heads, "band")
    stars = shared.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    candidates = write_through(similar(stars, signatures, percent), "candidates")
    paired = candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = write_through(shingle_sets(docs.join(paired, "doc_id", "left_semi"), words), "sets")

    nearest = candidates.groupBy("b").agg(F.max(F.struct("share", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    links = write_through(confirmed(nearest, sets, percent), "links")
    first = write_through(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels")

    def labelled(pairs: DataFrame) -> DataFrame:
        """Only pairs across components."""
        of = {c: first.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b")}
        return (pairs.join(of["a"], "a", "left").join(of["b"], "b", "left")
                .where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b"))

    def completed(ids: DataFrame) -> DataFrame:
        """The sets and those of further documents; the texts are read again only if there are some."""
        unknown = write_through(ids.distinct().join(sets, "doc_id", "left_anti"), "unknown")
        return sets if unknown.isEmpty() else sets.unionByName(write_through(
            shingle_sets(docs.join(unknown, "doc_id", "left_semi"), words), "sets"))

    rest = labelled(candidates.select("a", "b").join(nearest, ["a", "b"], "left_anti"))
    by_label = (shared.join(first.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                .select("band", "band_at", "doc_id", F.coalesce("label", "doc_id").alias("label")))
    split = by_label.groupBy("band").agg(
        F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("n > 2 AND low < high")
    crowds = write_through(by_label.join(split.select("band"), "band", "left_semi").join(members, "doc_id"), "crowds")
    open_to_links = write_through(contested(crowds, percent), "contested")
    met = crowds.join(open_to_links, ["band", "doc_id"], "left_semi").join(completed(open_to_links.select("doc_id")), "doc_id")
    links = links.unionByName(confirmed(rest, sets, percent)).unionByName(
        write_through(crossing_links(met, percent), "crossing"))
    labels = write_through(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "labels")
    named = write_through(classes.join(labels, classes["doc_id"] == labels["node"], "left").select(
        "set1", "set2", F.coalesce("label", "doc_id").alias("label")), "named")
    linked = F.when(F.col("n_shingles") > 0, F.coalesce("label", "doc_id")).otherwise(F.col("doc_id"))
    return (
        all_docs.select("doc_id", "n_shingles", "set1", "set2").join(named, ["set1", "set2"], "left")
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )

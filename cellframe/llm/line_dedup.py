"""Line deduplication over a whole corpus, in DataFrame operations only.

Line hashes are dealt by range and sorted within by hash, document and position; streaming through
them meets the first document of each line first. What comes back is, per document, the runs of lines
to keep (a run-length-coded bitmap), never text.

A line found in a third of all documents must not meet in one task, so the range key holds a slice of
the document as well. A first stream drops lines that have an earlier document in their slice; what
survives (per line at most one document a slice) goes through a second stream over all slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# The white space that a key loses at its ends, and the letters that it lower-cases.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 10


def lines_of(text) -> F.Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line) -> F.Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def dropped_runs(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """(doc_id, text_hash, starts, ends): the runs of lines that a document loses, ends included.

    Documents that lose nothing have no row.
    """
    spark = docs.sparkSession
    slices = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.col("key")
    # Two 64-bit hashes with different seeds: a clash of both is out of reach for any corpus.
    lines = (
        docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
        .select("doc_id", F.xxhash64("text").alias("text_hash"),
                F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
        .select("doc_id", "text_hash", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length(key) >= least_length)
        .select("doc_id", "text_hash", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"),
                F.pmod(F.xxhash64("doc_id"), F.lit(slices)).cast("int").alias("slice"))
    )
    in_slice = Window.partitionBy("h1", "h2", "slice").orderBy("doc_id", "pos")
    overall = Window.partitionBy("h1", "h2").orderBy("doc_id", "pos")
    streamed = (
        lines.repartitionByRange(slices, "h1", "h2", "slice")
        .withColumn("first_doc", F.first("doc_id").over(in_slice))
    )
    late = F.col("doc_id") > F.col("first_doc")
    at = ["doc_id", "text_hash", "pos"]
    # Both branches read the same range exchange.
    dropped = streamed.where(late).select(*at).unionByName(
        streamed.where(~late).withColumn("first_doc", F.first("doc_id").over(overall)).where(late).select(*at))
    gone = F.col("gone")
    first_of_run = F.filter(gone, lambda x, i: (i == 0) | (F.get(gone, i - 1) != x - 1))
    last_of_run = F.filter(gone, lambda x, i: (i == F.size(gone) - 1) | (F.get(gone, i + 1) != x + 1))
    return (
        dropped.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
        .select("doc_id", "text_hash", first_of_run.alias("starts"), last_of_run.alias("ends"))
    )


def drop_repeated_lines(docs: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """docs with `n_lines`, `n_dropped` and `kept_text` added (instead of columns of these names).

    A key is a line stripped of blanks and lower-cased (A-Z). Keys of at least `least_length` code points
    that occur in several documents stay in the smallest doc_id only. A null or empty text is one empty
    line. Rows without a doc_id keep all lines and hold none. Repeated rows of one doc_id are the same
    document; each keeps its own lines. An empty table gives an empty result.
    """
    added = ("n_lines", "n_dropped", "kept_text")
    names = {c: f"_in{k}" for k, c in enumerate(docs.columns)}
    doc_id, text = names["doc_id"], names["text"]
    runs = dropped_runs(docs.select("doc_id", "text"), least_length).toDF("_doc", "_hash", "_starts", "_ends")
    joined = docs.toDF(*names.values()).join(
        runs, (F.col(doc_id) == F.col("_doc")) & (F.xxhash64(text) == F.col("_hash")), "left")
    after_runs = F.concat(F.array(F.lit(0)), F.transform("_ends", lambda x: x + 1))
    kept_runs = F.zip_with(after_runs, F.concat(F.col("_starts"), F.array(F.size("_lines"))),
                           lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    kept = F.flatten(F.transform(kept_runs, lambda r: F.slice(F.col("_lines"), r["start"] + 1, r["length"])))
    lost = F.aggregate(F.zip_with("_starts", "_ends", lambda a, b: b - a + 1), F.lit(0), lambda x, y: x + y)
    return (
        joined.select(*names.values(), lines_of(F.col(text)).alias("_lines"), "_starts", "_ends")
        .select(*[F.col(n).alias(c) for c, n in names.items() if c.lower() not in added],
                F.size("_lines").cast("long").alias("n_lines"),
                F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
                F.when(F.col("_starts").isNull(), F.coalesce(F.col(text), F.lit("")))
                .otherwise(F.array_join(kept, "\n")).alias("kept_text"))
    )

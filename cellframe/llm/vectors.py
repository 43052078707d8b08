"""What the two vector searches share: valid vectors, equal vectors searched once, results for each query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def valid_vectors(rows: DataFrame, component) -> DataFrame:
    """(vec_id, vector): one vector for each id, of the table's most frequent length.

    Rows without id, null or empty vectors and vectors with null or non-finite components take no part,
    nor do vectors of another length. Of several vectors with one id the smallest stands for it.
    component: from a double column to the column wanted.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    clean = rows.where("vec_id IS NOT NULL AND size(embedding) > 0").where(F.forall("embedding", finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: component(x.cast("double"))).alias("vector"))
    widths = clean.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1)
    found = widths.first()
    width = found["width"] if found else 0
    return clean.where(F.size("vector") == width).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def candidates(vectors: DataFrame, k: int) -> DataFrame:
    """vectors without those that k smaller ids with an equal vector push out of any result."""
    equal = Window.partitionBy("vector").orderBy("vec_id")
    return vectors.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k).drop("_n")


def vector_key(vector: str = "vector") -> Column:
    """A string that stands for a whole vector."""
    return F.sha2(F.to_json(F.struct(vector)).cast("binary"), 256)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best (key, vec_id, score) of each key; a pair found twice counts once."""
    once = found.groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n")


def for_queries(queries: DataFrame, results: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) from queries(vec_id, key) and the k + 1 best of each key.

    A query's own row is left out, which leaves at least k of the k + 1.
    """
    lists = results.groupBy("key").agg(F.array_sort(F.collect_list(
        F.struct((-F.col("score")).alias("minus"), "vec_id", "score"))).alias("found"))
    joined = queries.withColumnRenamed("vec_id", "query_id").join(lists, "key")
    others = F.slice(F.filter("found", lambda f: f["vec_id"] != F.col("query_id")), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))

"""The corpus pipeline: stages applied in order to documents, each result written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cellframe.llm.line_dedup import drop_repeated_lines
from cellframe.llm.near_dedup import near_duplicates
from cellframe.llm.packing import pack_documents
from cellframe.llm.quality import select_documents
from cellframe.llm.queries import table, tokenizer_file
from cellframe.llm.substring_dedup import drop_repeated_passages
from cellframe.session import write_through


def with_text(docs: DataFrame, changed: DataFrame, text: str) -> DataFrame:
    """The columns of docs, with the changed text and its length."""
    return changed.select(*[
        F.col(text).alias(c) if c == "text" else F.char_length(text).cast(docs.schema[c].dataType).alias(c)
        if c == "n_chars" else F.col(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return select_documents(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(docs, drop_repeated_lines(docs), "kept_text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; rows without doc_id stay."""
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(docs, drop_repeated_passages(docs), "kept_text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]

#: Scores, minima and token ids are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = write_through(docs, name)
    return docs

"""The registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cellframe.llm import oracles
from cellframe.llm.ann import nearest
from cellframe.llm.bpe import encode_documents
from cellframe.llm.hard_negatives import mine_negatives
from cellframe.llm.html_text import extract_text
from cellframe.llm.language import identify
from cellframe.llm.line_dedup import drop_repeated_lines
from cellframe.llm.lp_packing import pack_into_fewest
from cellframe.llm.near_dedup import near_duplicates
from cellframe.llm.packing import pack_documents
from cellframe.llm.quality import quality_scores
from cellframe.llm.ranked_search import rank_documents
from cellframe.llm.substring_dedup import drop_repeated_passages
from cellframe.llm.topk import top_inner_products


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; Python workers that this session starts from here on find this package."""
    here, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if here not in known.get("PYTHONPATH", "").split(os.pathsep):
        known["PYTHONPATH"] = os.pathsep.join(filter(None, [known.get("PYTHONPATH"), here]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return os.environ.get("CELLFRAME_TOKENIZER", public_tokenizers.path(name))


def is_query() -> Column:
    return F.col("vec_id") % 50 == 0


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), is_query())


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, tokenizer_file(), decoded=True).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_passages(table(spark, sf_dir, "documents").select("doc_id", "text"), joined=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"), is_query())


def op11_lp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_into_fewest(table(spark, sf_dir, "documents"), tokenizer_file())


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One label in seven is made wrong, as its contract asks."""
    return mine_negatives(table(spark, sf_dir, "embeddings"), is_query(),
                          relabel=lambda vec_id, label: F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_line_dedup": op2_line_dedup,
    "op3_html_text": op3_html_text,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_quality": op6_quality,
    "op7_near_dedup": op7_near_dedup,
    "op8_bpe": op8_bpe,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_topk": op10_topk,
    "op11_lp_packing": op11_lp_packing,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_ranked_search": op13_ranked_search,
}

ORACLES = {
    "op2_line_dedup": oracles.LINE_DEDUP,
    "op9_substring_dedup": oracles.SUBSTRING_DEDUP,
    "op10_topk": oracles.TOP_K,
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_ranked_search": oracles.RANKED_SEARCH,
}

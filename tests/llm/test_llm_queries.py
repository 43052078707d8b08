import os

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from cellframe.llm.queries import ORACLES, QUERIES
from oracle_check import compare, connect

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, connect(SF), QUERIES[name], ORACLES[name], SF) == []


def test_every_operator_has_a_query():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_pipeline_stages_against_brute_force(spark):
    """All stages on the smallest tables; each one's result from its own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    labels = {r.doc_id: r.quality == 1 and r.toxic == 0 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}

    def texts(df):
        rows = df.collect()
        assert df.columns == docs.columns and all(r.n_chars == len(r.text or "") for r in rows)
        return [(r.doc_id, r.text) for r in rows]

    kept = stages["quality"](spark, docs, SF).cache()
    ids = {d for d, _ in texts(kept)}
    assert sum((d in ids) == good for d, good in labels.items()) >= 0.85 * len(labels)
    lines = stages["line_dedup"](spark, kept, SF).cache()
    assert dict(texts(lines)) == {d: t for d, (_, _, t) in brute.line_dedup(texts(kept)).items()}
    near = stages["near_dedup"](spark, lines, SF).cache()
    assert {d for d, _ in texts(near)} == {d for d, (_, c) in brute.near_dedup(texts(lines), 5).items() if d == c}
    passages = stages["substring_dedup"](spark, near, SF).cache()
    want = brute.removed_words(texts(near))
    assert {d: brute.WORD.findall(t) for d, t in texts(passages)} == {
        d: [w for w, s in zip(words, stays) if s] for d, (words, stays) in want.items()}
    packed = stages["packing"](spark, passages, SF)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == passages.count()
    whole = corpus_pipeline.run(spark, SF)
    assert whole.select("doc_id", "start", "length", "ids_crc32").exceptAll(
        packed.select("doc_id", "start", "length", "ids_crc32")).count() == 0

"""Quality selection by importance resampling of hashed n-gram models.

Documents are weighed by ratios of generative models over hashed n-grams: the target text (labelled good
and not toxic) against the raw text (all documents) and against labelled toxic text. N-grams are words,
pairs of words, and the first four and five bytes of letter runs, each family in a table of its own.
Rare buckets are drawn to the raw model, so they say little. A logistic fit on labelled documents that
the models have not seen turns the ratios into one log weight, and Gumbel top-k samples by it: the
documents with the largest log weight + Gumbel noise stay. The sample's size is the sum of the chances
that the weights stand for, unless a share is given.

Fitted on a bounded sample: `SAMPLE` labelled rows, the ones whose doc_id hashes lowest, half of them for
the models of target and toxic text, half for the fit. The raw model counts every document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructType

from cellframe.llm.shingles import word_hashes
from cellframe.session import write_through

SAMPLE = 20_000
BUCKETS = 1 << 16
FAMILIES = 4
#: Tokens' worth of raw text in each model.
PRIOR = 100_000.0
SEED = 11

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_LETTER = np.array([chr(c).isalnum() or c > 127 for c in range(256)])


def _starts(text: bytes, length: int) -> np.ndarray:
    """A number for the first bytes of each run of letters, at most `length`."""
    data = np.frombuffer(text + b" " * length, np.uint8)
    letter = _LETTER[data]
    at = np.flatnonzero(letter & ~np.r_[False, letter[:-1]])
    code, inside = np.zeros(len(at), np.uint64), np.ones(len(at), bool)
    for k in range(length):
        inside &= letter[at + k]
        code = (code << np.uint64(8)) + np.where(inside, data[at + k], 0).astype(np.uint64)
    return code


def grams(text: bytes | None) -> list[np.ndarray]:
    """Bucket numbers of each family."""
    text = (text or b"").lower()
    words = word_hashes(text.split())
    hashed = [words, words[:-1] * _STEP + words[1:], _starts(text, 4) * _MIX, _starts(text, 5) * _MIX]
    return [((h ^ (h >> np.uint64(29))) * _STEP >> np.uint64(48)).astype(np.int64) for h in hashed]


@dataclass
class Model:
    """ratios: log target/raw and log target/toxic by family and bucket; then the fit."""

    ratios: tuple[np.ndarray, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def features(self, text: bytes | None) -> list[float]:
        out = []
        for k, at in enumerate(grams(text)):
            n = max(1, len(at))
            raw, toxic = self.ratios[0][k][at], self.ratios[1][k][at]
            out += [raw.sum() / n, toxic.sum() / n ** 0.5, toxic.min() if len(at) else 0.0]
        return out

    def log_weight(self, text: bytes | None) -> float:
        x = (np.array(self.features(text)) - self.mean) / self.scale
        return float(x @ self.weights[:-1] + self.weights[-1])


def labelled_sample(labels: DataFrame, size: int = SAMPLE) -> pd.DataFrame:
    """At most `size` labelled rows, the same ones every time: (doc_id, good, toxic, models)."""
    rows = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
            .withColumn("at", F.xxhash64("doc_id")).orderBy("at", "doc_id").limit(size)
            .select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"),
                    (F.col("toxic") == 1).alias("toxic"), F.pmod("at", F.lit(2)).alias("half")))
    return rows.toPandas()


def _counts(kinds: dict[int, int]):
    """kinds: 1 for target, 2 for toxic, by doc_id."""
    def count(batches):
        raw, target, toxic = np.zeros((3, FAMILIES * BUCKETS), np.int64)
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                found = np.concatenate([at + k * BUCKETS for k, at in enumerate(grams(text))])
                at, n = np.unique(found, return_counts=True)
                raw[at] += n
                kind = kinds.get(doc_id)
                if kind:
                    (target if kind == 1 else toxic)[at] += n
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), *(pa.array(c[at], pa.int64()) for c in (raw, target, toxic))],
            names=["bucket", "raw", "target", "toxic"])
    return count


def _log_ratio(a: np.ndarray, b: np.ndarray, raw: np.ndarray) -> np.ndarray:
    a, b, raw = (x.reshape(FAMILIES, BUCKETS).astype(float) for x in (a, b, raw))
    share = (raw + 0.5) / (raw + 0.5).sum(axis=1, keepdims=True)
    over = (a + PRIOR * share) / (a.sum(axis=1, keepdims=True) + PRIOR)
    under = (b + PRIOR * share) / (b.sum(axis=1, keepdims=True) + PRIOR)
    return np.log(over / under).astype(np.float32)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Only count tables of fixed size and the bounded sample come to the driver."""
    sample = labelled_sample(labels)
    models = sample[sample.half == 0]
    kinds = {int(d): 1 if g else 2 for d, g, t in zip(models.doc_id, models.good, models.toxic) if g or t}
    counted = (_texts(docs).mapInArrow(_counts(kinds), "bucket long, raw long, target long, toxic long")
               .groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "target", "toxic")]).toPandas())
    raw, target, toxic = np.zeros((3, FAMILIES * BUCKETS), np.int64)
    for into, c in ((raw, "raw"), (target, "target"), (toxic, "toxic")):
        into[counted.bucket.to_numpy()] = counted[c].to_numpy()
    width = 3 * FAMILIES
    model = Model((_log_ratio(target, raw, raw), _log_ratio(target, toxic, raw)), np.zeros(width), np.ones(width),
                  np.zeros(width + 1))
    good = {int(d): bool(g) for d, g in zip(sample.doc_id[sample.half == 1], sample.good[sample.half == 1])}
    if len(set(good.values())) < 2:
        return model  # nothing to tell apart: all weights are 0

    def features(batches):
        for batch in batches:
            rows = [(good[d], model.features(t)) for d, t in zip(
                batch["doc_id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()) if d in good]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g for g, _ in rows], pa.bool_()), pa.array([x for _, x in rows], pa.list_(pa.float64()))],
                names=["good", "x"])

    seen = _texts(docs).mapInArrow(features, "good boolean, x array<double>").orderBy("x").toPandas()
    if seen.empty or seen.good.nunique() < 2:
        return model
    return _logistic(model, np.array(seen.x.tolist()), seen.good.to_numpy(float))


def _logistic(model: Model, x: np.ndarray, y: np.ndarray) -> Model:
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    x = np.c_[(x - model.mean) / model.scale, np.ones(len(x))]
    w, ridge = np.zeros(x.shape[1]), np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - w)
    model.weights = w
    return model


def weighed(docs: DataFrame, model: Model) -> DataFrame:
    """docs with `log_weight`, other columns untouched."""
    names = [f"_in{k}" for k in range(len(docs.columns))]
    text = names[docs.columns.index("text")]

    def weigh(batches):
        for batch in batches:
            weights = [model.log_weight(t) for t in batch[text].cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weights, pa.float64())],
                                             names=[*batch.schema.names, "log_weight"])

    renamed = docs.toDF(*names)
    out = renamed.mapInArrow(weigh, StructType(list(renamed.schema.fields)).add("log_weight", DoubleType()))
    return out.toDF(*docs.columns, "log_weight")


def sample_key() -> F.Column:
    """Log weight plus Gumbel noise that hangs on doc_id alone, in units of 2^-20."""
    draw = (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return F.round((F.col("log_weight") - F.log(-F.log(draw))) * float(1 << 20)).cast("long")


def kth_largest(keys: DataFrame, k: int) -> int:
    """The kth largest of a long column `key`, from counts of at most 2^16 ranges a round."""
    low, width = -(1 << 47), 1 << 32
    while True:
        counts = (keys.where((F.col("key") >= low) & (F.col("key") < low + (width << 16)))
                  .groupBy(F.expr(f"(key - ({low})) div {width}").alias("at")).count().toPandas().sort_values("at", ascending=False))
        above = counts["count"].cumsum()
        row = int((above >= k).to_numpy().argmax())
        k -= int(above.iloc[row] - counts["count"].iloc[row])
        low += int(counts["at"].iloc[row]) * width
        if width == 1:
            return low
        width >>= 16


def threshold(scored: DataFrame, share: float | None = None) -> int | None:
    """The smallest sample key that stays; None if nothing is there to choose from."""
    n, expected = scored.agg(F.count("*"), F.sum(1 / (1 + F.exp(-F.col("log_weight"))))).first()
    k = round(expected or 0) if share is None else round(share * n)
    if not n:
        return None
    return kth_largest(scored.select(sample_key().alias("key")), min(max(k, 1), n))


def quality_scores(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """(doc_id, log_weight, kept), a row for each row of docs.

    Null and empty texts have no n-grams and get the weight that this says. Equal rows have equal keys, and
    all rows at the last key stay. Without labels of both kinds all weights are 0 and the sample is of half
    the rows. An empty table gives an empty result; columns other than doc_id and text are ignored.
    """
    scored = write_through(weighed(_texts(docs), fit(docs, labels)).select("doc_id", "log_weight"), "weights")
    least = threshold(scored, share)
    return scored.withColumn("kept", sample_key() >= F.lit(least) if least is not None else F.lit(True))


def select_documents(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """The rows of docs that the sample keeps, with their columns.

    Texts are weighed a second time instead of being joined to their weights: that moves nothing.
    """
    model = fit(docs, labels)
    least = threshold(write_through(weighed(_texts(docs), model).select("doc_id", "log_weight"), "weights"), share)
    if least is None:
        return docs
    named = docs.toDF(*[f"_c{k}" if c != "doc_id" and c != "text" else c for k, c in enumerate(docs.columns)])
    return weighed(named, model).where(sample_key() >= least).drop("log_weight").toDF(*docs.columns)

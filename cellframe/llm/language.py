"""Language identification by nearest centroid.

A text's vector counts hashed pairs and triples of UTF-8 bytes of its lower-cased letters, as
(1 + log count) * idf, scaled to length 1. Each language has several centroids, from spherical k-means
over a sample of its documents; a text gets the language of the centroid with the largest cosine, or none
if all are further away than a given distance.

The idf counts every learning document. The centroids are fitted on a bounded sample: about `SAMPLE`
documents, spread evenly over the languages and drawn by a hash of the doc_id.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SAMPLE = 4000
CENTROIDS = 4
BUCKETS = 1 << 13
ROUNDS = 8

_STEP = np.uint32(0x9E3779B1)
_SHIFT = np.uint32(19)
_LETTER = np.array([chr(c).isalpha() or c > 127 for c in range(256)])
_PLAIN_LETTER = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]").search


def has_letter(text: str | None) -> bool:
    return bool(text) and (_PLAIN_LETTER(text) is not None or any(map(str.isalpha, text)))


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, count) of the n-grams of a text; anything but letters counts as one space."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    letter = _LETTER[data]
    keep = letter | np.r_[True, letter[:-1]]
    x = np.where(letter, data, np.uint8(32))[keep].astype(np.uint32)
    pairs = (x[:-1] << np.uint32(8)) | x[1:]
    triples = (pairs[:-1] << np.uint32(8)) | x[2:]
    at = np.concatenate([(pairs + np.uint32(1 << 24)) * _STEP >> _SHIFT, triples * _STEP >> _SHIFT])
    counts = np.bincount(at, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass
class Model:
    """Unit centroids in rows, with their language; common is the most frequent language."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: list[str]
    common: str | None

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        at, counts = ngrams(text)
        weights = (1 + np.log(counts)) * self.idf[at]
        return at, weights / max(float(np.sqrt(weights @ weights)), 1e-12)

    def predict(self, text: str | None, least_cosine: float = 0.0) -> tuple[str, float]:
        if not has_letter(text) or not self.langs:
            return "und", 0.0
        at, weights = self.vector(text)
        cosines = self.centroids[:, at] @ weights
        k = int(cosines.argmax())
        best = min(1.0, max(0.0, float(cosines[k])))
        if best < least_cosine:
            return "und", best
        return (self.langs[k] if best > 0 else self.common), best


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means; starts from the rows furthest from those taken before."""
    centroids = x[:1]
    while len(centroids) < min(k, len(x)):
        centroids = np.r_[centroids, x[[int((x @ centroids.T).max(axis=1).argmin())]]]
    for _ in range(ROUNDS):
        near = (x @ centroids.T).argmax(axis=1)
        sums = np.array([x[near == c].sum(axis=0) if (near == c).any() else centroids[c] for c in range(len(centroids))])
        centroids = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centroids


def fit(learning: DataFrame, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Model:
    """learning: (doc_id, text, lang) without nulls in text and lang. A language's rows may be any share."""
    def frequencies(batches):
        df = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch["text"].to_pylist():
                df[ngrams(text)[0]] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at])], names=["bucket", "n"])

    langs = {r["lang"]: r["count"] for r in learning.groupBy("lang").count().collect()}
    if not langs:
        return Model(np.zeros(BUCKETS), np.zeros((0, BUCKETS)), [], None)
    total = sum(langs.values())
    counted = learning.select("text").mapInArrow(frequencies, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS)
    df[counted.bucket.to_numpy()] = counted.n.to_numpy()
    idf = np.log((1 + total) / (1 + df)) + 0.1

    # Drawn by hash at a rate that gives each language its part of the sample.
    each = max(1, sample // len(langs))
    rates = F.create_map(*[F.lit(v) for lang, n in langs.items() for v in (lang, min(1.0, each / n))])
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / float(1 << 40)
    model = Model(idf, np.zeros((0, BUCKETS)), [], max(langs, key=lambda lang: (langs[lang], lang)))

    def vectors(batches):
        for batch in batches:
            found = [model.vector(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], pa.array([a.astype(np.int16) for a, _ in found], pa.list_(pa.int16())),
                 pa.array([w.astype(np.float32) for _, w in found], pa.list_(pa.float32()))],
                names=["doc_id", "lang", "at", "weight"])

    rows = learning.where(draw < rates[F.col("lang")]).mapInArrow(
        vectors, "doc_id long, lang string, at array<short>, weight array<float>").toPandas()
    rows = rows.sort_values(["lang", "doc_id"], kind="stable")
    parts = []
    for lang in sorted(langs):
        mine = rows[rows.lang == lang]
        if len(mine):
            x = np.zeros((len(mine), BUCKETS), np.float32)
            for k, (at, weight) in enumerate(zip(mine["at"], mine["weight"])):
                x[k, at] = weight
            parts.append(_clusters(x, centroids))
            model.langs += [lang] * len(parts[-1])
    if parts:
        model.centroids = np.concatenate(parts).astype(np.float64)
    return model


def held_out(doc_id: Column) -> Column:
    """A fifth of all documents, by the checksum of the id as text; rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def identify(docs: DataFrame, sample: int = SAMPLE, least_cosine: float = 0.0) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), a row for each row of docs.

    Learns from rows with id, text and lang that are not held out. `und` for null texts, texts without a
    letter and, with a `least_cosine`, for texts further from all centroids. A text that shares nothing
    with any centroid gets the most frequent language and score 0; ties go to the first language in order
    of its name. Without learning rows all are `und`. Other columns are ignored; an empty table gives an
    empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"), held_out(F.col("doc_id")).alias("held_out"))
    model = fit(rows.where("NOT held_out AND doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
                .select("doc_id", "text", "lang"), sample)

    def predict(batches):
        for batch in batches:
            found = [model.predict(t, least_cosine) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array([lang for lang, _ in found], pa.string()),
                 pa.array([score for _, score in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"])

    return rows.select("doc_id", "held_out", "text").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double")

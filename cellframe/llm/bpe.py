"""BPE encoding and decoding of whole texts, with long texts encoded in pieces by tree concatenation.

A text of ordinary length is encoded in place. A long one is cut into pieces without regard to words, the
pieces are encoded in parallel wherever they land, and then neighbours are concatenated pairwise, up a
tree. Around each join a window that starts and ends at token borders is encoded again and grows until
its first tokens are the left side's and its last tokens the right side's. Every pair of neighbouring
tokens of the result then stands in one of three encodings of the file's own rules, and a sequence whose
neighbours all do is the encoding of the whole: inside a word merges never depend on more than that, and
eight agreed characters fix where words begin (the longest context of the split rule is a contraction).
A window that never agrees ends as the whole of both sides, which is exact as well.
"""

from __future__ import annotations

from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from cellframe.llm.bpe_words import encoder

#: Characters above which a text is cut, and of a piece.
LONG, PIECE = 1 << 16, 1 << 14
LEAST_TOKENS, LEAST_CHARS = 2, 8
OUT_BYTES = 1 << 23


@dataclass
class Encoded:
    """A piece of text with its ids and the characters that each id stands for."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @staticmethod
    def of(tokenizer, text: str, shift: int = 0) -> "Encoded":
        found = tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2) + shift
        return Encoded(text, np.array(found.ids, np.uint32), spans[:, 0], spans[:, 1])

    def same(self, k: int, other: "Encoded", j: int, shift: int) -> bool:
        """Whether token k is the other's token j, which is `shift` characters further on."""
        return (self.ids[k] == other.ids[j] and self.starts[k] == other.starts[j] + shift
                and self.ends[k] == other.ends[j] + shift)


def concatenate(tokenizer, left: Encoded, right: Encoded, window: int = 256) -> Encoded:
    """The encoding of left.text + right.text."""
    text, cut = left.text + right.text, len(left.text)
    while True:
        i = int(np.searchsorted(left.starts, cut - window)) if window < cut else 0
        j = int(np.searchsorted(right.ends, window, "right")) if window < len(right.text) else len(right.ids)
        # No border in reach: take the whole side.
        low = int(left.starts[i]) if 0 < i < len(left.ids) else 0
        i = i if low else 0
        high = cut + int(right.ends[j - 1]) if 0 < j < len(right.ids) else len(text)
        j = j if high < len(text) else len(right.ids)
        middle = Encoded.of(tokenizer, text[low:high], low)
        n, m = len(middle.ids), 0
        while m < min(n, len(left.ids) - i) and middle.same(m, left, i + m, 0):
            m += 1
        agreed_left = not low or m >= LEAST_TOKENS and middle.ends[m - 1] - low >= LEAST_CHARS
        m = 0
        while m < min(n, j) and middle.same(n - 1 - m, right, j - 1 - m, cut):
            m += 1
        agreed_right = high == len(text) or m >= LEAST_TOKENS and high - middle.starts[n - m] >= LEAST_CHARS
        if agreed_left and agreed_right:
            return Encoded(text, *(np.concatenate(c) for c in (
                (left.ids[:i], middle.ids, right.ids[j:]),
                (left.starts[:i], middle.starts, right.starts[j:] + cut),
                (left.ends[:i], middle.ends, right.ends[j:] + cut))))
        window *= 2


def concatenated(tokenizer, pieces: list[Encoded]) -> Encoded:
    while len(pieces) > 1:
        pieces = [concatenate(tokenizer, *pieces[k:k + 2]) if k + 1 < len(pieces) else pieces[k]
                  for k in range(0, len(pieces), 2)]
    return pieces[0]


def _passing(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """docs with safe names for the columns that pass through, and those names."""
    names = {c: f"_in{k}" for k, c in enumerate(docs.columns) if c != "text" and c.lower() not in added}
    return docs.select(*[F.col(c).alias(n) for c, n in names.items()],
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")), names


def _mapped(batches, column: str, make, kind: pa.DataType, name: str):
    """Replaces one column by make(value), in output batches of bounded size."""
    for batch in batches:
        rest = [c for c in batch.schema.names if c != column]
        values, begun, size = [], 0, 0
        source = batch[column].cast(pa.binary())
        for k in range(batch.num_rows):
            values.append(make(source[k].as_py()))
            size += len(values[-1])
            if size >= OUT_BYTES or k == batch.num_rows - 1:
                part = batch.slice(begun, len(values))
                yield pa.RecordBatch.from_arrays([*(part[c] for c in rest), pa.array(values, kind)], names=[*rest, name])
                begun, values, size = begun + len(values), [], 0


def encode_documents(docs: DataFrame, tokenizer: str, long: int = LONG, piece: int = PIECE,
                     decoded: bool = False) -> DataFrame:
    """docs with `ids` (little-endian unsigned 32-bit integers) in the place of `text`.

    decoded adds what decode_documents would, in the same pass. A null or empty text has no ids. Repeated
    rows, null doc_ids and other columns pass through (columns named ids or decoded are replaced); an
    empty table gives an empty result.
    """
    rows, names = _passing(docs, ("ids", "decoded"))
    kept = StructType([rows.schema[n] for n in names.values()])
    schema = StructType(list(kept.fields)).add("ids", BinaryType())
    wanted = StructType(list(schema.fields)).add("decoded", StringType()) if decoded else schema

    def encode(batches):
        out = _mapped(batches, "text", encoder(tokenizer).ids, pa.binary(), "ids")
        return _decoding(tokenizer)(out) if decoded else out

    def encode_pieces(batches):
        for batch in batches:
            found = [Encoded.of(encoder(tokenizer).tokenizer, t) for t in batch["piece"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array([getattr(f, c).astype("<u4").tobytes() for f in found], pa.binary())
                                   for c in ("ids", "starts", "ends"))],
                names=[*batch.schema.names, "ids", "starts", "ends"])

    def join_pieces(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("at", kind="stable")
        copies = group[group["at"] == group["at"].iloc[0]]
        once = group.drop_duplicates("at")
        numbers = lambda data, kind: np.frombuffer(data, "<u4").astype(kind)
        whole = concatenated(encoder(tokenizer).tokenizer, [
            Encoded(t, numbers(i, np.uint32), numbers(s, np.int64), numbers(e, np.int64))
            for t, i, s, e in zip(once.piece, once.ids, once.starts, once.ends)])
        return copies[list(names.values())].assign(ids=whole.ids.astype("<u4").tobytes())

    is_long = F.char_length("text") > long
    at = F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / piece))
    # Equal rows have equal pieces: they are one group, and each copy gets the result.
    pieces = (rows.where(is_long).withColumn("row", F.struct(*names.values())).withColumn("version", F.xxhash64("text"))
              .withColumn("key", F.xxhash64(F.to_json("row"), "version"))
              .select(*names.values(), "key", "version", F.col("text"), F.explode(at).alias("at"))
              .withColumn("piece", F.expr(f"substring(text, cast(at * {piece} + 1 as int), {piece})")).drop("text"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = StructType(list(pieces.schema.fields)).add("ids", BinaryType()).add("starts", BinaryType()).add("ends", BinaryType())
    joined = (pieces.repartition(tasks, "key", "version", "at").mapInArrow(encode_pieces, fields)
              .groupBy("key", "version").applyInPandas(join_pieces, schema))
    short = rows.where(~is_long).mapInArrow(encode, wanted)
    if decoded:
        joined = decode_documents(joined, tokenizer)
    return short.unionByName(joined).select(*[F.col(n).alias(c) for c, n in names.items()], *wanted.names[len(names):])


def _decoding(tokenizer: str):
    """Adds `decoded` to batches with `ids`."""
    def decode(batches):
        inner = encoder(tokenizer).tokenizer
        tokens = [inner.id_to_token(k).encode() for k in range(inner.get_vocab_size())]

        def text(data: bytes | None) -> str:
            return b" ".join([tokens[k] for k in array("I", data or b"")]).decode()

        for batch in batches:
            step = max(1, int(batch.num_rows * OUT_BYTES / max(1, batch.nbytes)))
            for begun in range(0, batch.num_rows, step):
                part = batch.slice(begun, step)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([text(i) for i in part["ids"].to_pylist()], pa.string())],
                    names=[*part.schema.names, "decoded"])
    return decode


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """encoded with `decoded` added: the file has no decoder, so the tokens stand with spaces between them.

    Null ids decode to the empty text; a column named decoded is replaced.
    """
    kept = encoded.select(*[c for c in encoded.columns if c.lower() != "decoded"])
    return kept.mapInArrow(_decoding(tokenizer), StructType(list(kept.schema.fields)).add("decoded", StringType()))

"""Word-wise encoding with a BPE file whose words never merge across white space.

The file's own rules drop white space and merge inside words only, so the ids of a text are the ids of
its white-space-separated chunks in order. A chunk is encoded once and remembered. Chunks with
characters for which Python's Unicode classes could differ from the file's are encoded by the
tokenizers library; all others are cut by the file's pattern and merged by the library's model.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer

# The file's split pattern, as it reads for the characters that NOT_SIMPLE lets through.
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+").findall
# Characters above Latin Extended-B, and those below whose class differs between Python and the file.
NOT_SIMPLE = re.compile("[^\x00-ɏ]|[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbeİ]").search
CACHED = 300_000
LONGEST_CACHED = 48


def printable_bytes() -> dict[int, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the rest get code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Remembered(dict):
    """A two-generation cache: when the young one is full it becomes the old one, which is dropped."""

    def __init__(self, make, limit: int = CACHED):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordEncoder:
    """ids(): all ids of a text given as UTF-8 bytes, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.alphabet = printable_bytes()
        self.words = Remembered(self._word, CACHED // 4)
        self.chunks = Remembered(self._chunk)

    def library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> bytes:
        if not word.isascii() or not word.isprintable():
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return packed(t.id for t in self.model.tokenize(word))

    def _chunk(self, chunk: bytes) -> bytes:
        if chunk.isalpha():  # of ASCII
            return packed(t.id for t in self.model.tokenize(chunk.decode().lower()))
        text = chunk.decode()
        if NOT_SIMPLE(text) or any(s in text for s in self.specials):
            return packed(self.library(text))
        return b"".join([self.words[word] for word in WORDS(text.lower())])

    def ids(self, text: bytes) -> bytes:
        return b"".join(map(self.chunks.__getitem__, text.split()))


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]

"""Byte-pair encoding and decoding by a contiguous rank array per short word.

A word is held as its part boundaries beside the ranks of adjacent parts. The
smallest rank (leftmost on ties) is looked for again and again; its inner
boundary is deleted and the two neighbouring ranks are refreshed. Words of more
than ``SHORT`` parts, where scanning would take quadratic time, are merged in
the same order through a heap.

The vocabulary is a tokenizer file in the public JSON format with a byte-level
BPE model, an end-of-word suffix, and white space dropped between words. Texts
are whole; a null text is empty and gives no ids. Repeated rows are encoded
each; other columns are never touched, and results go to the names given.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from contextlib import contextmanager
from hashlib import sha256

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillgrid.llm.common import Batches, Remembered, batch_of, in_batches

SHORT = 128
KNOWN = 100_000  # of runs and of words, at most twice as many are remembered
# Fixed values of the tokenizer format: Unicode's white space, and how words are taken from a text.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NONE = 1 << 62


def packed_ids(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    packed = array("I", ids)
    if sys.byteorder != "little":
        packed.byteswap()
    return packed.tobytes()


def byte_signs() -> list[str]:
    """The printable sign that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file; built once in each Python worker."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.signs = byte_signs()
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (left, right) in enumerate(model["merges"]):
            self.merges[self.vocab[left], self.vocab[right]] = rank, self.vocab[left + right]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_of = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in {**self.vocab, **self.special}.items()}
        self.chunks = re.compile(f"[^{SPACE}]+")
        self.pieces = regex.compile(PIECES)
        self.forget()

    def forget(self) -> None:
        self.chunk_ids = Remembered(self.encode_chunk, KNOWN)
        self.word_ids = Remembered(self.encode_word, KNOWN)

    def parts(self, word: str) -> list[int]:
        signs = [self.signs[b] for b in word.encode()]
        signs[-1] += self.suffix
        return [self.vocab[s] for s in signs if s in self.vocab]

    def merge(self, parts: list[int]) -> list[int]:
        """Merge the parts of one word; ``ranks[i]`` is the rank of parts i and i + 1."""
        if len(parts) > SHORT:
            return self.merge_long(parts)
        find = self.merges.get
        ranks = [(find(pair) or (NONE,))[0] for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = find((parts[i], parts[i + 1]))[1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = (find((parts[i], parts[i + 1])) or (NONE,))[0]
            if i:
                ranks[i - 1] = (find((parts[i - 1], parts[i])) or (NONE,))[0]
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        find, n = self.merges.get, len(parts)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (found := find((parts[i], parts[after[i]]))):
                heapq.heappush(heap, (found[0], i, parts[i], parts[after[i]], found[1]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            if parts[i] != left or after[i] >= n or parts[after[i]] != right:
                continue
            gone = after[i]
            parts[i], parts[gone], after[i] = merged, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p >= 0]

    def encode_word(self, word: str) -> bytes:
        return packed_ids(self.merge(self.parts(word)))

    def encode_chunk(self, chunk: str) -> bytes:
        """Ids of a run of signs without white space, as little-endian unsigned 32-bit integers."""
        text = unicodedata.normalize("NFC", chunk)
        text = "".join(map(str.lower, text)) if "\u03a3" in text else text.lower()  # sign by sign, as no word's end counts
        if text.isascii() and text.isalpha():
            return self.word_ids[text]
        return b"".join(map(self.word_ids.__getitem__, self.pieces.findall(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers.

        No word spans white space and normal forms do not cross it, so the text
        is taken run by run and short runs are remembered.
        """
        if not text:
            return b""
        if "<|" not in text:
            return b"".join(map(self.chunk_ids.__getitem__, self.chunks.findall(text)))
        out = []
        for part in self.special_of.split(text):
            if part in self.special:
                out.append(packed_ids([self.special[part]]))
            else:
                out.extend(map(self.chunk_ids.__getitem__, self.chunks.findall(part)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """The tokens' texts joined by blanks, special tokens kept: the format names no decoder of its own."""
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_codecs: dict[int, Codec] = {}


@contextmanager
def codec(content: str) -> Iterator[Codec]:
    """The codec of a vocabulary, kept for the life of the worker; the words it remembers go with the task, so no later stage holds them."""
    key = hash(content)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(content)
    try:
        yield _codecs[key]
    finally:
        _codecs[key].forget()


def read_vocabulary(path: str) -> str:
    """A vocabulary file of some MB, read where the job is built and broadcast as it is."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encoded(docs: DataFrame, content: str, keep: str = "doc_id", text: str = "text") -> DataFrame:
    """``keep`` and ``ids`` (binary, little-endian unsigned 32-bit integers) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(content)
    rows = docs.select(keep, text)
    kind = rows.schema[keep].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        with codec(shared.value) as own:
            for batch in batches:
                ids = [own.encode(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[keep, "ids"])

    return in_batches(rows, run, f"`{keep}` {kind}, ids binary")


def decoded(ids: DataFrame, content: str, keep: str = "doc_id") -> DataFrame:
    """``keep`` and ``text`` from the ids of ``encoded``."""
    shared = ids.sparkSession.sparkContext.broadcast(content)
    rows = ids.select(keep, "ids")
    kind = rows.schema[keep].dataType.simpleString()

    def run(batches: Batches) -> Batches:
        with codec(shared.value) as own:
            for batch in batches:
                texts = [own.decode(i or b"") for i in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[keep, "text"])

    return in_batches(rows, run, f"`{keep}` {kind}, text string")


DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def round_trip(docs: DataFrame, content: str) -> DataFrame:
    """Encode and decode every text; per row doc_id, n_tokens and the hashes of ids and decoded text.

    Both directions run in one pass, so neither ids nor texts are stored or shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def run(batches: Batches) -> Batches:
        with codec(shared.value) as own:
            for batch in batches:
                count, ids_hash, text_hash = [], [], []
                for text in batch.column(1).to_pylist():
                    ids = own.encode(text)
                    count.append(len(ids) // 4)
                    ids_hash.append(sha256(ids).hexdigest())
                    text_hash.append(sha256(own.decode(ids).encode()).hexdigest())
                yield batch_of(DIGEST, [batch.column(0), count, ids_hash, text_hash])

    kind = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "text"), run, kind)

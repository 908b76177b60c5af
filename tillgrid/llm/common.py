"""Helpers that several operators of this package share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.session import scratch_dir

# Rows handed to Python at once: bounds a worker's memory by so many texts.
BATCH_ROWS = 1000
# Words a worker remembers between rows, and the longest it remembers (bytes or characters).
REMEMBERED, LONGEST = 300_000, 64
# The bytes that part words, and those that stay around a key of a line: space, \t \n \v \f \r.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result once to the shared folder and read it back: lineage ends here."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow over batches of a bounded number of rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(function, schema)


def ascii_lower(column):
    """Lower-case A-Z alone."""
    return F.translate(column, UPPER, LOWER)


class Remembered(dict):
    """A function of short keys with a memory of at most twice ``bound`` results.

    A full memory becomes the older one and is asked once more before the
    function is, so what comes often stays.
    """

    def __init__(self, function: Callable, bound: int = REMEMBERED):
        super().__init__()
        self.function, self.bound, self.older = function, bound, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(key) <= LONGEST:
            if len(self) >= self.bound:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


def bytes_table(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1)


def blended(x: np.ndarray) -> np.ndarray:
    """Spread what differs between 64-bit numbers over all their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """64-bit hashes of the shingles of ``width`` words; fewer words make one shingle, none make none.

    A-Z are lower-cased and words parted at ASCII blanks. Words are hashed all
    at once: byte values weighed by powers of an odd number are summed up along
    the text, and a word's hash is a difference of two sums. Texts are taken in
    slices of some MB that end at blanks, so memory follows the slice.
    """

    SLICE = 1 << 20
    BASE = 0x9E3779B97F4A7C17
    FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    INSIDE = bytes(chr(b) not in BLANKS for b in range(256))
    GAPS = re.compile(rb"[\x20\x09-\x0D]")

    def __init__(self, width: int = 5):
        self.width = width
        self.values = bytes_table(7, 256)
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        """Powers of the base and of its inverse modulo 2^64."""
        inverse = pow(self.BASE, -1, 1 << 64)
        self.powers, self.inverses = (
            np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)])) for x in (self.BASE, inverse)
        )

    def word_hashes(self, text: bytes) -> np.ndarray:
        data = np.frombuffer(text.translate(self.FOLD), np.uint8)
        n = len(data)
        if n >= len(self.powers):
            self.grow(2 * n)
        inside = np.frombuffer(b"\0" + text.translate(self.INSIDE) + b"\0", np.int8)
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values.take(data) * self.powers[:n], out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * self.inverses[starts]
        return blended(hashes + (ends - starts).astype(np.uint64))

    def slices(self, text: bytes) -> Iterator[bytes]:
        at = 0
        while len(text) - at > self.SLICE:
            gap = self.GAPS.search(text, at + self.SLICE)
            end = gap.start() if gap else len(text)
            yield text[at:end]
            at = end
        yield text[at:]

    def __call__(self, text: bytes | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint64)
        hashes = np.concatenate([self.word_hashes(part) for part in self.slices(text)])
        width = min(self.width, len(hashes))
        count = len(hashes) - width + 1 if width else 0
        mixed = np.full(count, width, np.uint64)
        for i in range(width):
            mixed = (mixed ^ hashes[i : i + count]) * np.uint64(self.BASE)
            mixed ^= mixed >> np.uint64(29)
        return blended(mixed)


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


Batches = Iterator[pa.RecordBatch]

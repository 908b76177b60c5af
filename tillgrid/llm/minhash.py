"""Document fingerprints by one-permutation MinHash.

Every shingle of five words is hashed once; the top bits name its bin, and each
bin keeps its smallest hash. An empty bin takes the value of another by optimal
densification: it walks its own random order of the bins, the same in every
document, to the first that is not empty. Of each value only the lowest bits
are packed. Two fingerprints agree in a place by chance with probability
2^-bits; the likeness is corrected for that bias.

Fewer words than five make one shingle. Texts without words (null, empty,
blanks alone) have the empty fingerprint: likeness 1 to each other and 0 to all
else. Fingerprints are lower-case hex.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import Batches, Shingles, batch_of, in_batches

BINS, BITS, WIDTH = 1024, 4, 5
NO_ID = -(1 << 63)


class Fingerprint:
    def __init__(self, bins: int = BINS, bits: int = BITS, width: int = WIDTH, seed: int = 1):
        if bins & (bins - 1) or 8 % bits:
            raise ValueError("bins must be a power of two and bits a divisor of 8")
        self.bins, self.bits = bins, bits
        self.shingles = Shingles(width)
        self.shift = np.uint64(64 - bins.bit_length() + 1)
        self.starts = np.arange(bins, dtype=np.uint64) << self.shift
        order = np.random.Generator(np.random.PCG64(seed))
        self.walks = np.stack([order.permutation(bins) for _ in range(bins)]).astype(np.uint16)

    def codes(self, text: bytes | None) -> np.ndarray | None:
        hashes = np.sort(self.shingles(text))
        if not len(hashes):
            return None
        at = np.searchsorted(hashes, self.starts)
        least = hashes[np.minimum(at, len(hashes) - 1)]
        full = (at < len(hashes)) & ((least >> self.shift) == np.arange(self.bins, dtype=np.uint64))
        empty, steps = np.flatnonzero(~full), 16
        done = 0
        while len(empty):
            seen = full[self.walks[empty, done : done + steps]]
            hit = seen.any(axis=1)
            at_hit = empty[hit]
            least[at_hit] = least[self.walks[at_hit, done + seen[hit].argmax(axis=1)]]
            empty, done, steps = empty[~hit], done + steps, steps * 4
        return (least & np.uint64((1 << self.bits) - 1)).astype(np.uint8)

    def __call__(self, text: bytes | None) -> str:
        codes = self.codes(text)
        if codes is None:
            return ""
        per_byte = 8 // self.bits
        parts = codes.reshape(-1, per_byte)
        packed = np.zeros(len(parts), np.uint8)
        for i in range(per_byte):
            packed |= parts[:, i] << np.uint8(i * self.bits)
        return packed.tobytes().hex()

    def likeness(self, one: str, other: str) -> float:
        """Estimated Jaccard similarity of two documents' shingles, 0 to 1."""
        if not one or not other:
            return float(one == other)
        differ = np.frombuffer(bytes.fromhex(one), np.uint8) ^ np.frombuffer(bytes.fromhex(other), np.uint8)
        mask = np.uint8((1 << self.bits) - 1)
        same = sum(int((((differ >> np.uint8(i)) & mask) == 0).sum()) for i in range(0, 8, self.bits)) / self.bins
        chance = 2.0**-self.bits
        return min(1.0, max(0.0, (same - chance) / (1 - chance)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row."""

    def run(batches: Batches) -> Batches:
        own = Fingerprint()
        for batch in batches:
            marks = [own(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string())], names=["doc_id", "fingerprint"])

    return in_batches(docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as binary) text"), run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (segment, again, key, text) such that a segment's rows, sorted, hold every document before its follower.

    Ids are cut into segments of about equal counts; the first document of a
    segment stands a second time (``again`` = 1) at the end of the segment
    before, the very first at the end of the last. Texts are dealt out once.
    Only cut points and first ids, one per segment, come to the driver.
    """
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.col("text").cast("string").alias("text"))
    count = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(i / count) for i in range(1, count)])
    found = rows.agg(F.percentile_approx("key", shares, F.lit(20 * count)).alias("cuts")).first().cuts
    cuts = np.unique(np.array(found or [], np.int64))

    @F.pandas_udf("int")
    def segment(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, key.to_numpy(), side="right").astype(np.int32))

    firsts = sorted((r.least, r.segment) for r in rows.groupBy(segment("key").alias("segment")).agg(F.min("key").alias("least")).collect())
    keys = np.array([k for k, _ in firsts], np.int64)
    before = np.array([firsts[i - 1][1] for i in range(len(firsts))], np.int32)

    @F.pandas_udf("array<int>")
    def segments(key: pd.Series) -> pd.Series:
        own = np.searchsorted(cuts, key.to_numpy(), side="right")
        at = np.minimum(np.searchsorted(keys, key.to_numpy()), len(keys) - 1)
        return pd.Series([[s, before[i]] if keys[i] == k else [s] for s, i, k in zip(own, at, key)])

    placed = rows.select("key", "text", F.posexplode(segments("key")).alias("again", "segment"))
    return placed.repartition(count // 4, "segment").sortWithinPartitions("segment", "again", "key", "text")


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprint of each document, of its edited text, and their likeness to each other and to the next document.

    The edited text takes its last half from the start of the next document by
    doc_id (after the last: the first). Rows that share a doc_id follow each
    other in the order of their texts; null doc_ids come first.
    """

    def run(batches: Batches) -> Batches:
        own, held = Fingerprint(), None
        for batch in batches:
            out = []
            for segment, again, key, text in zip(*(batch.column(c).to_pylist() for c in ("segment", "again", "key", "text"))):
                text = text or ""
                mark = own(text.encode())
                if held and held[0] == segment and not held[1]:
                    _, _, before, old, old_mark = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    edited_mark = own(edited.encode())
                    out.append((
                        None if before == NO_ID else before, len(old), sha256(edited.encode()).hexdigest(), old_mark, edited_mark,
                        own.likeness(old_mark, edited_mark), own.likeness(old_mark, mark),
                    ))
                held = segment, again, key, text, mark
            yield batch_of(RESULT, list(map(list, zip(*out))) if out else [[]] * len(RESULT))

    rows = in_order(docs).select("segment", "again", "key", "text")
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_batches(rows, run, kind)

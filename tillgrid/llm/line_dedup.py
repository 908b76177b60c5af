"""Line dedup by range-partitioned hashes and compressed keep bitmaps.

Lines become rows of a 128-bit hash of their key, document and position. The
rows are dealt into ranges of (hash, document) and sorted by hash, document
(largest first) and position, so that equal keys stand together and a very
common one is spread over several ranges. Each range is read as a stream: the
first document of a key keeps its lines, the lines of the others are dropped
once the key is found in enough documents. A key that touches a range's edge
may go on beyond it; such keys are decided by one row per range and edge. The
result is a compressed bitmap of kept lines per document, not text.

Texts are parted at ``\\n``; a null or empty text is one empty line. A document
is its doc_id: rows that share one count once, and each loses its lines by its
own positions. Null doc_ids are one document that comes after all others. Keys
are compared by hash, so no text is shuffled to compare lines.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillgrid.llm.common import BLANKS, Batches, ascii_lower, in_batches, stored

MIN_CHARS, MIN_DOCS = 20, 3
# What a null doc_id stands for while lines are compared: a document after all others.
NO_ID = -(1 << 63)
FIELDS = ("h1", "h2", "doc", "part", "pos")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2 (hash of the key), doc, part (tells rows of one doc_id apart), pos of every line with a long enough key."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("part"),
        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"),
    ).select("doc", "part", "pos", ascii_lower(F.btrim("line", F.lit(BLANKS))).alias("key"))
    return rows.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), "doc", "part", "pos"
    )


MARKED = "h1 long, h2 long, doc long, part long, pos int, edge boolean"


def marked_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Rows to drop for sure, and (``edge``) all rows of keys that touch an edge of their range."""
    count = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(count, "h1", "h2", "doc").sortWithinPartitions("h1", "h2", F.desc("doc"), "part", "pos")

    def run(batches: Batches) -> Batches:
        first, held = True, []  # the chunks of a key that is not over yet

        def flush(chunks: list[dict], edge: bool) -> Iterator[pa.RecordBatch]:
            if not chunks:
                return
            rows = {c: np.concatenate([x[c] for x in chunks]) for c in FIELDS}
            if edge:
                take = np.ones(len(rows["h1"]), bool)
            else:
                take = dropped(rows, min_docs)
            if take.any():
                columns = [pa.array(rows[c][take]) for c in FIELDS]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(int(take.sum()), edge))], names=[*FIELDS, "edge"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(i).to_numpy() for i, c in enumerate(FIELDS)}
            keys = np.flatnonzero((np.diff(rows["h1"]) != 0) | (np.diff(rows["h2"]) != 0)) + 1
            same = held and held[-1]["h1"][-1] == rows["h1"][0] and held[-1]["h2"][-1] == rows["h2"][0]
            if held and not same:
                yield from flush(held, first)
                first, held = False, []
            if not len(keys):
                held.append(rows)
                if first or len(held) > 64:  # rows of an edge need not be held; long inner keys are joined up
                    if first:
                        yield from flush(held[:-1], True)
                        held = held[-1:]
                    else:
                        held = [{c: np.concatenate([x[c] for x in held]) for c in FIELDS}]
                continue
            yield from flush([*held, {c: v[: keys[0]] for c, v in rows.items()}], first)
            if len(keys) > 1:
                yield from flush([{c: v[keys[0] : keys[-1]] for c, v in rows.items()}], False)
            first, held = False, [{c: v[keys[-1] :] for c, v in rows.items()}]
        yield from flush(held, True)

    dealt.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    return dealt.mapInArrow(run, MARKED)


def dropped(rows: dict, min_docs: int) -> np.ndarray:
    """Of whole keys in order: lines that do not stand in their key's first document, if it has enough documents."""
    n = len(rows["h1"])
    new_key = np.ones(n, bool)
    new_key[1:] = (np.diff(rows["h1"]) != 0) | (np.diff(rows["h2"]) != 0)
    new_doc = new_key.copy()
    new_doc[1:] |= np.diff(rows["doc"]) != 0
    key = np.cumsum(new_key) - 1
    docs = np.bincount(key, new_doc)
    rank = np.cumsum(new_doc)
    return (docs[key] >= min_docs) & (rank != rank[new_key][key])


def drops(rows: DataFrame, min_docs: int) -> DataFrame:
    """doc, part, pos of every line to drop."""
    marked = stored(marked_lines(rows, min_docs), "line-marks")
    edge = marked.where("edge")
    # Two keys per range at most, so this side is bounded by the number of ranges.
    decided = edge.groupBy("h1", "h2").agg(F.max("doc").alias("_keep"), F.count_distinct("doc").alias("_docs")).where(F.col("_docs") >= min_docs)
    at_edges = edge.join(F.broadcast(decided), ["h1", "h2"]).where("doc < _keep")
    return marked.where("not edge").select("doc", "part", "pos").union(at_edges.select("doc", "part", "pos"))


def bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc, part, dropped (compressed bitmap of dropped positions) of every document that loses a line.

    A document without a row keeps every line. Hashes of lines are written once
    to the shared folder, as dealing them into ranges reads them twice.
    """
    rows = stored(line_rows(docs, min_chars), "line-hashes")
    lists = drops(rows, min_docs).groupBy("doc", "part").agg(F.collect_set("pos").alias("at"))
    return lists.select("doc", "part", F.pandas_udf(pack_positions, "binary")("at").alias("dropped"))


def pack_positions(at: pd.Series) -> pd.Series:
    """zlib over the bits of the positions, up to the last one set."""
    out = []
    for positions in at:
        bits = np.zeros(max(positions) + 1, np.uint8)
        bits[np.asarray(positions)] = 1
        out.append(zlib.compress(np.packbits(bits).tobytes(), 6))
    return pd.Series(out)


def kept_lines(text: str | None, bitmap: bytes | None) -> tuple[list[str], int]:
    """The lines that stay, and the number of lines before."""
    lines = (text or "").split("\n")
    if not bitmap:
        return lines, len(lines)
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return [line for i, line in enumerate(lines) if i >= len(bits) or not bits[i]], len(lines)


def with_bitmaps(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of docs with their bitmap (null: every line stays) as ``_dropped``."""
    keyed = docs.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_part": F.xxhash64("text")})
    side = found.select(F.col("doc").alias("_doc"), F.col("part").alias("_part"), F.col("dropped").alias("_dropped"))
    return keyed.join(side, ["_doc", "_part"], "left").drop("_doc", "_part")


def apply_bitmaps(docs: DataFrame, found: DataFrame) -> DataFrame:
    """docs with the lines that stay as ``text``; rows without a dropped line are as before."""

    @F.pandas_udf("string")
    def rest(text: pd.Series, bitmap: pd.Series) -> pd.Series:
        return pd.Series([t if not b else "\n".join(kept_lines(t, b)[0]) for t, b in zip(text, bitmap)], dtype=object)

    joined = with_bitmaps(docs, found)
    return joined.withColumn("text", F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(rest("text", "_dropped"))).select(*docs.columns)


def digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the lines kept, by bitmaps."""
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    joined = with_bitmaps(rows, bitmaps(rows, min_chars, min_docs)).select("doc_id", "text", "_dropped")

    def run(batches: Batches) -> Batches:
        from hashlib import sha256

        for batch in batches:
            count, gone, hashes = [], [], []
            for text, bitmap in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                lines, before = kept_lines(text, bitmap)
                count.append(before)
                gone.append(before - len(lines))
                hashes.append(sha256("\n".join(lines).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(gone, pa.int64()), pa.array(hashes, pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
            )

    return in_batches(joined, run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")

"""WARC archives: one gzip member per record, written and read by Spark's own file sources.

Writing: a row is a compressed member without its last byte, and the text
writer's line separator is that byte (the top byte of a gzip trailer's length,
zero up to 16 MB; a larger member is followed by an empty one). Files are thus
plain ``.warc.gz`` content, committed by Spark wherever it can write.

Reading: archives are split by byte ranges. The text reader's separator is the
gzip magic, so a task gets the candidates that start in its range, whichever
range they end in. A candidate is valid if its gzip header can be decoded and
what it holds begins as a WARC record; a magic that occurs inside compressed
data is put back. Pieces of a member that such a false magic moved across a
range's edge are put together afterwards.

Nothing is lost without a word: a member that is damaged or cut short, bytes
that belong to no record and payloads that do not agree with their digest come
back as rows whose ``error`` says so, with what can be told of the record. Files
whose name ends in ``.gz`` are read too, each by one task that streams it, as
Spark takes them for compressed and does not split them; others are split.
Digests by another method than SHA-1 are passed on as they are.

Null payloads are empty, null ids and addresses are left out of the headers and
come back as null. Rows that repeat a page_id are records of their own.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm.common import Batches, batch_of, in_batches, stored

MAGIC = b"\x1f\x8b\x08"
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # the rows have no time of their own; one value makes reruns agree
# Files named .gz are not to be decompressed by the text source; the second name is that of Spark's own build of Hadoop.
AS_THEY_ARE = {
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".gz", "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".gz",
}
EMPTY_MEMBER = bytes.fromhex("1f8b080000000000000303000000000000000000")


def with_decisions(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload (binary), refers_to: the largest page_id with an equal payload, null for that one itself.

    Only payloads that occur more than once are joined back, by their SHA-256.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"),
    )
    hashed = rows.withColumn("_hash", F.unhex(F.sha2("payload", 256)))
    repeated = (
        hashed.where(F.octet_length("payload") >= min_bytes).groupBy("_hash")
        .agg(F.max("page_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    )
    first = F.when(F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return hashed.join(repeated, "_hash", "left").select("page_id", "url", "payload", first.alias("refers_to"))


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record before compression. A revisit holds the HTTP head with its Content-Length, not the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"WARC-Record-ID: <urn:page:{page_id}>")
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(content: bytes) -> bytes:
    """A gzip member whose last byte is zero."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    out = packer.compress(content) + packer.flush()
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Write a record per page; reruns give the same records."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            members = [member(record(*(row.values())))[:-1] for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    rows = in_batches(with_decisions(pages, min_bytes), run, "member binary")
    rows.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def candidate(data: bytes) -> tuple[str, bytes]:
    """What bytes that begin with the gzip magic are, and their content.

    whole: a record; extra: a record and bytes behind it; open: the start of
    one; short: too little to tell; empty: a member without content; bad: the
    start of a record that cannot be decoded to its end; no: anything else.
    """
    reader, start = zlib.decompressobj(31), b""
    try:
        start = reader.decompress(data, 64)
        if start:
            if not start.startswith(b"WARC/1."[: len(start)]):
                return "no", b""
            content = start + reader.decompress(reader.unconsumed_tail) if not reader.eof else start
            if not reader.eof:
                content += reader.flush()
            return ("extra" if reader.unused_data else "whole", content) if reader.eof else ("open", b"")
        return ("empty", b"") if reader.eof else ("short" if len(data) < 64 else "no", b"")
    except zlib.error:
        return ("bad" if start.startswith(b"WARC/1.") else "no"), b""


def salvaged(data: bytes) -> bytes:
    """The content of a broken member as far as it can be decoded."""
    reader, out = zlib.decompressobj(31), b""
    try:
        for at in range(0, len(data), 256):
            out += reader.decompress(data[at : at + 256])
    except zlib.error:
        pass
    return out


def headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("refers_to", pa.int64()), ("payload", pa.binary()), ("error", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("turn", pa.int64()), ("piece", pa.binary()),
])
RECORD = ("page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "error")
READ_DDL = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary,"
    " error string, file string, block long, turn long, piece binary"
)


def page_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def length_of(value: str | None, otherwise: int) -> int:
    return int(value) if value is not None and value.isascii() and value.isdigit() else otherwise


def parsed(content: bytes, payloads: bool = True) -> tuple:
    """The fields of ``RECORD``. A response's SHA-1 is computed again and should agree with its header."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = headers(head)
    size = length_of(fields.get("content-length"), len(rest))
    error = None if size <= len(rest) else "record is shorter than its length"
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    given, kind = fields.get("warc-payload-digest", ""), fields.get("warc-type", "")
    digest = given.removeprefix("sha1:")
    size = length_of(headers(http).get("content-length"), len(payload))
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if not given or given.startswith("sha1:"):
            digest = digest or found
            if (found, len(payload)) != (digest, size):
                error = error or "payload does not agree with its digest or length"
    return (
        page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, size, digest,
        page_of(fields.get("warc-refers-to")), payload if kind == "response" and payloads else None, error,
    )


def broken(data: bytes, reason: str) -> tuple:
    """The row of bytes that are no whole record."""
    head, found, _ = salvaged(data).partition(b"\r\n\r\n")
    fields = headers(head) if found else {}
    return page_of(fields.get("warc-record-id")), fields.get("warc-target-uri"), fields.get("warc-type"), None, None, None, None, reason


CUT, DAMAGED, STRAY = "record is cut short", "record is damaged", "bytes that belong to no record"


class Assembler:
    """Pieces in the order of a file's range: whole records, and the pieces that another range must complete."""

    def __init__(self):
        self.open, self.records, self.loose, self.turn = b"", [], [], 0
        self.bad: list[tuple[bytes, str]] = []  # bytes, and what is wrong with them

    def feed(self, piece: bytes, at_start: bool = False) -> None:
        """``piece`` followed a magic, unless it is what stands before a file's first one."""
        self.turn += 1
        if at_start and self.turn == 1:
            if piece:
                self.bad.append((piece, STRAY))
            return
        data = MAGIC + piece
        kind, content = candidate(data)
        if self.open and kind in ("no", "short"):
            self.extend(data)
        elif kind == "no":
            self.loose.append((self.turn, data))
        else:
            self.settle()
            if not self.take(kind, content, data) and kind != "empty":
                self.open = data

    def take(self, kind: str, content: bytes, data: bytes) -> bool:
        """Keep what is decided: a record, or a broken one."""
        if kind in ("whole", "extra"):
            self.records.append(content)
        if kind in ("bad", "extra"):
            self.bad.append((data, DAMAGED) if kind == "bad" else (b"", STRAY))
        return kind in ("whole", "extra", "bad")

    def extend(self, data: bytes) -> None:
        self.open += data
        kind, content = candidate(self.open)
        if self.take(kind, content, self.open):
            self.open = b""

    def settle(self) -> None:
        if self.open:
            self.loose.append((self.turn, self.open))
            self.open = b""


def read_pieces(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records, and rows with a ``piece`` for what a range could not complete."""
    pieces = (
        spark.read.options(**AS_THEY_ARE).option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
        .select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    )

    def out(own: Assembler, place: tuple[str, int]) -> pa.RecordBatch:
        rows = [(*parsed(c, payloads), *[None] * 4) for c in own.records] + [(*broken(*b), *[None] * 4) for b in own.bad]
        rows += [(*[None] * 8, *place, turn, data) for turn, data in own.loose]
        own.records, own.loose, own.bad = [], [], []
        return batch_of(READ, list(map(list, zip(*rows))) if rows else [[]] * len(READ))

    def run(batches: Batches) -> Batches:
        own, place = Assembler(), None
        for batch in batches:
            for piece, *here in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(here) != place:
                    if place:
                        own.settle()
                        yield out(own, place)
                    own, place = Assembler(), tuple(here)
                own.feed(piece, at_start=place[1] == 0)
            yield out(own, place)
        if place:
            own.settle()
            yield out(own, place)

    return in_batches(pieces, run, READ_DDL)


def joined_pieces(rows: pd.DataFrame) -> pd.DataFrame:
    """Records from the pieces of one file that crossed a range's edge: rare, at most a false magic apart. What fits nowhere is told."""
    records, data = [], b""

    def left_over() -> None:
        if data:
            kind = candidate(data)[0]
            records.append(broken(data, {"open": CUT, "bad": DAMAGED}.get(kind, STRAY)))

    for piece in rows.sort_values(["block", "turn"])["piece"]:
        if candidate(piece)[0] != "no" and data and candidate(data + piece)[0] in ("no", "bad"):
            left_over()
            data = b""
        data += piece
        kind, content = candidate(data)
        if kind in ("whole", "extra"):
            records.append(parsed(content))
            data = b""
            if kind == "extra":
                records.append(broken(b"", STRAY))
    left_over()
    return pd.DataFrame(records, columns=RECORD).astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits), error.

    Without payloads the archives are read once and what was found is stored;
    with them, the pieces of crossed edges come from a second read.
    """
    read = read_pieces(spark, path, payloads)
    read = read if payloads else stored(read, "warc-records")
    whole = read.where("piece is null").select(*RECORD)
    crossed = read.where("piece is not null").groupBy("file").applyInPandas(joined_pieces, READ_DDL.split(", file")[0])
    return whole.union(crossed) if payloads else whole.union(crossed).drop("payload")

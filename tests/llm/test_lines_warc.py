"""Line dedup and WARC against plain Python."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib
from collections import defaultdict
from pathlib import Path

import pandas as pd
import pytest

from tillgrid.llm import line_dedup, warc

BLANKS = " \t\n\x0b\f\r"
SCHEMA = "doc_id long, text string, part string, pos int, dropped string"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def kept_by_force(rows, min_chars=20, min_docs=3):
    """(doc_id, n_lines, n_dropped, text kept) of each row."""
    found = defaultdict(set)
    rank = lambda d: -1 if d is None else d
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                found[key_of(line)].add(rank(doc))
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key_of(x)) < min_chars or len(found[key_of(x)]) < min_docs or max(found[key_of(x)]) == rank(doc)]
        out.append((doc, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


@pytest.fixture(scope="module")
def rows():
    source = random.Random(3)
    pool = [f"  Shared LINE number {i} of the pool é\t" for i in range(12)] + ["short", "", "exactly twenty chars", " Exactly Twenty Chars\r"]
    made = [(i, "\n".join(source.choice(pool) for _ in range(source.randrange(0, 12)))) for i in range(120)]
    made += [(i, "the very common line of them all\n" * 3 + str(i)) for i in range(200, 500)]
    return made + [(None, "the very common line of them all"), (None, None), (1000, None), (1001, ""), (5, made[5][1]), (6, "another text of six\nthe very common line of them all")]


def digests(rows):
    return sorted(((d, n, g, hashlib.sha256(t.encode()).hexdigest()) for d, n, g, t in rows), key=str)


def test_line_dedup(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(5)
    want = kept_by_force(rows)
    got = sorted(map(tuple, line_dedup.digest(docs).collect()), key=str)
    assert got == digests(want)
    applied = line_dedup.apply_bitmaps(docs, line_dedup.bitmaps(docs))
    assert applied.columns == docs.columns
    assert sorted(((r.doc_id, r.text or "") for r in applied.collect()), key=str) == sorted(((d, t) for d, _, _, t in want), key=str)


@pytest.mark.parametrize("batch", ["1", "7"])
def test_ranges_and_batches_do_not_matter(spark, rows, batch, monkeypatch):
    docs = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA)
    run = line_dedup.marked_lines

    def small_batches(*args):
        out = run(*args)
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
        return out

    monkeypatch.setattr(line_dedup, "marked_lines", small_batches)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert sorted(map(tuple, line_dedup.digest(docs).collect()), key=str) == digests(kept_by_force(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_line_dedup_of_nothing(spark):
    assert line_dedup.digest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bitmap_of_a_long_text():
    at = list(range(0, 100_000, 3))
    lines, before = line_dedup.kept_lines("\n".join(map(str, range(100_000))), line_dedup.pack_positions(pd.Series([at]))[0])
    assert before == 100_000 and lines == [str(i) for i in range(100_000) if i % 3]


PAGES = "page_id long, url string, html string, payload string, refers_to string"


def expected(rows):
    payloads = [(p, (h or "").encode()) for p, _, h in rows]
    first = {}
    for page, payload in payloads:
        if page is not None:
            first[payload] = max(page, first.get(payload, page))
    out = []
    for page, payload in payloads:
        to = first.get(payload)
        to = None if to == page else to
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    source = random.Random(4)
    rows = [(i, f"http://a.example/{i}", source.randbytes(3000).decode("latin-1")) for i in range(60)]
    rows += [(100 + i, "http://b.example/x y", "<html>same</html>") for i in range(40)]
    rows += [(200, None, None), (201, "u\r\nWARC-Type: x", ""), (None, "u", "<html>same</html>"), (None, None, "alone"), (203, "é", "x" * 200_000), (100, "again", "<html>same</html>")]
    return rows


@pytest.mark.parametrize("split", ["128m", "2k"])
def test_warc_round_trip(spark, pages, tmp_path, split):
    frame = spark.createDataFrame([(*r, "x", "y") for r in pages], PAGES).repartition(3)
    path = str(tmp_path / "archives")
    warc.write_archives(frame, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, path, payloads=False)
        fields = "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
        assert sorted(map(tuple, got.select(*fields).collect()), key=str) == expected(pages)
        full = warc.read_archives(spark, path).where("record_type = 'response'")
        sizes = sorted(n for _, n, _, kind, _ in expected(pages) if kind == "response")
        assert sorted(len(r.payload) for r in full.collect()) == sizes
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    # any gzip reader gets the records one after the other
    content = b"".join(gzip.decompress(p.read_bytes()) for p in Path(path).glob("part-*"))
    assert content.count(b"WARC/1.1\r\n") == len(pages)


def test_warc_of_nothing(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def stored_member(content):
    """A member that holds its content as it is, and so any gzip magic in it."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


@pytest.mark.parametrize("split", [None, 40, 90, 200, 333])
def test_false_magics_are_put_back(split):
    """Pieces of whole ranges, and of ranges that end inside a member whose content holds the magic."""
    inner = gzip.compress(b"WARC/1.1 no record") + b"\x1f\x8b\x08 no header" + b"\x1f\x8b\x08"
    records = [warc.record(i, "u", inner.hex().encode() + bytes([i]) * 50, None) for i in range(4)]
    raw = [warc.record(10 + i, "u", b"plain " * 5 + b"\x1f\x8b\x08\xff" + bytes(60), None) for i in range(4)]
    data = b"".join(stored_member(r) for r in [*records, *raw])
    parts = data.split(warc.MAGIC)
    ranges, at = defaultdict(list), 0
    for number, part in enumerate(parts):
        block = 0 if split is None or number == 0 else max(0, (at - 1) // split)
        ranges[block].append(part)
        at += len(part) + len(warc.MAGIC)
    found, loose = [], []
    for block in sorted(ranges):
        own = warc.Assembler()
        for part in ranges[block]:
            own.feed(part, at_start=block == 0)
        own.settle()
        found += own.records
        loose += [(block, turn, piece) for turn, piece in own.loose]
    ids = {warc.parsed(c)[0] for c in found}
    if loose:
        ids |= set(warc.joined_pieces(pd.DataFrame(loose, columns=["block", "turn", "piece"])).page_id)
    assert ids == {0, 1, 2, 3, 10, 11, 12, 13}


def archived(tmp_path, name, *members):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / name).write_bytes(b"".join(members))
    return str(tmp_path / "in")


def told(spark, path):
    return sorted(((r.page_id, r.record_type, r.error) for r in warc.read_archives(spark, path, payloads=False).collect()), key=str)


@pytest.fixture
def members():
    return [gzip.compress(warc.record(i, f"http://x/{i}", f"<html>{i}</html>".encode() * 50, None)) for i in range(5)]


WHOLE = [(i, "response", None) for i in range(5)]


@pytest.mark.parametrize("name", ["x.warc.gz", "x.warc", "x.GZ"])
def test_archives_by_any_name(spark, tmp_path, members, name):
    assert told(spark, archived(tmp_path, name, *members)) == WHOLE


@pytest.mark.parametrize("split", ["128m", "100"])
@pytest.mark.parametrize("name", ["x.warc.gz", "x.warc"])
def test_nothing_is_lost_without_a_word(spark, tmp_path, members, name, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        cut = archived(tmp_path, name, *members[:4], members[4][:-30])
        assert told(spark, cut) == [*WHOLE[:4], (4, "response", warc.CUT)]
        hurt = bytearray(members[2])
        hurt[-6] ^= 255  # its checksum
        assert told(spark, archived(tmp_path, name, *members[:2], bytes(hurt), *members[3:])) == sorted([*WHOLE[:2], (2, "response", warc.DAMAGED), *WHOLE[3:]], key=str)
        lost = b"\0" + members[2][1:]  # its magic
        found = told(spark, archived(tmp_path, name, *members[:2], lost, *members[3:]))
        assert found == sorted([*WHOLE[:2], (None, None, warc.STRAY), *WHOLE[3:]], key=str)
        assert told(spark, archived(tmp_path, name, b"junk", *members)) == sorted([*WHOLE, (None, None, warc.STRAY)], key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_other_digests_and_odd_lengths(spark, tmp_path):
    plain = warc.record(1, "u", b"abc", None)
    other = plain.replace(b"sha1:", b"sha256:")
    odd = warc.record(2, "u", b"abc", None).replace(b"\r\nContent-Length: 3\r\n", b"\r\nContent-Length: x\r\n")
    wrong = warc.record(3, "u", b"abc", None).replace(b"\r\n\r\nabc", b"\r\n\r\nabd")
    long = warc.record(4, "u", b"abc", None).replace(b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 9")
    path = archived(tmp_path, "a", *map(gzip.compress, (other, odd, wrong, long)))
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert got[1].payload_digest.startswith("sha256:") and got[1].error is None and got[1].payload == b"abc"
    assert got[2].payload_bytes == 3 and got[2].error is None
    assert "digest" in got[3].error and got[3].payload == b"abd"
    assert got[4].error == "record is shorter than its length"

"""Token ids in ORC: integer run-length encoding, row indexes, Bloom filters on document ids.

Texts are dealt into ranges of doc_id and encoded in that order, so that each
file holds one ascending range: its stripes' statistics are narrow and a lookup
by id skips files, stripes and row groups by metadata, and within them by the
Bloom filter. A row keeps its place within its file; the places of the files
come from their own sums when they are read, so no pass over the ids is needed
before they are written.

Null texts are empty and hold the end id alone. Rows with a null doc_id come
first; rows that share a doc_id stand beside each other in the order of their
texts. An empty table gives an empty folder of the same columns.
"""

from __future__ import annotations

import json
import re
import zlib
from itertools import compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillgrid.llm.bpe import SPACE, packed_ids
from tillgrid.llm.common import LONGEST, Batches, Remembered, batch_of, in_batches

JOINED = 500  # words encoded in one call
REMEMBERED = 500_000  # words that a worker remembers
# White space that the library knows beside ASCII's.
WIDE_SPACE = "[\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]"
# A word and its marks: letters whose lower case and normal form are plain, and the marks of ASCII.
PLAIN = rf"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]{{1,{LONGEST}}})(?P<marks>[!-/:-@\[-`{{-~]*)$"
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
COLUMNS = "doc_id long, segment int, local_start long, n_tokens long, ids array<int>"
NO_IDS = np.zeros(0, "<u4")


def listed(texts: pa.Array) -> list[str]:
    """Texts as Python strings; a list by way of NumPy takes a tenth of ``to_pylist``'s time."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def taken(flat: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of ``flat``, which has them one after the other, in the order chosen, and the edges of those taken."""
    starts, counts = (np.cumsum(lengths) - lengths)[chosen], lengths[chosen]
    edges = np.concatenate([[0], np.cumsum(counts)])
    return flat[np.repeat(starts - edges[:-1], counts) + np.arange(edges[-1])], edges


class Encoder:
    """The tokenizers library, asked once for each word that is remembered.

    Its vocabulary drops white space between words, so a text's ids are those
    of its runs of signs without white space. A run of letters with marks
    behind it is a word and its marks. Texts are parted as Arrow columns: the
    distinct runs of a batch, and of these the distinct words in lower case, are
    numbered, so Python sees each word once a batch. Unknown words are joined by
    blanks and encoded in one call; the token that ends a word tells their ids
    apart. Other runs, and texts with the mark of a special token, are encoded
    as they are.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(content)
        self.own.no_truncation()
        self.own.no_padding()
        model = json.loads(content)["model"]
        suffix = model["end_of_word_suffix"]
        self.ends = np.zeros(1 + max(model["vocab"].values()), bool)
        self.ends[[i for token, i in model["vocab"].items() if suffix and token.endswith(suffix)]] = True
        self.runs = re.compile(f"[^{SPACE}]+")
        self.words: dict[str, int] = {}  # the numbers of words among the units
        self.flat, self.sizes = NO_IDS, np.zeros(1, np.int64)  # ids of the units; unit 0 is empty
        self.others = Remembered(self.ids)  # marks, and runs that are no word with marks

    def ids(self, text: str) -> bytes:
        return packed_ids(self.own.encode(text, add_special_tokens=False).ids)

    def ask(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some words one after the other, and how many each has."""
        ids = np.array(self.own.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) == len(words):
            return ids, np.diff(cuts, prepend=0)
        each = [np.frombuffer(self.ids(w), "<u4") for w in words]  # the ends do not tell
        return np.concatenate(each), np.array([len(e) for e in each], np.int64)

    def of_words(self, words: list[str]) -> np.ndarray:
        """The numbers of distinct words in lower case among the units."""
        if not self.words or len(self.words) > REMEMBERED:
            self.words.clear()
            self.flat, self.sizes = NO_IDS, np.zeros(1, np.int64)
        found = list(map(self.words.get, words))
        absent = list(compress(range(len(words)), map(is_, found, repeat(None))))
        if absent:
            new = [words[i] for i in absent]
            told = [self.ask(new[at : at + JOINED]) for at in range(0, len(new), JOINED)]
            numbers = range(len(self.sizes), len(self.sizes) + len(new))
            self.words.update(zip(new, numbers))
            self.flat, self.sizes = (np.concatenate([have, *more]) for have, more in zip((self.flat, self.sizes), zip(*told)))
            for i, number in zip(absent, numbers):
                found[i] = number
        return np.array(found, np.int64)

    def of_runs(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and sizes of the units that runs are made of, and of each run its two units; the first unit is empty."""
        split = pc.extract_regex(runs, PLAIN)
        plain = split.is_valid().to_numpy(zero_copy_only=False)
        words = pc.utf8_lower(split.field(0).filter(pa.array(plain))).dictionary_encode()
        marks = split.field(1).filter(pa.array(plain)).dictionary_encode()
        first, second = np.zeros(len(runs), np.int64), np.zeros(len(runs), np.int64)
        first[plain] = self.of_words(listed(words.dictionary))[words.indices.to_numpy()]
        second[plain] = marks.indices.to_numpy() + len(self.sizes)
        first[~plain] = np.arange(len(runs) - plain.sum()) + len(self.sizes) + len(marks.dictionary)
        others = [self.others[text] for text in (*listed(marks.dictionary), *listed(runs.filter(pa.array(~plain))))]
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(others), "<u4")])
        return flat, np.concatenate([self.sizes, np.fromiter(map(len, others), np.int64, len(others)) // 4]), first, second

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has."""
        odd = pc.or_(pc.match_substring(texts, "<|"), pc.match_substring_regex(texts, WIDE_SPACE)).fill_null(False)
        parted = pc.ascii_split_whitespace(pc.if_else(odd, "", texts.fill_null("")))
        coded = parted.flatten().dictionary_encode()
        known, lengths, first, second = self.of_runs(coded.dictionary)
        of_each, cuts = taken(known, lengths, np.stack([first, second], axis=1).ravel())  # the ids of each distinct run
        flat, ends = taken(of_each, np.diff(cuts[::2]), coded.indices.to_numpy())
        edges = ends[np.concatenate([[0], np.cumsum(parted.value_lengths().to_numpy())])]
        sizes = np.diff(edges)
        rest = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(rest):  # texts with marks of special tokens or white space beyond ASCII
            parts = np.split(flat, edges[1:-1])
            for i in rest.tolist():
                text = texts[i].as_py()
                ids = self.ids(text) if "<|" in text else b"".join(map(self.others.__getitem__, self.runs.findall(text)))
                parts[i] = np.frombuffer(ids, "<u4")
                sizes[i] = len(parts[i])
            flat = np.concatenate(parts)
        return flat, sizes


_encoders: dict[int, Encoder] = {}


def encoder(content: str) -> Encoder:
    key = hash(content)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(content)
    return _encoders[key]


def write_ids(docs: DataFrame, content: str, path: str, end_id: int = 1, files: int | None = None) -> None:
    """Encode every text, append ``end_id`` and write ORC files in ascending doc_id order."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(content)
    count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    dealt = rows.repartitionByRange(count, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()
    )

    def run(batches: Batches) -> Batches:
        own, segment, start = encoder(shared.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            flat, sizes = own(batch.column(1))
            places = np.cumsum(sizes)
            flat, sizes = np.insert(flat.astype(np.int32), places, end_id), sizes + 1  # the end id behind each text
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), segment, np.int32)), pa.array(start + ends - sizes), pa.array(sizes), lists],
                names=["doc_id", "segment", "local_start", "n_tokens", "ids"],
            )
            start += int(ends[-1]) if len(ends) else 0

    writer = in_batches(dealt, run, COLUMNS).write
    for key, value in {
        "compression": "zstd", "orc.stripe.size": STRIPE_BYTES, "orc.row.index.stride": ROWS_PER_INDEX, "orc.create.index": "true",
        "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
    }.items():
        writer = writer.option(key, value)
    writer.orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids; stripes are read in parallel.

    The files' places are running sums over one row per file.
    """
    rows = spark.read.schema(COLUMNS).orc(path)
    sums = rows.groupBy("segment").agg(F.min("doc_id").alias("_least"), F.sum("n_tokens").alias("_sum"), F.count_if(F.col("doc_id").isNull()).alias("_null"))
    before = Window.orderBy((F.col("_null") > 0).desc(), F.col("_least").asc_nulls_first(), "segment").rowsBetween(Window.unboundedPreceding, -1)
    places = sums.select("segment", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(places), "segment").select("doc_id", (F.col("_before") + F.col("local_start")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some documents: the predicate is pushed to file and stripe statistics and to the Bloom filters."""
    return read_ids(spark, path).where(F.col("doc_id").isin(doc_ids))


CHECKED = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def checksums(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens (the ids read) and the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            lists = batch.column(3)
            ids, at = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4"), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield batch_of(CHECKED, [batch.column(0), batch.column(1), np.diff(at), sums])

    return in_batches(rows, run, "doc_id long, start long, n_tokens long, ids_crc32 long")

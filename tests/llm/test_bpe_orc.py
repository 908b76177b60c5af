"""BPE against the tokenizers library; ids in ORC against plain encoding."""

from __future__ import annotations

import random
import unicodedata
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillgrid.llm import bpe, token_orc

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, ids string, n_tokens string"  # two columns clash with the results' names
ODD = [
    None, "", " \n\t", "Hello World's don't", "ΑΣ Σίσυφος ΣΑΣ", "İstanbul é é", "a\x1cb \x85 　 x", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|> <|endoftext",
    "a" * 500, "ab" * 3000, "123 4five6", "日本語テキスト", "🏳️‍🌈 ok!!!...??", "x, y " * 5000,
]


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.no_truncation()
    own.no_padding()
    return own


@pytest.fixture(scope="module")
def texts():
    source = random.Random(5)
    kinds = [lambda: source.randrange(32, 127), lambda: source.randrange(0x600), lambda: source.randrange(0x1E00, 0x3100), lambda: 32]
    made = ["".join(c for c in (chr(source.choice(kinds)()) for _ in range(60)) if unicodedata.category(c) != "Cn") for _ in range(300)]
    return ODD + made


def test_ids_and_text_are_those_of_the_library(library, texts):
    own = bpe.Codec(bpe.read_vocabulary(PATH))
    for text in texts:
        want = library.encode(text or "", add_special_tokens=False).ids
        got = own.encode(text)
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert own.decode(got) == library.decode(want, skip_special_tokens=False)


def test_long_words_merge_like_short_ones(monkeypatch):
    own = bpe.Codec(bpe.read_vocabulary(PATH))
    words = ["thereinthemerging", "aaaaaaaaa", "zzxzzxzx", "internationalisation"]
    short = [own.merge(own.parts(w)) for w in words]
    monkeypatch.setattr(bpe, "SHORT", 0)
    assert [own.merge(own.parts(w)) for w in words] == short


def test_memory_of_words_is_bounded(monkeypatch):
    own = bpe.Codec(bpe.read_vocabulary(PATH))
    own.chunk_ids.bound = 10
    before = [own.encode(f"word{i} word{i % 7}") for i in range(100)]
    assert before == [own.encode(f"word{i} word{i % 7}") for i in range(100)]
    assert len(own.chunk_ids) <= 10 and len(own.chunk_ids.older) <= 10


def test_words_are_remembered_no_longer_than_the_task():
    content = bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    with bpe.codec(content) as own:
        assert own.encode("some words, some more") and own.chunk_ids and own.word_ids
    assert not own.chunk_ids and not own.word_ids
    with bpe.codec(content) as again:
        assert again is own


def test_round_trip(spark, library, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)] + [(None, "ab", "x", "y"), (3, texts[3], "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    content = bpe.read_vocabulary(PATH)
    got = sorted(map(tuple, bpe.round_trip(docs, content).collect()), key=str)
    want = []
    for doc, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(docs.limit(0), content).count() == 0
    ids = bpe.encoded(docs, content)
    assert ids.count() == bpe.decoded(ids, content).count() == len(rows)


def test_orc_round_trip_and_lookup(spark, library, texts, tmp_path):
    rows = [(7 * i % 400, t, "x", "y") for i, t in enumerate(texts)] + [(None, "null id", "x", "y"), (None, None, "x", "y"), (7, texts[1], "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    path = str(tmp_path / "ids")
    token_orc.write_ids(docs, bpe.read_vocabulary(PATH), path)
    got = [tuple(r) for r in token_orc.checksums(token_orc.read_ids(spark, path)).collect()]
    start, want = 0, []
    for doc, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    found = token_orc.lookup(spark, path, [14])
    assert [r.n_tokens for r in found.collect()] == [w[2] for w in want if w[0] == 14]
    assert "PushedFilters: [In(doc_id, [14])]" in found._jdf.queryExecution().toString() or "EqualTo(doc_id,14)" in found._jdf.queryExecution().toString()


def test_orc_of_an_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    token_orc.write_ids(docs, bpe.read_vocabulary(PATH), str(tmp_path / "none"))
    assert token_orc.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_files_hold_ascending_ranges(spark, tmp_path):
    docs = spark.range(500).select((F.col("id") * 37 % 500).alias("doc_id"), F.lit("some words").alias("text"))
    path = str(tmp_path / "ranges")
    token_orc.write_ids(docs, bpe.read_vocabulary(PATH), path, files=4)
    ranges = sorted(spark.read.orc(path).groupBy(F.input_file_name()).agg(F.min("doc_id"), F.max("doc_id")).select("min(doc_id)", "max(doc_id)").collect())
    assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_columnar_encoder_equals_the_library():
    """Words with marks, other runs, white space beyond ASCII, special tokens, words that are forgotten."""
    import random

    import pyarrow as pa

    from tillgrid.llm import token_orc
    from tillgrid.llm.queries import vocabulary

    source = random.Random(11)
    words = ["The", "house", "ÉTÉ", "über", "Œuvre", "ẞ", "it's", "'Tis", "don't,", "x" * 70, "a1b2", "3.14", "été", "Σίσυφος", "漢字", "ﬁn", "--", '"quoted"', "İ", "a'", "''s", "ÿÀ*#"]
    blanks = [" ", "  ", "\n", "\t", "\r\n", "\x0b", " ", " ", "\x1c", "\x85", "　"]
    texts = [
        "".join(source.choice(words) + source.choice(blanks[:6] if i % 3 else blanks) for _ in range(source.randrange(0, 30))) for i in range(400)
    ] + [None, "", " ", "<|endoftext|> a", "a<|b", "A <|startoftext|> b", *words, *["".join(source.choice("abcdé") for _ in range(9)) + "." for _ in range(3000)]]
    encoder = token_orc.Encoder(vocabulary())
    want = [encoder.own.encode(t or "", add_special_tokens=False).ids for t in texts]
    forgetful = token_orc.Encoder(vocabulary())
    column = pa.array(["skipped", *texts])[1:]
    for own, step in ((encoder, 5000), (forgetful, 37)):
        got = []
        for at in range(0, len(texts), step):
            flat, sizes = own(column[at : at + step])
            assert sizes.sum() == len(flat)
            cuts = [0, *sizes.cumsum().tolist()]
            got += [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])]
            forgetful.words.clear()
        assert got == want
    flat, sizes = encoder(pa.array([], pa.string()))
    assert len(flat) == len(sizes) == 0


def test_words_are_remembered_as_numbers_within_a_bound(monkeypatch, library):
    """The memory holds ids as arrays, one entry a word, and starts anew above its bound."""
    import pyarrow as pa

    monkeypatch.setattr(token_orc, "REMEMBERED", 20)
    monkeypatch.setattr(token_orc, "JOINED", 3)
    encoder = token_orc.Encoder(bpe.read_vocabulary(PATH))
    for i in range(30):
        texts = [f"Word{chr(97 + i % 26)} again, ß {chr(97 + i % 26) * j}!? x{j}" for j in range(5)]
        flat, sizes = encoder(pa.array(texts))
        want = [library.encode(t, add_special_tokens=False).ids for t in texts]
        assert flat.tolist() == sum(want, []) and sizes.tolist() == list(map(len, want))
        assert len(encoder.sizes) == len(encoder.words) + 1 <= 31 and encoder.sizes.sum() == len(encoder.flat)
        some = next(w for w in encoder.words if len(w) > 1)
        at = encoder.sizes[: encoder.words[some]].sum()
        assert encoder.flat[at : at + encoder.sizes[encoder.words[some]]].tolist() == library.encode(some, add_special_tokens=False).ids

"""Periodic runs, Merkle manifest and sharding against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillgrid.llm import manifest, queries, runs, shards

SF_DIR = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def all_docs(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


# ---- periodic runs ---------------------------------------------------------------------------


def every_run(words) -> list[tuple[int, int, int]]:
    """All lags, all places."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


@settings(max_examples=150, deadline=None)
@given(st.randoms(use_true_random=False), st.integers(0, 250), st.sampled_from([1, 2, 3, 6, 40]))
def test_runs_equal_brute_force(rnd, n, vocabulary):
    words = [rnd.randrange(vocabulary) for _ in range(n)]
    for _ in range(rnd.randrange(5) if n > 24 else 0):
        at, period = rnd.randrange(n), rnd.randint(1, 40)
        for i in range(at + period, min(n, at + rnd.randint(1, 200))):
            words[i] = words[i - period]
    assert runs.runs_of(np.array(words, np.int64)) == every_run(words)


def test_many_runs_and_long_texts():
    blocks = np.repeat(np.arange(3000) % 7, 30)
    found = runs.runs_of(blocks)
    assert sum(q == 1 for _, _, q in found) == 3000 and (0, 90_000, 210) in found
    assert runs.runs_of(np.zeros(300_000, np.int64)) == [(0, 300_000, 1)]
    one_by_one = np.concatenate([np.arange(20_000)] * 2 + [np.arange(20_000)[::-1]])
    assert runs.runs_of(one_by_one) == []


def digests(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = every_run(words) if n < 3000 else runs.runs_of(runs.numbers_of(words))
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(found), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_op11_equals_brute_force(spark):
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    docs = all_docs(spark)
    assert len(got) == len(docs) and any(r[1] for r in got.values())
    for doc_id, text, *_ in docs:
        if len((text or "").split()) < 1500:
            assert got[doc_id] == digests(doc_id, text)


def test_runs_of_odd_rows(spark):
    again = "a b c d " * 12
    entries = [(1, None), (2, ""), (3, " \n "), (None, again), (None, again), (5, "x " * 23), (5, "x " * 24), (6, "é x y " * 30)]
    df = spark.createDataFrame(entries, "doc_id long, text string").withColumns({"n_runs": F.lit("extra"), "words": F.lit(1)})
    got = sorted(map(tuple, runs.all_runs(df).collect()), key=str)
    assert got == [(5, 0, 24, 1), (6, 0, 60, 2), (None, 0, 48, 4), (None, 0, 48, 4)]
    texts = Counter((r.doc_id, r.text) for r in runs.collapse(df).collect())
    assert texts == Counter({(1, None): 1, (2, ""): 1, (3, " \n "): 1, (None, "a b c d"): 2, (5, "x " * 23): 1, (5, "x"): 1, (6, "é x y"): 1})
    empty = runs.periodic_runs(df.where("doc_id = 1"), runs.changed_words).first()
    assert empty.n_runs == 0 and empty.start is None and empty.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert runs.periodic_runs(df.limit(0)).count() == 0


# ---- Merkle manifest -------------------------------------------------------------------------


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    doc_id, text, lang, source, n_chars = row
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The root, and per leaf its siblings' texts level by level."""
    ways: list[list[tuple[str, str]]] = [[] for _ in nodes]
    at, level = list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, place in enumerate(at):
            run = place - place % 8
            ways[i].append(("".join(level[run:place]), "".join(level[place + 1 : run + 8])))
        level = [h(*level[i : i + 8]) for i in range(0, len(level), 8)]
        at = [place // 8 for place in at]
    return level[0], ways


def whole_manifest(docs: list[tuple]) -> list[tuple]:
    languages = defaultdict(list)
    for row in docs:
        languages[row[2]].append(row)
    names = sorted(languages, key=lambda name: (name is not None, (name or "").encode()))
    kept = {}
    for name in names:
        rows = sorted(languages[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        kept[name] = rows, *tree([leaf(r) for r in rows])
    root, upper = tree([kept[name][1] for name in names])
    out = []
    for name, above in zip(names, upper):
        rows, subroot, ways = kept[name]
        for row, way in zip(rows, ways):
            path = way + above
            proof = h(*(part for pair in path for part in pair))
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[1] is not None
            fold = leaf((row[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[1]), *row[2:])) if changed else leaf(row)
            for a, b in path:
                fold = h(a, fold, b)
            out.append((row[0], leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=str)


def checked(df) -> list[tuple]:
    return sorted(map(tuple, manifest.checked(manifest.build(df, manifest.tampered_leaf())).collect()), key=str)


def test_op12_equals_brute_force(spark):
    got = sorted(map(tuple, queries.QUERIES["op12_merkle_manifest"](spark, SF_DIR).collect()), key=str)
    assert got == whole_manifest(all_docs(spark))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [8, 1], [9, 512, 513], [4100, 1, 0, 64, 65]])
def test_manifest_of_many_shapes(spark, sizes):
    docs = [(i * 7, f"Text {i}", None if k == 1 else f"l{k}", "s", i) for k, n in enumerate(sizes) for i in range(n)]
    assert checked(spark.createDataFrame(docs, DOC)) == whole_manifest(docs)


def test_manifest_of_odd_rows_and_of_many_languages(spark):
    docs = [(None, None, None, None, None)] * 3 + [(1, "", "", "", 0)] * 20 + [(1, "é\n" * 5, "ü", None, 2), (2, "A", "", "x", 1)]
    docs += [(i, "B", f"lang {i % 700}", "x", 1) for i in range(1500)]
    df = spark.createDataFrame(docs, DOC).withColumns({"key": F.lit(1), "node": F.lit("x"), "pos": F.lit(2), "total": F.lit(3)})
    assert checked(df) == whole_manifest(docs)
    assert checked(df.limit(0)) == []


def test_proofs_of_some_documents(spark):
    docs = [(i, f"t {i}", f"l{i % 2}", "s", i) for i in range(1300)]
    kept = manifest.build(spark.createDataFrame(docs, DOC))
    assert len(kept.levels) == 3 and kept.levels[1].count() == 4  # two trees of 650 leaves: two nodes stored for each, then the tops
    some = manifest.proofs(kept, spark.createDataFrame([(5,), (5,), (700,), (99_999,)], "doc_id long")).collect()
    assert sorted(r.doc_id for r in some) == [5, 700]
    for r in some:
        assert manifest.folded(r.leaf, r.before, r.after) == r.root and manifest.folded(h("x").encode(), r.before, r.after) != r.root
    assert manifest.proofs(kept).count() == 1300


# ---- sharding --------------------------------------------------------------------------------


def check_shards(docs, got, count):
    """The contract of a sharding by bytes; returns the shards' loads."""
    assert Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in docs) == Counter(
        (r.doc_id, r.size, r.text_crc32) for r in got
    )
    loads, slots, of_text = Counter({k: 0 for k in range(count)}), defaultdict(list), defaultdict(set)
    for r in got:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.law == "bytes" and r.grown_shard is None
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    text_of = {d: t or "" for d, t, *_ in docs}
    for r in got:
        of_text[text_of[r.doc_id]].add(r.shard)
    assert all(len(found) == 1 for found in of_text.values())
    return loads


def test_op13_equals_heap_over_all_groups(spark):
    docs = all_docs(spark)
    got = queries.QUERIES["op13_sharding"](spark, SF_DIR).collect()
    loads = check_shards(docs, got, 24)
    groups = Counter()
    for _, text, *_ in docs:
        groups[text or ""] += len((text or "").encode()) + 8
    whole = Counter(dict.fromkeys(range(24), 0))
    for text, shard in shards.longest_first([(n, (t,)) for t, n in groups.items()], 24).items():
        whole[shard] += groups[text[0]]
    # At most the size of the largest bundle behind scheduling every group on its own.
    assert max(loads.values()) <= max(whole.values()) + sum(loads.values()) / (24 * shards.PIECES) * 4


def test_small_groups_are_bundled(spark):
    docs = [(i, f"text {i} " * (i % 5 + 1)) for i in range(6000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = shards.assign(df, shards=4, pieces=64).collect()
    loads = check_shards(docs, got, 4)
    assert max(loads.values()) - min(loads.values()) < sum(loads.values()) / 4 / 16


def test_shards_of_hot_groups_nulls_and_repeated_rows(spark):
    docs = [(i, "hot " * 50) for i in range(1000)] + [(None, None), (None, ""), (7000, None)] + [(5000 + i, f"u{i} " * 40) for i in range(1500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"size": F.lit("x"), "shard": F.lit(9), "h1": F.lit(0)})
    got = shards.assign(df, shards=3).collect()
    loads = check_shards([d for d in docs if d[0] is not None] + [(None, ""), (None, "")], got, 3)
    assert loads[0] == 208_000 and abs(loads[1] - loads[2]) < 2000  # the hot group alone; the others even
    twice = shards.assign(df.unionByName(df), shards=3)
    assert twice.count() == 2 * len(docs) and twice.select("shard", "slot").distinct().count() == 2 * len(docs)
    assert shards.assign(df.limit(0)).count() == 0
    same = shards.assign(df, shards=3).collect()
    assert Counter(same) == Counter(got)


def test_written_shards_keep_all_columns(spark, tmp_path):
    rnd = random.Random(3)
    docs = [(i, f"w{rnd.randrange(40)} " * rnd.randrange(1, 90), "x") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, h1 string")
    shards.write_shards(df, str(tmp_path / "out"), shards=5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter(map(tuple, back.select(*df.columns).collect())) == Counter(docs)
    assert back.groupBy("text").agg(F.count_distinct("_shard").alias("n")).where("n > 1").count() == 0

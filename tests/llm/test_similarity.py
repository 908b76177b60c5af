"""Jaccard join, fingerprints and top-k against brute force."""

from __future__ import annotations

import random
import time
from fractions import Fraction
from hashlib import sha256
from math import floor

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillgrid.llm import jaccard, minhash, topk
from tillgrid.llm.common import Shingles
from tillgrid.llm.components import components

SCHEMA = "doc_id long, text string, n long, comp string, token string"  # names that the operators use themselves


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components_by_force(rows):
    sets = [(d, shingles(t)) for d, t in rows if d is not None]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                one, other = root(a), root(b)
                parent[max(one, other)] = min(one, other)
    return sorted(((d, len(shingles(t)), None if d is None else root(d)) for d, t in rows), key=str)


@pytest.fixture(scope="module")
def rows():
    source = random.Random(9)
    word = lambda: "".join(source.choice("abcdefg") for _ in range(source.randrange(2, 6)))
    text = lambda n: [word() for _ in range(n)]
    made, passage = [], text(60)
    for family in range(12):
        base = text(source.randrange(30, 200))
        for _ in range(source.randrange(1, 12)):
            copy = list(base)
            for _ in range(source.randrange(0, 6)):
                copy[source.randrange(len(copy))] = word()
            made.append(" ".join(copy))
    base = text(120)
    for _ in range(150):  # a family larger than a group
        copy = list(base)
        for at in source.sample(range(120), 2):
            copy[at] = word()
        made.append(" ".join(copy))
    made += ["\n".join([*passage, *text(source.randrange(40, 90))]) for _ in range(60)]
    made += [" ".join(base)] * 40 + ["a b c", "A\tB  c", "a b c d", "one", "", " \n", None, None, "exact copy " * 9]
    source.shuffle(made)
    return [(i * 3, t) for i, t in enumerate(made)] + [(None, made[0]), (None, None), (3, made[1]), (6, made[5])]


@pytest.mark.parametrize("group,common", [(64, 1 << 16), (4, 8)])
def test_components_are_those_of_all_pairs(spark, rows, group, common, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", group)
    monkeypatch.setattr(jaccard, "COMMON_TOKENS", common)
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], SCHEMA).repartition(4)
    got = sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=str)
    assert got == components_by_force(rows)


def test_the_matrix_alone_finds_every_link(spark, rows, monkeypatch):
    """Without any group that similar documents share, links come from meetings in the matrix."""
    monkeypatch.setattr(jaccard, "GROUP", 1)
    some = rows[:120]
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in some], SCHEMA)
    assert sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=str) == components_by_force(some)


def test_a_query_links_to_a_member_between_the_sizes_met(spark, monkeypatch):
    """q links to m alone; for sizes 23, 24, 25 of the group's members the bound is 3, 2, 3, and q meets them in 2 tokens."""
    passage = [f"p{i}" for i in range(25)]
    q, a, m, b = ["q1", "q2", *passage], ["o2", "o3", "o4", *passage[:-1]], ["o2", "o3", "o4", *passage], ["o1", "o2", "o3", "o4", *passage]
    fillers = [[*passage, *(f"f{i}-{k}" for k in range(60))] for i in range(20)]  # the passage is common
    fillers += [[*passage[-5:], *(f"e{i}-{k}" for k in range(60))] for i in range(5)]  # what a lacks is the most common
    made = [(i, " ".join(words)) for i, words in enumerate([q, a, m, b, *fillers])]
    assert similarity(shingles(made[0][1]), shingles(made[2][1])) >= 0.8 > max(similarity(shingles(made[0][1]), shingles(made[k][1])) for k in (1, 3))
    monkeypatch.setattr(jaccard, "groups", lambda rows: spark.createDataFrame([(0, -7, d) for d in (1, 2, 3)], "seed int, gid long, doc long"))
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in made], SCHEMA)
    assert sorted(map(tuple, jaccard.jaccard_components(docs).collect()), key=str) == components_by_force(made)


def test_bound_of_a_group_is_the_lowest_of_its_sizes(spark):
    """For every query up to 120 and every range of member sizes that can link, one meeting less than the lowest bound is too few."""
    def bound(n, m):
        return max(1, -(-(n + m) * 80 // 180) - max(-(-n * 80 // 100), -(-m * 80 // 100)) + 1)

    made = []
    for n in range(1, 121):
        fit = [m for m in range(1, 151) if 100 * min(n, m) >= 80 * max(n, m)]
        for i, least in enumerate(fit):
            lowest = bound(n, least)
            for most in fit[i:]:
                lowest = min(lowest, bound(n, most))
                made += [(len(made) + k, n, n, lowest - 1 + k, least, most) for k in (0, 1)]
    met = spark.createDataFrame(made, "doc long, gid long, n long, shared long, least long, most long")
    assert sorted(r.doc for r in jaccard.qualified(met).collect()) == [row[0] for row in made if row[0] % 2]


def test_representatives(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], SCHEMA)
    stay = {c for d, _, c in components_by_force(rows)}
    got = jaccard.representatives(docs)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted(str(d) for d, _ in rows if d is None or d in stay)


def test_join_of_nothing(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = components(spark.createDataFrame([*chain, *star, (5, 5)], "a long, b long")).collect()
    assert {(r.doc, r.component) for r in got} == {(i, 0) for i in range(61)} | {(1000 + i, 1000) for i in range(200)}


def test_components_that_still_change_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("tillgrid.llm.components.ROUNDS", 1)
    with pytest.raises(RuntimeError, match="still changed"):
        components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"))


def test_slices_of_long_texts_do_not_matter(monkeypatch):
    source = random.Random(2)
    texts = ["".join(source.choice(["a", "B", " ", "\n", "é", "\x0b", "\x1c", "xyz"]) for _ in range(300)).encode() for _ in range(50)]
    whole = [Shingles()(t).tolist() for t in texts]
    monkeypatch.setattr(Shingles, "SLICE", 17)
    assert [Shingles()(t).tolist() for t in texts] == whole
    assert all(len(w) == max(0, len(t.split()) - 4) or len(t.split()) < 5 for w, t in zip(whole, texts))


def test_fingerprints_and_edits(spark, rows):
    unique = {d: t for d, t in rows if d is not None}
    source = random.Random(1)
    unique[10_000] = " ".join(str(source.randrange(10**6)) for _ in range(30_000))
    docs = spark.createDataFrame([(d, t, 1, "x", "y") for d, t in unique.items()], SCHEMA).repartition(5)
    got = {r.doc_id: r for r in minhash.compared(docs).collect()}
    order = sorted(unique)
    assert sorted(got) == order
    errors, marks = [], {}
    for d, follower in zip(order, [*order[1:], order[0]]):
        text, after = unique[d] or "", unique[follower] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[d]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert marks.setdefault(text, row.fingerprint) == row.fingerprint
        errors += [row.near_edited - similarity(shingles(text), shingles(edited)), row.near_next - similarity(shingles(text), shingles(after))]
    assert np.abs(errors).max() < 0.12 and abs(np.mean(errors)) < 0.01


def test_fingerprints_of_few_rows(spark):
    frame = lambda *rows: spark.createDataFrame([(d, t, 1, "x", "y") for d, t in rows], SCHEMA)
    assert minhash.compared(frame()).count() == 0
    one = minhash.compared(frame((None, None))).first()
    assert (one.doc_id, one.n_chars, one.fingerprint, one.near_edited, one.near_next) == (None, 0, "", 1.0, 1.0)
    twice = minhash.compared(frame((1, "a b c d e f"), (1, "a b c d e f"), (None, "x"), (2, ""))).collect()
    assert sorted(str(r.doc_id) for r in twice) == ["1", "1", "2", "None"]
    marks = {r.fingerprint for r in minhash.fingerprints(frame((1, "a B c d e f"), (2, "A b\tc d e f"))).collect()}
    assert len(marks) == 1


VECTORS = "vec_id long, embedding array<double>, label int, block string, score string"


def best_by_force(rows, k=5, every=50):
    usable = [(i, np.floor(256 * np.array(v))) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for own, q in usable:
        if own % every == 0:
            found = sorted((-int(q @ c), i) for i, c in usable if i != own and len(c) == len(q))[:k]
            out += [(own, rank, i, -score) for rank, (score, i) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 37])
def test_top_k(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", block)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    source = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(source.normal(size=(400, 6)))]
    rows += [(500 + i, [0.5, -0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(700, [0.0] * 6), (750, [1.0, None] * 3), (751, None), (800, [float("nan")] * 6)]
    rows += [(850, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), (900, [1.0, 2.0]), (901, [2.0, 2.0]), (950, [])]
    frame = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS)
    got = topk.top_k(frame, frame.where(F.col("vec_id") % 50 == 0))
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect())) == best_by_force(rows)


def test_lists_are_not_read_to_their_ends():
    source = np.random.default_rng(1)
    vectors = (source.normal(size=(4000, 3)) * 256).astype(np.int64)
    block = topk.Block(np.arange(4000), vectors)
    query, scored = vectors[7], []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray) and at.dtype.kind == "i":
                scored.append(at.size)
            return np.asarray(super().__getitem__(at))

    block.vectors = block.vectors.view(Counted)
    found = block.best(7, query, 5)
    want = sorted((-int(query @ v), i) for i, v in enumerate(vectors) if i != 7)[:5]
    assert found == [(i, -s) for s, i in want]
    assert sum(scored) < 2000


def test_top_k_of_nothing_and_of_large_numbers(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk.top_k(none, none).count() == 0
    given = {
        0: [1.0, 1.0], 1: [1e7, 0.5], 2: [2e7, -0.25], 3: [1e300, 1.0], 4: [-1e300, 3.0], 5: [1e5, 1e5], 6: [1.7e308, 1.7e308], 7: [2.0**45, 0.0],
        50: [1e7, 1e-3], 100: [-1e300, 1.0],
    }
    large = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in given.items()], VECTORS)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(large, large.where("vec_id % 50 = 0")).collect())
    whole = {i: [floor(256 * Fraction(c)) for c in v] for i, v in given.items()}
    want = []
    for q in (0, 50, 100):
        scores = [(min(max(sum(a * b for a, b in zip(whole[q], whole[i])), -(2**63)), 2**63 - 1), i) for i in given if i != q]
        want += [(q, k, i, s) for k, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:5], 1)]
    assert got == want
    few = large.where("vec_id in (0, 1, 2)")
    assert [r.score for r in topk.top_k(few, few.where("vec_id = 0")).orderBy("rank").collect()] == [1_310_720_000_000 - 16384, 655_360_000_000 + 32768]


def test_many_rows_of_one_id_are_spread(spark):
    rows = [(7, [1.0, float(i % 3)]) for i in range(200)] + [(7, [2.0, 2.0])] * 200 + [(1000 + i, [float(i % 5), 1.0]) for i in range(400)] + [(50, [1.0, 1.0])]
    frame = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], VECTORS).repartition(4)
    spread = topk.whole_vectors(frame).withColumn("row", F.monotonically_increasing_id())
    sizes = spread.groupBy(F.pmod(F.xxhash64("vec_id", "v", "row"), F.lit(16))).count().toPandas()["count"]
    assert len(sizes) == 16 and sizes.max() < 100
    got = [(r["rank"], r.vec_id, r.score) for r in topk.top_k(frame, frame.where("vec_id = 50")).orderBy("rank").collect()]
    assert got[0] == (1, 1004, 5 * 65536) and [g[2] for g in got] == [5 * 65536] * 5


def block_of(rows):
    token, *columns = np.array(rows, np.int64).T
    return pa.table({"cells": pa.array([np.stack([token, *columns]).tobytes()], pa.binary())})


def met(block):
    return sorted(zip(*(c.to_pylist() for c in jaccard.meetings(block).columns)))


@pytest.mark.parametrize("seed", range(6))
def test_long_runs_give_the_meetings_of_short_ones(monkeypatch, seed):
    """Rows (token, doc, gid, comp, size of the component, n) of few tokens, with components from one to most rows."""
    source = random.Random(seed)
    comps = {c: source.choice([1, 1, 2, 3, 40]) for c in range(25)}
    rows, doc = [], 0
    for comp, size in comps.items():
        for _ in range(size):
            doc += 1
            gid, n = source.choice([comp * 100, comp * 100 + 1, doc + 10_000]), source.randint(20, 40)
            rows += [(token, doc, gid, comp, size, n) for token in source.sample(range(4), 3)]
    source.shuffle(rows)
    want = met(block_of(rows))
    assert want
    monkeypatch.setattr(jaccard, "LONG_RUN", 1)
    assert met(block_of(rows)) == want
    monkeypatch.setattr(jaccard, "PAIRS_AT_ONCE", 50)
    assert met(block_of(rows)) == want


def test_a_family_with_most_rows_of_a_token_costs_nothing_by_itself():
    rows = [(1, i, i // 50, 0, 200_000, 100 + i % 7) for i in range(200_000)] + [(1, 10**6 + i, 10**6 + i, 10 + i, 1, 100) for i in range(20)]
    begin = time.process_time()
    found = met(block_of(rows))
    assert time.process_time() - begin < 10
    assert len(found) == 20 * 4000 + 20 * 19 // 2 and (10**6, 0, 100, 1, 100, 106) in found

"""Mixing, license scans and language ID: exact targets, brute-force places, held-out accuracy; the pipeline."""

from __future__ import annotations

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillgrid.llm import language, licenses, mixing

SCHEMA = "doc_id long, text string, source string, size string, row string, sid string, copies int"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, s, "x", "y", "z", 1) for d, t, s in rows], SCHEMA)


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets_by_force(rows, weights=(5, 2, 1), cap=3):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        open_ones = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_ones) for s in open_ones}
        above = {s for s in open_ones if share[s] > cap * sizes[s]}
        if not above:
            return {s: (sizes[s], share.get(s, cap * sizes[s])) for s in order}
        full |= above


@pytest.fixture(scope="module")
def mixture():
    source = random.Random(6)
    rows, names = [], ["a", "B", "ß", "tiny", "z", None]
    for i in range(900):
        rows.append((i, " ".join(["w"] * source.choice([1, 3, 50, 400])), source.choice([*names[:3], names[4], "z", "z"])))
    rows += [(1000, "one two", "tiny"), (1001, "x", None), (1002, None, "a"), (1003, " \n", "void"), (None, "no id here", "a"), (5, rows[5][1], rows[5][2])]
    return rows


def test_mix_meets_its_targets(spark, mixture):
    docs = frame(spark, mixture).repartition(5)
    got = mixing.report(docs).collect()
    want = targets_by_force(mixture)
    assert len(got) == len(mixture)
    by_id = {d: (t, s) for d, t, s in mixture}
    taken = {}
    for row in got:
        text, source = by_id[row.doc_id]
        assert (row.size, row.source_size) == (size_of(text), want[source][0])
        assert row.target == pytest.approx(want[source][1])
        assert 0 <= row.taken <= 3 * row.size
        taken[source] = taken.get(source, 0) + row.taken
    for source, (size, target) in want.items():
        assert abs(taken[source] - target) <= max(2, 0.01 * size), source
    key = lambda rows: sorted((str(r.doc_id), r.taken) for r in rows)
    assert key(got) == key(mixing.report(docs.repartition(2)).collect())
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    total = out.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert total == sum(taken.values())


def test_rates_are_tilted_by_size(spark, mixture):
    rows = mixing.report(frame(spark, mixture)).where("size > 0 and source_size > 1000").collect()
    by_target = {}
    for row in rows:
        by_target.setdefault(row.target, {})[row.size] = row.rate
    for target, rates in by_target.items():
        ordered = [rates[s] for s in sorted(rates)]
        assert ordered in (sorted(ordered), sorted(ordered, reverse=True)) and max(ordered) <= 3


def test_sizes_far_apart_meet_their_targets(spark):
    """Targets near the cap need steep rates for the smallest; the bracket holds them."""
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a")] * 300 + [(200_000, "a")] + [(7, "b")] * 9000 + [(40_000, "c")] * 20)]
    got = mixing.report(frame(spark, rows)).collect()
    want, taken = targets_by_force(rows), {}
    for row in got:
        taken[rows[row.doc_id][2]] = taken.get(rows[row.doc_id][2], 0) + row.rate * row.size
    for source, (_, target) in want.items():
        assert taken[source] == pytest.approx(target, rel=1e-6), source


def test_more_sources_than_are_broadcast(spark, monkeypatch):
    """A source a row: their table is joined by shuffle, and none is lost."""
    monkeypatch.setattr(mixing, "MOST_SOURCES", 50)
    count = 600
    docs = spark.range(count).selectExpr(
        "id doc_id", "repeat('w ', cast(1 + id % 7 as int)) text", "cast(id as string) source", "'x' size", "'y' row", "'z' sid", "1 copies"
    )
    got = {r.doc_id: r for r in mixing.report(docs).collect()}
    want = targets_by_force([(i, "w " * (1 + i % 7), str(i)) for i in range(count)])
    assert len(got) == count
    for i, row in got.items():
        assert (row.source_size, pytest.approx(row.target)) == want[str(i)] and row.rate * row.size == pytest.approx(row.target, rel=1e-6)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, None, "b")], [(1, "one", "a")]])
def test_small_mixes(spark, rows):
    got = mixing.report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all(r.taken <= 3 * r.size for r in got)


def places_by_force(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    found = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


TEXTS = [
    None, "", "no licence at all", "CC-BY cc by, cc   by!", "GNU General Public License; ALL RIGHTS RESERVED.", "accby cc byé c cby", "cc\x00by cc by2 cc_by",
    "all rights all rights reserved reserved", "Licensed under the Apache License, Version 2.0 (the \"License\")", "cc by " * 2000,
    "SPDX-License-Identifier: GPL-3.0-or-later", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
]


def test_scans_find_every_base_place(spark):
    source = random.Random(7)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "é", ",", "CC BY"]
    texts = TEXTS + [" ".join(source.choice(parts) for _ in range(30)) for _ in range(200)]
    docs = frame(spark, [*enumerate_rows(texts), (None, "cc by", "a")])
    for row in licenses.scan_licenses(docs).collect():
        text = "cc by" if row.doc_id is None else texts[row.doc_id]
        assert tuple(row)[1:6] == places_by_force(text), text
        assert set(filter(None, row.base_labels.split(","))) <= set(row.labels.split(","))
        assert row.labels == ",".join(sorted(set(filter(None, row.labels.split(","))))) and 0 <= row.score <= 1
        assert (row.score > 0) == bool(row.labels)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def enumerate_rows(texts):
    return [(i, t, "s") for i, t in enumerate(texts)]


def example(parsed, source):
    """A text that a parsed pattern matches, its branches and repeats chosen at random."""
    out = ""
    for kind, value in parsed:
        match str(kind):
            case "LITERAL":
                out += chr(value)
            case "IN":
                kind, value = source.choice(value)
                out += chr(value) if str(kind) == "LITERAL" else "7" if str(value) == "CATEGORY_DIGIT" else "word"
            case "BRANCH":
                out += example(source.choice(value[1]), source)
            case "SUBPATTERN":
                out += example(value[-1], source)
            case "MAX_REPEAT":
                low, high, inner = value
                out += "".join(example(inner, source) for _ in range(source.randint(low, min(high, low + 2))))
            case other:
                raise ValueError(other)
    return out


def examples(rule, n=40):
    parsed, source = re._parser.parse(rule.pattern), random.Random(rule.pattern)
    return sorted({example(parsed, source).strip() for _ in range(n)})


def test_rules_are_many_and_each_match_holds_a_keyword():
    ordered = licenses.rules()
    assert len(licenses.NOTICES) > 150 and len(ordered) > 400
    for rule in ordered:
        for text in examples(rule):
            assert re.fullmatch(rule.pattern, text), (rule, text)
            assert set(rule.keywords) & set(text.split()), (rule, text)


def test_keywords_lose_no_match():
    """Detections of gated rules against those of all rules tried on every text."""
    ordered, source = licenses.rules(), random.Random(8)
    scanner, plain = licenses.Scanner(ordered), [re.compile(rf"(?<![^ ])(?:{r.pattern})(?![^ ])") for r in ordered]
    phrases = [t for rule in ordered for t in examples(rule, 6)]
    for _ in range(400):
        text = " ".join(source.choice([source.choice(phrases), "some other words", "license", "bsd"]) for _ in range(4))
        hits = [(at, *m.span()) for at, pattern in enumerate(plain) for m in pattern.finditer(text)]
        base = {label for phrase, label in licenses.BASE if f" {phrase} " in f" {text} "}
        want = base | {ordered[rule].label for rule, _, _ in licenses.suppressed(hits)}
        assert scanner.scan(text)[5] == ",".join(sorted(want)), text


NAMED = [
    ("Released under the FreeBSD", "bsd-2-clause"),
    ("distributed under the New BSD License.", "bsd-3-clause"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd-2-clause"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License", "gpl"),
    ("You should have received a copy of the GNU Affero General Public License", "agpl"),
    ("Altered source versions must be plainly marked as such", "zlib"),
    ("The Software shall be used for Good, not Evil.", "json"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-nc"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("If we meet some day, and you think this stuff is worth it, you can buy me a beer", "beerware"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("the quick brown fox has no licence", ""),
]


@pytest.mark.parametrize(("text", "label"), NAMED)
def test_labels_of_known_notices(text, label):
    got = set(licenses.Scanner(licenses.rules()).scan(text)[5].split(","))
    assert label in got and len(got - {"gpl", "public-domain"} | {label}) == 1


def test_signatures_and_suppression():
    scanner = licenses.Scanner(licenses.rules())
    labels = lambda text: scanner.scan(text)[5]
    assert labels(TEXTS[8]) == "apache-2.0"
    assert labels(TEXTS[10]) == "gpl-3.0"
    assert labels(TEXTS[11]) == "mit"
    assert labels("Creative Commons Attribution-ShareAlike 4.0 International") == "cc-by-sa-4.0"  # holds cc-by and cc-by-sa
    assert licenses.suppressed([(3, 0, 10), (1, 2, 5), (2, 0, 10), (0, 20, 30), (4, 25, 40)]) == [(0, 20, 30), (2, 0, 10)]


LANGS = {
    "en": "the of and to in is that was for with this from have they their would which there about when were been".split(),
    "fr": "le la les de des et un une dans pour que qui avec sur pas plus nous vous était être même".split(),
    "ru": "и в не на что он как это но она так его было бы только меня еще нет".split(),
}


def labelled_rows(n, seed):
    source = random.Random(seed)
    return [(i, " ".join(source.choice(LANGS[lang]) for _ in range(source.randrange(5, 60))), lang) for i, lang in enumerate(source.choices(list(LANGS), k=n))]


LABELLED = "doc_id long, text string, lang string, lang_pred string, score string"


@pytest.fixture(scope="module")
def model(spark):
    rows = labelled_rows(300, 1) + [(900, None, "en"), (901, "no label", None), (902, "123 !!", "num")]
    return language.learn(spark.createDataFrame([(*r, "x", "y") for r in rows], LABELLED))


def test_held_out_languages(spark, model):
    rows = labelled_rows(200, 2)
    odd = [(1000, None), (1001, ""), (1002, "123 ... ½ 45"), (1003, "qqqq xxxx"), (None, "the of and"), (1004, "the " * 50_000)]
    docs = spark.createDataFrame([(d, t, None, "x", "y") for d, t, _ in rows] + [(d, t, None, "x", "y") for d, t in odd], LABELLED)
    got = {r.doc_id: r for r in language.predict(docs.select("doc_id", "text"), model, ["doc_id"]).collect()}
    assert len(got) == len(rows) + len(odd)
    assert sum(got[d].lang_pred == lang for d, _, lang in rows) >= 0.98 * len(rows)
    assert {got[d].lang_pred for d in (1000, 1001, 1002)} == {"und"} and got[1000].score == 0
    assert got[None].lang_pred == "en" and got[1004].lang_pred == "en" and got[1003].score < 0.3
    assert all(0 <= r.score <= 1 for r in got.values())


def test_a_small_language_keeps_its_trigrams(spark):
    """A language of many signs stands beside one that has more trigrams, each more often, than any share of the model."""
    source = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyzàâçéèêëîïôûùüÿœæ"
    words = lambda signs, n: " ".join("".join(source.choice(signs) for _ in range(12)) for _ in range(n))
    large = [words(letters, 100) for _ in range(250)]
    small = [words([chr(0x4E00 + i) for i in range(3000)], 20) for _ in range(20)]
    rows = [(t, "la") for t in large for _ in range(2)] + [(t, "zh") for t in small]
    docs = spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], LABELLED)
    learned = language.learn(docs)
    assert len(learned.grams) > 50_000
    got = language.predict(docs.where("lang = 'zh'").select("doc_id", "text"), learned, ["doc_id"]).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("zh", 1.0)] * len(small)


def test_scores_are_those_of_plain_counts(spark):
    """Against counts in dictionaries, with characters of all widths."""
    import numpy as np

    rows = [("ab ab abc 𐐨𐐨b", "x"), ("abd éa b", "y"), ("a語語c ab", "x")]
    learned = language.learn(spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], LABELLED))
    count, size = {}, {"x": 0, "y": 0}
    for text, lang in rows:
        for word in text.split():
            for i in range(len(word)):
                gram = f"^{word}$"[i : i + 3]
                count[gram, lang] = count.get((gram, lang), 0) + 1
                size[lang] += 1
    grams = {g for g, _ in count}
    asked = ["ab", "abce", "zz", "𐐨𐐨b", "語"]
    scores, each, known = learned.scores(asked)
    for word, row, n, k in zip(asked, scores, each, known):
        own = [f"^{word}$"[i : i + 3] for i in range(len(word))]
        want = [sum(np.log((count.get((g, lang), 0) + 0.5) / (size[lang] + 0.5 * len(grams))) for g in own) for lang in ("x", "y")]
        assert row == pytest.approx(want, abs=1e-5) and (n, k) == (len(own), sum(g in grams for g in own))


def test_texts_of_a_batch_are_labelled_in_parts(model, monkeypatch):
    texts = [t for _, t, _ in labelled_rows(120, 5)] + [None, "", "123", "the " * 300]
    want, whole = language.Labeller(model)(texts), language.Labeller.meet
    met = []
    monkeypatch.setattr(language.Labeller, "meet", lambda self, own: met.append([len(t or "") for t in own]) or whole(self, own))
    for name, value in (("TEXTS", 500), ("PART", 40), ("REMEMBERED", 30)):
        monkeypatch.setattr(language, name, value)
    own = language.Labeller(model)
    assert own(texts) == want
    assert sum(map(len, met)) == len(texts) and all(sum(sizes[:-1]) <= 500 for sizes in met) and len(met) > 10


def test_counts_of_a_batch_are_passed_on_in_parts(spark, monkeypatch):
    rows = [(lang, text) for _, text, lang in labelled_rows(200, 6)] + [("ru", "слово" * 50), ("en", "12 --"), ("fr", "")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["lang", "text"])
    runs = []
    docs, none = spark.createDataFrame(rows, "lang string, text string"), spark.createDataFrame([], "lang string, script string, gram long, n long")
    monkeypatch.setattr(language, "in_batches", lambda df, run, schema: runs.append(run) or none)
    language.learned_counts(docs)

    def counts():
        parts, sums = list(runs[0](iter([batch]))), Counter()
        for row in (r for p in parts for r in p.to_pylist()):
            sums[row["lang"], row["script"], row["gram"]] += row["n"]
        return parts, sums

    _, want = counts()
    monkeypatch.setattr(language, "COUNTED", 20)
    monkeypatch.setattr(language, "PART", 60)
    parts, got = counts()
    assert got == want and len(parts) > 10 and max(p.num_rows for p in parts) <= 60 + 250


def test_spans_of_mixed_text(model):
    text = " ".join(LANGS["en"] + LANGS["fr"] + LANGS["ru"] + LANGS["en"])
    spans = language.Labeller(model).spans(text)
    assert [s[2] for s in spans] == ["en", "fr", "ru", "en"]
    assert abs(spans[0][1] - len(LANGS["en"])) <= 1


def test_words_end_where_the_script_changes():
    assert language.words_of("Это<b>mixedтекст</b>語の") == ["это", "b", "mixed", "текст", "b", "語", "の"]
    assert language.words_of("l'été") == ["l", "été"] and language.words_of("12--") == []
    assert "".join(language.words_of("ʰabʰгдeʰ")) == "ʰabʰгдeʰ" and language.words_of("ʰabʰгд") == ["ʰabʰ", "гд"]
    source = random.Random(5)
    for _ in range(300):
        run = "".join(chr(source.choice([source.randrange(0x21, 0x600), source.randrange(0x3000, 0x3200), 0x20000])) for _ in range(12))
        words = language.words_of(run)
        assert "".join(words) == "".join(language.LETTERS.findall(run.lower()))
        for word in words:
            assert len({s for c in word if (s := language.script_of(c))}) <= 1


def test_spans_of_text_without_blanks(spark):
    """Languages of three scripts, and two of one script parted by markup, without one blank between them."""
    han = ["的一是不了人我在有他", "这中大来上国个到说们"]
    rows = [*((" ".join(LANGS[x]), x) for x in LANGS), *((t, "zh") for t in han), ("のにはをたがでてとし", "ja")] * 20
    learned = language.learn(spark.createDataFrame([(i, *r, "x", "y") for i, r in enumerate(rows)], LABELLED))
    own = language.Labeller(learned)
    text = han[0] + "".join(LANGS["ru"]) + han[1] + "のにはをたがでてとし" + "<b>" + "</b><b>".join(LANGS["en"] + LANGS["fr"]) + "</b>"
    assert " " not in text
    assert [s[2] for s in own.spans(text)][:4] == ["zh", "ru", "zh", "ja"]
    assert {"en", "fr"} <= {s[2] for s in own.spans(text)[4:]} <= {"en", "fr"}
    spaced = own.spans("".join(LANGS["ru"]) + " " + "".join(LANGS["ru"]))
    assert [s[:2] for s in spaced] == [(0, 2)]
    before = own(["the of and", text])
    own.forget()
    assert own(["the of and", text]) == before and own([""]) == [("und", 0.0)]


def test_shortcut_gives_the_best_path(model):
    """The path of the labeller against the best of all, by plain dynamic programming."""
    import numpy as np

    own, source = language.Labeller(model, switch=3.0), np.random.default_rng(3)
    for _ in range(2000):
        scores = source.normal(size=(source.integers(1, 12), 3)).astype(np.float32) * source.choice([0.2, 1, 4])
        value = scores[0].astype(float)
        for row in scores[1:]:
            value = np.array([max(value[j], max(value) - 3.0) + row[j] for j in range(3)])
        path = own.path(scores)
        total = sum(float(scores[t, k]) for t, k in enumerate(path)) - 3.0 * sum(a != b for a, b in zip(path, path[1:]))
        assert total == pytest.approx(max(value), abs=1e-4)


def test_script_narrows_the_candidates(model):
    own = language.Labeller(model)
    assert own(["это было"])[0][0] == "ru"
    assert language.script_of("12é") == "latin" and language.script_of("слово") == "cyrillic" and language.script_of("語") == "han"


def test_nothing_learned(spark):
    empty = language.learn(spark.createDataFrame([], LABELLED))
    docs = spark.createDataFrame([(1, "the of", "en", "x", "y")], LABELLED)
    assert tuple(language.predict(docs.select("doc_id", "text"), empty, ["doc_id"]).first()) == (1, "und", 0.0)


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    import corpus_pipeline
    from test_similarity import components_by_force

    from tillgrid.llm import line_dedup

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(200)
    extra = docs.limit(1).select(F.lit(10**6).cast("long").alias("doc_id"), F.lit("123 456").alias("text"), "lang", "source", "n_chars")
    null = docs.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    docs = docs.union(extra.select(docs.columns)).union(null.select(docs.columns))
    before = docs
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, before, sf_dir)
        path = str(tmp_path / name)
        out.write.parquet(path)
        after = spark.read.parquet(path)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert after.dtypes == docs.dtypes, name
        if name == "language_id":
            assert {r.doc_id for r in before.join(after, "doc_id", "left_anti").collect()} <= {10**6, None}
            assert after.where(f"doc_id = {10**6}").count() == 0
        if name == "line_dedup":
            want = {r.doc_id: r.kept_sha256 for r in line_dedup.digest(before).collect()}
            assert {r.doc_id: r.h for r in after.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")).collect()} == want
        if name == "jaccard_join":
            rows = [(r.doc_id, r.text) for r in before.collect()]
            assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in components_by_force(rows)})
        if name == "bpe":
            assert after.count() == before.count()
        before = after

"""Every operator against a plain version, and the odd inputs that each must bear."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import components as lists
from lectern.llm import decontamination, line_dedup, quality, scratch
from lectern.llm.components import components
from lectern.llm.decontamination import contamination
from lectern.llm.jaccard_join import jaccard_components, light_boundary, light_links, linkable_sets
from lectern.llm.language_id import identify, letter_vector
from lectern.llm.license_scan import license_scan
from lectern.llm.line_dedup import dropped_lines, first_copies, without_lines, word_lines
from lectern.llm.mixing import mixed, source_targets
from lectern.llm.scratch import stored
from lectern.llm.suffix_dedup import without_repeats
from lectern.llm.suffix_order import suffix_array
from lectern.llm.token_counts import PieceMerger, token_counts
from lectern.llm.vector_search import top_k
from tests.llm import brute

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def texts():
    """Copies, near copies, shared passages, short, blank, long and null texts."""
    rng = random.Random(5)
    base = [[rng.choice(WORDS) for _ in range(rng.choice([30, 60, 120]))] for _ in range(25)]
    passage = " ".join(rng.choice(WORDS) for _ in range(40))
    out = []
    for i in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10_000)}"
        out.append(" ".join(words))
    for i in range(30):
        out.append(" ".join(f"own{i}x{j}" for j in range(rng.randrange(40))) + " " + passage + "\nend " + str(i))
    for n in (5, 6, 7, 8, 9, 10, 11):
        for skip in (0, 1, 2):
            out.append(" ".join(WORDS[skip:skip + n]))
    out += [None, "", " \n\t", "One", "one", "a b c", "A b c", " ".join(WORDS * 50), " ".join(WORDS * 50) + " x", "éÉ ß\x00 z"]
    return list(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(
        [(i, t, "lang", f"src{i % 4}" if i % 7 else None, 1, "x", "y") for i, t in texts],
        "doc_id long, text string, lang string, source string, n_chars long, row string, key string")


@pytest.fixture(scope="module")
def none(spark, docs):
    return docs.limit(0)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    nodes = {x for e in real for x in e}
    assert got == brute.smallest_reachable(nodes, real)


def test_jaccard_join(docs, texts):
    got = {r.row_id: (r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()}
    assert got == brute.jaccard_components(texts)


def test_light_sets_alone_give_the_same_links(spark):
    texts = [(i, " ".join(WORDS[a:a + n])) for i, (a, n) in enumerate((a, n) for a in range(4) for n in range(5, 17))]
    sets = linkable_sets(spark.createDataFrame(texts, "doc_id long, text string"), "text")
    assert 0 <= light_boundary(sets) <= 20
    edges = [(r.a, r.b) for r in light_links(sets, 20).collect()]
    nodes = [r.set_id for r in sets.collect()]
    groups = {}
    for node, label in brute.smallest_reachable(nodes, edges).items():
        groups.setdefault(label, set()).add(node)
    wanted = {}
    for i, (n, label) in brute.jaccard_components(texts).items():
        wanted.setdefault(label, set()).add(i)
    sizes = sorted(len(g) for g in groups.values() if len(g) > 1)
    assert sizes == sorted(len(g) for g in wanted.values() if len(g) > 1)


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(400):
        text = [rng.randrange(rng.choice([1, 2, 5])) for _ in range(rng.randrange(30))]
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_dedup(spark, docs, texts):
    got = {r.row_id: (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept))
           for r in without_repeats(docs).collect()}
    assert got == brute.without_repeats(texts)


def test_suffix_dedup_of_repetitive_texts(spark):
    rows = [(3, "ab" * 400), (1, "ab" * 100 + "c" + "ab" * 100), (2, "a" * 500), (9, "x" + "a" * 60), (5, "q" * 49), (6, "q" * 49)]
    got = {r.row_id: (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept))
           for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.without_repeats(rows)


def test_suffix_dedup_takes_hot_names_apart(spark, monkeypatch):
    from lectern.llm import postings, suffix_dedup
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(200))
    rows = [(i, f"{rng.random()} {i}" * 4 + passage[i % 3:] + f"{rng.random()}" * 4) for i in range(80)]
    monkeypatch.setattr(postings, "HOT_IN_FLUSH", 4)
    monkeypatch.setattr(suffix_dedup, "HOT_NAME", 60)
    got = {r.row_id: (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept))
           for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.without_repeats(rows)


def test_token_counts(spark, docs, texts):
    tokenizers = pytest.importorskip("public_tokenizers")
    import sentencepiece
    path = tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    wanted = {i: (len((t or "").encode()), len(library.encode(t or ""))) for i, t in texts}
    got = {r.row_id: (r.n_bytes, r.n_tokens) for r in token_counts(docs, path).collect()}
    assert got == wanted
    merger = PieceMerger(path)
    rng = random.Random(2)
    odd = ["".join(rng.choice("ab \n▁é漢✿<s>0aeinrst") for _ in range(rng.randrange(60))) for _ in range(2000)]
    odd += ["a" * 3000, " " * 2000, "the" * 2000, "<s></s><unk>", "▁", "﻿x", "".join(rng.choice("aeinrst") for _ in range(2000))]
    assert merger.count(odd) == [len(x) for x in library.encode(odd)]


def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 16).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(8)]  # ties
    rows += [(400, None), (401, [None] + [0.1] * 15), (402, [float("nan")] * 16), (403, [float("inf")] * 16), (404, [])]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_vector_search(spark):
    rows, df = vectors(spark)
    good = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows
            if v and all(x is not None and math.isfinite(x) for x in v)}
    wanted = []
    for q in (i for i in good if i % 50 == 0):
        scored = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        wanted += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    got = sorted(map(tuple, top_k(df, df.where("vec_id % 50 = 0"), 5).collect()))
    assert [r for r in got if r[0] != 404 and r[0] != 400] == sorted(wanted)


def test_vector_search_of_few_and_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0])], "vec_id long, embedding array<double>")
    assert list(map(tuple, top_k(df, df.where("vec_id = 0"), 5).collect())) == [(0, 1, 1, 256 * 256)]
    assert top_k(df.limit(0), df.limit(0), 5).count() == 0


def test_contamination_beyond_the_broadcast_bound(spark, docs, texts, monkeypatch):
    """The shuffled path gives the same, and no array of words goes through a shuffle."""
    items = spark.createDataFrame(
        [(i, " ".join((t or "").split()[3:3 + n])) for i, (_, t) in enumerate(texts[:40]) for n in (4, 10, 25)], "item_id long, text string")
    wanted = sorted(map(str, contamination(docs, items).collect()))
    plans, plain = [], decontamination._finds

    def watched(*args):
        plans.append(plain(*args))
        return plans[-1]

    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontamination, "_finds", watched)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, contamination(docs, items).collect())) == wanted
        text = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanged = [text.split("\n")[i + 1] for i, line in enumerate(text.split("\n")) if "Exchange" in line]
    assert exchanged and not any("words#" in line.split("[", 1)[-1].split(" AS ")[0] and "own#" not in line for line in exchanged)


def test_keys_and_copies_beyond_the_broadcast_bound(spark, monkeypatch):
    rows = spark.range(60).select(F.when(F.col("id") % 9 > 0, F.col("id") % 9).alias("k"), "id")
    keys = stored(spark.createDataFrame([(1,), (4,), (77,)], "k long"), "keys")
    repeated = spark.createDataFrame([(1, "one two\nthree"), (1, "one two\nthree"), (2, "one two")], "doc_id long, text string")
    lines = stored(word_lines(repeated, "doc_id", "text"), "lines")

    def both():
        return (sorted(map(str, scratch.with_keys(rows, keys, "k").select("k", "id").collect())),
                sorted(map(str, first_copies(lines).select("row_id", "line").collect())))

    wanted = both()
    assert len(wanted[0]) == 14 and len(wanted[1]) == 3
    for module in (scratch, line_dedup):
        monkeypatch.setattr(module, "BROADCAST_ROWS", 0)
    assert both() == wanted


def test_contamination(spark, docs, texts):
    items = [(1, " ".join(texts[3][1].split()[5:25])), (2, "W1  w2, w3"), (3, None), (4, "!!"), (5, "nowhere to be found at all in any of these texts"),
             (6, "Own0x1"), (10, " ".join(texts[3][1].split()[5:25])), (None, "a B c")]
    got = {r.row_id: (r.n_words, r.n_hit, tuple(r["items"]), r.contaminated)
           for r in contamination(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute.contamination(texts, items)
    assert any(x[1] for x in got.values())


def test_mixing(spark, docs, texts):
    got = mixed(docs).collect()
    again = mixed(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sources = dict(docs.select("doc_id", "source").collect())
    per = {}
    for r in got:
        assert r.size == len((dict(texts)[r.row_id] or "").encode().split()) and 0 <= r.taken <= 2 * r.size
        per.setdefault(sources[r.row_id], []).append(r)
    total = sum(r.size for r in got)
    assert abs(sum(r.taken for r in got) - 1.5 * total) <= len(per)
    for rows in per.values():
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= 1
        assert rows[0].target <= 2 * sum(r.size for r in rows) and rows[0].source_size == sum(r.size for r in rows)


def test_targets_are_filled_like_water(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 7, "e": 0, None: 30}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in source_targets(rows).collect()}
    weights = dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), (5, 2, 1, 5, 2, 1)))
    goal, full = 1.5 * sum(sizes.values()), set()
    while True:
        level = (goal - sum(2 * sizes[s] for s in full)) / sum(w for s, w in weights.items() if s not in full)
        over = {s for s in sizes if s not in full and 2 * sizes[s] < level * weights[s]}
        if not over:
            break
        full |= over
    assert got == pytest.approx({s: 2 * sizes[s] if s in full else level * weights[s] for s in sizes})


def test_lines(spark):
    long = " ".join(f"word{i}" for i in range(200))
    near = long.replace("word150", "word15x")
    rows = [(1, f"Hello, World\n\n{long}\nonly here"), (2, f"hello world!\n{near}\nother"), (3, "HELLO  world"), (4, None), (5, ""),
            (6, "...\n \n"), (0, "hello world"), (None, "only here\nlast"), (7, "x y\nx y\nx y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = dropped_lines(df)
    got = {r.row_id: (r.n_lines, r.dropped) for r in found.collect()}
    assert got == {0: (1, []), 1: (3, [0]), 2: (3, [0, 1]), 3: (1, [0]), None: (2, [0]), 7: (3, [1, 2])}
    left = {r.doc_id: r.text for r in without_lines(df, found).collect()}
    assert left == {0: "hello world", 1: f"\n{long}\nonly here", 2: "other", 4: None, 5: "", 6: "...\n \n", None: "last", 7: "x y"}


def test_lines_agree_with_a_plain_version(spark, docs, texts):
    some = [(i, t) for i, t in texts if len(t or "") < 5000]
    got = {r.row_id: (r.n_lines, r.dropped) for r in dropped_lines(docs.where("coalesce(length(text), 0) < 5000")).collect()}
    assert got == brute.dropped_lines(some)


def linked_lines(rows):
    """{id: numbers of dropped lines} with edit similarity alone as the link; compares every pair."""
    lines = [(i, at, line) for i, text in rows for at, line in enumerate(text.split("\n"))]
    values = sorted({v for _, _, v in lines})
    edges = [(a, b) for k, a in enumerate(values) for b in values[k + 1:]
             if abs(len(a) - len(b)) <= 0.1 * max(len(a), len(b)) and len(set(a.split()) & set(b.split())) > 0
             and brute.edit_distance(a, b) <= int(0.1 * max(len(a), len(b)) + 1e-9)]
    label = brute.smallest_reachable(values, edges)
    first, out = {}, {i: [] for i, _ in rows}
    for i, at, v in sorted(lines):
        if first.setdefault(label[v], (i, at)) != (i, at):
            out[i].append(at)
    return out


def test_lines_with_one_word_replaced_are_found(spark):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 8))) for _ in range(3000)]
    rows = []
    for i, n in enumerate([10, 14, 20, 30, 40, 60] * 3):
        words = [rng.choice(vocabulary) for _ in range(n)]
        texts = [" ".join(words)]
        for _ in range(2):
            other = list(words)
            at = rng.randrange(n)
            other[at] = "x" * min(4, len(other[at]))
            texts.append(" ".join(other))
        rows += [(10 * i + k, f"{t}\nown line of {'abcdefghijklmnopqr'[i]} and {'uvw'[k]}{i * k}") for k, t in enumerate(texts)]
    wanted = linked_lines(rows)
    assert sum(0 in gone for gone in wanted.values()) >= 30
    got = {r.row_id: r.dropped for r in dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == wanted


def test_repeated_rows_count_once_and_keep_their_links(spark):
    text = " ".join(f"word{i}" for i in range(30))
    near = text.replace("word17", "ward17")
    rows = [(1, text)] * 3 + [(2, f"own line\n{near}")] + [(None, text)] * 2
    lines = stored(word_lines(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text"), "lines")
    assert first_copies(lines).groupBy("row", "line").count().where("count > 1").isEmpty()
    got = {r.row_id: (r.n_lines, r.dropped) for r in dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (1, []), 2: (2, [1]), None: (1, [0])}


def test_lines_without_blanks_meet_as_well(spark):
    rng = random.Random(5)
    one = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120))
    two = one[:50] + "好" + one[51:]
    rows = [(1, one), (2, two), (3, "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(120)))]
    got = {r.row_id: r.dropped for r in dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [0], 3: []}


def test_license_rules(spark):
    rows = [(1, "Licensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License."),
            (2, "x. Released under the MIT License!\nAll rights reserved."), (3, "all rights reserved"), (4, None), (5, ""), (6, "All rights. Reserved.")]
    got = {r.row_id: (r["sequence"], r.licenses) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (["ApacheRef", "ApacheUse"], ["Apache-2.0"]), 2: (["MITRef", "AllRights"], ["MIT", "All-Rights-Reserved"]),
                   3: (["AllRights"], ["All-Rights-Reserved"]), 4: ([], []), 5: ([], []), 6: ([], [])}


def test_license_headers_that_are_wrapped(spark):
    mit = """# Permission is hereby granted, free of charge, to any person obtaining a copy
# of this software and associated documentation files (the "Software"), to deal
# in the Software without restriction, including without limitation the rights
# to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
# copies of the Software, and to permit persons to whom the Software is
# furnished to do so, subject to the following conditions:
#
# The above copyright notice and this permission notice shall be included in all
# copies or substantial portions of the Software."""
    apache = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

3. Neither the name of Example Corp nor the names of its contributors may
   be used to endorse or promote products derived from this software without
   specific prior written permission."""
    gpl = """// This program is free software; you can redistribute it and/or modify
// it under the terms of the GNU General Public License as published by
// the Free Software Foundation; either version 2 of the License, or
// (at your option) any later version."""
    wanted = {
        mit: (["MITGrant", "MITNotice"], ["MIT"]),
        apache: (["ApacheRef", "ApacheUse", "ApacheCopy", "ApacheAsIs"], ["Apache-2.0"]),
        bsd: (["BSDGrant", "BSDEndorse"], ["BSD-3-Clause"]),
        gpl: (["GPL2Free"], ["GPL-2.0-or-later"]),
        "The code is released under the MIT License.": (["MITRef"], ["MIT"]),
        "Not under the MIT. License to all rights reservedly": ([], []),
        "// SPDX-License-Identifier: MPL-2.0\n": (["MPLRef"], ["MPL-2.0"]),
    }
    rows = list(enumerate(wanted))
    got = {r.row_id: (r["sequence"], r.licenses) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(wanted.values()))


def test_language_accuracy_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), F.col("row_id") == F.col("doc_id")).collect()
    assert all(r.held_out == (zlib.crc32(str(r.row_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_odd_texts(spark):
    rows = [(0, "the cat", "en"), (1, None, "en"), (3, "123 !", "en"), (4, "der hund", "de"), (None, "chat", "fr"), (5, "𝔄𝔅 ü", None)]
    got = {r.row_id: (r.lang_pred, r.held_out) for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[1][0] == got[3][0] == "und" and got[0][0] in ("en", "de") and got[None][1] is False
    unlabelled = spark.createDataFrame([(0, "abc", None)], "doc_id long, text string, lang string")
    assert identify(unlabelled).first().lang_pred == "und"


def test_quality_on_held_out_rows(spark, small):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).join(labels, F.col("row_id") == F.col("doc_id")).where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)
    scored = {r.row_id: r.predicted for r in quality.quality_scores(docs, labels).collect()}
    assert {r.doc_id for r in quality.good_documents(docs, labels).collect()} == {i for i, p in scored.items() if p}


def test_quality_scores_agree_with_plain_densities(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "labels"))
    label = {r.doc_id: r.quality for r in labels.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    x = {i: quality.statistics((t or "").encode()) for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in texts}
    learned = [np.array([x[i] for i in texts if not held[i] and label.get(i) == kind]) for kind in (0, 1)]
    ids = sorted(texts)
    wanted = brute.discriminant_scores(learned, np.array([x[i] for i in ids]), quality.POOLED, quality.DIAGONAL)
    got = {r.row_id: r for r in quality.quality_scores(docs, labels).collect()}
    assert sorted(got) == ids
    for i, score in zip(ids, wanted):
        assert abs(got[i].score - score) < 1e-9 and got[i].held_out == held[i] and got[i].predicted == (score >= 0.7)


def test_quality_without_labels_and_with_odd_texts(spark, docs):
    labels = spark.createDataFrame([(0, None), (None, 1), (1, 7)], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs, labels).collect()} == {0.5}
    some = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    rows = quality.quality_scores(docs, some).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert jaccard_components(none).count() == 0
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.good_documents(none, labels).count() == 0
    assert mixed(none).count() == 0
    assert without_repeats(none).count() == 0
    assert dropped_lines(none).count() == 0
    assert license_scan(none).count() == 0
    assert identify(none).count() == 0
    assert contamination(none, items).count() == 0


def test_repeated_rows_each_get_a_row(spark):
    rows = spark.createDataFrame([(1, "a b c d e f", "en", "s")] * 3 + [(None, "a b c d e f", None, None)] * 2,
                                 "doc_id long, text string, lang string, source string")
    items = spark.createDataFrame([(1, "b c d")] * 2, "item_id long, text string")
    assert [r.component_id for r in jaccard_components(rows).collect()] == [1] * 5
    assert [r.n_hit for r in contamination(rows, items).collect()] == [3] * 5
    assert len(without_repeats(rows).collect()) == len(identify(rows).collect()) == len(license_scan(rows).collect()) == 5
    assert sum(r.taken for r in mixed(rows).collect()) == 45


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="missing columns: text"):
        jaccard_components(spark.range(1).withColumnRenamed("id", "doc_id"))


def test_digest_is_of_the_kept_bytes(spark, texts):
    df = spark.createDataFrame(texts[:5], "doc_id long, text string")
    for r in without_repeats(df).select("kept", F.sha2("kept", 256).alias("h")).collect():
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.h


def test_mixing_orders_no_join_of_all_rows(spark):
    """One source holds nearly all rows: under the windows are only the few rows where a source ends."""
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.lit("one two three").alias("text"),
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("source"))
    got = mixed(rows)
    assert got.count() == 30_000
    taken = {r.source_size: (r.taken, r.target) for r in got.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()}
    assert all(abs(words - target) <= 1 for words, target in taken.values())
    got.collect()
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window ["):]
    scans = [line for line in below.split("\n") if "Relation" in line]
    assert scans and not any("outer#" in line and "text#" in line for line in scans)
    edge = [line for line in scans if "order#" in line]
    assert len(edge) == 1, "the rows below the window come from one written table"


def test_languages_agree_with_plain_bundles(spark, small):
    """Whole texts of a small table, and odd ones: none, blank, no letter, short, repeated rows, a tie of two languages."""
    own = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    odd = [None, "", "  12 !", "a", "Ünïcode 𝒳 text, straße", "same words here", "same words here", "\U00020000\U00020001"]
    rows = own + [(1000 + i, t, "aa" if i % 2 else "bb") for i, t in enumerate(odd)] + [(2000, "no label", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    wanted = brute.languages([(i, t, lang, not held[i]) for i, t, lang in rows], lambda c: letter_vector(c, 256).astype(float), 256)
    got = {r.row_id: r for r in identify(docs, dimensions=256).collect()}
    assert got.keys() == wanted.keys()
    for i, (lang, score) in wanted.items():
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-6 and got[i].held_out == held[i], i


def test_counts_of_characters_rule_out_no_similar_pair(spark):
    """Random pairs at all distances: none within the similarity is ruled out, and unrelated ones are."""
    draw = random.Random(5)
    letters = "abcdefgh é9中z"
    rows = []
    for _ in range(400):
        one = "".join(draw.choice(letters) for _ in range(draw.randint(1, 60)))
        two = list(one)
        for _ in range(draw.randint(0, 8)):
            at = draw.randrange(len(two) + 1)
            two[at:at + draw.randint(0, 1)] = draw.choice(letters) * draw.randint(0, 1)
        rows.append((one, "".join(two)))
    rows += [("abab" * 20, "cdcd" * 20)]
    pairs = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", F.levenshtein("a", "b").alias("d"), *[F.char_length(c).alias(f"{c}_chars") for c in "ab"],
        *[line_dedup.char_counts(c).alias(f"{c}_counts") for c in "ab"]).select("*", line_dedup.may_be_similar("a", "b").alias("may")).collect()
    similar = [r for r in pairs if r.d <= int(0.1 * max(len(r.a), len(r.b)) + 1e-9)]
    assert len(similar) > 20 and all(r.may for r in similar)
    assert not pairs[-1].may and sum(r.may for r in pairs) < len(pairs)


def test_unrelated_lines_with_a_common_run_are_no_candidates(spark):
    """Lines of random words share one run: far apart it lists no pair, and at one place the sides rule the pair out."""
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choices("abcdefghij" if n % 2 else "qrstuvwxyz", k=6)) for _ in range(n))
    run = "run of three"
    lines = [f"{run} {words(40)}", f"{words(20)} {run} {words(20)}", f"{words(21)} {run} {words(19)}"]
    near = lines[1].replace(run, f"x {run}")
    rows = spark.createDataFrame(list(enumerate([*lines, near])), "node long, value string")
    grams = line_dedup.line_grams(rows).join(rows, "node").where(F.expr(f"substr(value, start + 1, {len(run)})") == run).collect()
    start = {g.node: g.start for g in grams}
    assert all(line.index(run) == start[i] for i, line in enumerate([*lines, near]) if i in start)
    text = {i: line for i, line in enumerate([*lines, near])}
    pairs = [(a, b, len(text[a]), len(text[b]), text[a][:text[a].index(run)].count(" ") + 1, text[b][:text[b].index(run)].count(" ") + 1,
              text[a].index(run), text[b].index(run), text[a], text[b]) for a, b in ((0, 1), (1, 2), (1, 3))]
    names = "a long, b long, a_chars int, b_chars int, a_place int, b_place int, a_start int, b_start int, a_value string, b_value string"
    met = spark.createDataFrame(pairs, names)
    for p in "ab":
        met = met.withColumn("left", F.expr(f"left({p}_value, {p}_start)")).withColumn("whole", F.col(f"{p}_value"))
        before, whole = line_dedup.char_counts("left"), line_dedup.char_counts("whole")
        met = met.withColumn(f"{p}_sides", F.concat(before, F.zip_with(whole, before, lambda x, y: x - y)))
    got = met.select("a", "b", line_dedup._fits("a", "b").alias("fits"), line_dedup._sides_fit("a", "b").alias("sides")).collect()
    assert [tuple(r) for r in got] == [(0, 1, False, False), (1, 2, True, False), (1, 3, True, True)]


def test_near_copies_need_no_distance_of_whole_texts(spark):
    """Its cost is the square of their length, and a third of all time went into it; the ways that cost less never find too much."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(400)]

    def edited(line, kinds, edits):
        out = list(line)
        for _ in range(edits):
            i, kind = rng.randrange(len(out)), rng.choice(kinds)
            if kind == "letter":
                k = rng.randrange(len(out[i]))
                out[i] = out[i][:k] + "\u00e9" + out[i][k + 1:]
            elif kind == "drop":
                del out[i]
            elif kind == "twice":
                out.insert(i, out[i])
            else:
                out.insert(i, rng.choice(words))
        return " ".join(out)

    rows = []
    for n, kinds, edits in ((4000, ["letter"], 900), (60, ["letter", "drop", "add"], 4), (60, ["letter", "drop", "twice"], 12), (30, ["add"], 9), (8, ["drop"], 1), (3, ["twice"], 1)):
        for _ in range(1 if n > 1000 else 12):
            line = [rng.choice(words) for _ in range(n)]
            rows.append((len(rows), " ".join(line), edited(line, kinds, edits)))
    line = " ".join(words)
    rows += [(len(rows) + k, *pair) for k, pair in enumerate([
        (line, line + " tail"), (line, "head " + line), (line, line), ("a", "b"), ("a", "a b"), ("b", "a b"), ("b", "a b b"),
        (" ".join(words[:50] * 3), " ".join(words[:50] * 3 + words[:5])), ("a b a b", "b a b a")])]
    df = spark.createDataFrame([(a, -a, x, y) for a, x, y in rows], "a long, b long, a_value string, b_value string").repartition(8)
    edits = {r.a: r for r in line_dedup._with_edits(df).select("a", "edits", "most").collect()}
    middles = {r.a: r.d for r in line_dedup._with_middles(df.where("a > 0")).selectExpr("a", "levenshtein(a_middle, b_middle) d").collect()}
    short = {a: brute.edit_distance(x, y) for a, x, y in rows[1:]}
    wanted = {a: short[a] <= edits[a].most for a in short} | {0: True}
    assert edits[0].edits <= edits[0].most
    assert sum((edits[a].edits or 0) <= edits[a].most for a in range(1, 13)) == sum(wanted[a] for a in range(1, 13)) > 6
    assert all(edits[a].edits is None or edits[a].edits >= min(d, edits[a].most + 1) for a, d in short.items())
    assert {a: middles[a] for a in short} == short
    for likely in (True, False):
        assert {r.a: r.similar for r in line_dedup.similar_pairs(df.where("a > 0"), likely).collect()} == {a: w for a, w in wanted.items() if a}


def test_similar_pairs_are_those_of_the_edit_distance(spark):
    """Random lines with words put in, taken out and replaced, and with letters replaced."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdef", k=rng.randint(1, 6)))
    pairs = []
    for i in range(300):
        words = [word() for _ in range(rng.randint(1, 40))]
        other = list(words)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(other) + 1)
            other[at:at + rng.randint(0, 1)] = [word()] * rng.randint(0, 1)
        pairs.append((i, -1 - i, " ".join(words), " ".join(other) or "a"))
    df = spark.createDataFrame(pairs, "a long, b long, a_value string, b_value string")
    got = {r.a: r.similar for r in line_dedup.similar_pairs(df).collect()}
    whole = df.select("a", (F.levenshtein("a_value", "b_value") <= F.floor(
        0.1 * F.greatest(F.char_length("a_value"), F.char_length("b_value")) + 1e-9)).alias("similar")).collect()
    assert got == {r.a: r.similar for r in whole} and 20 < sum(got.values()) < 280


def test_nodes_that_are_partly_linked_need_fewer_pairs(spark, monkeypatch):
    """Eight lists of 300 nodes, a ninth of all pairs linked: with several pivots less than half as many candidates."""
    linked = F.expr("pmod(xxhash64(a + b), 9) = 0")
    entries = stored(spark.range(2400).select(
        F.expr("id div 300").alias("key"), F.expr("id % 300").alias("node"), F.lit(0).alias("weight"), F.lit(1).alias("chars")), "entries")

    def joined():
        met = []

        def confirm(candidates):
            asked = stored(candidates.select("a", "b"), "asked")
            met.append(asked.count())
            return asked.where(linked)

        links = lists.list_links(entries, ["chars"], lambda a, b: F.col(f"{a}_chars") == F.col(f"{b}_chars"), confirm)
        return {r.node: r.label for r in components(links).collect()}, sum(met)

    got, few = joined()
    every = spark.range(300).select(F.col("id").alias("a")).crossJoin(spark.range(300).select(F.col("id").alias("b")))
    wanted = brute.smallest_reachable(range(300), [tuple(r) for r in every.where("a < b").where(linked).collect()])
    assert {i: got.get(i, i) for i in range(300)} == dict(wanted)
    monkeypatch.setattr(lists, "PAIRS_AN_ENTRY", float("inf"))
    again, many = joined()
    assert again == got and 2 * few < many


def test_rounds_with_several_pivots_lose_no_link(spark, docs, texts, monkeypatch):
    """Near copies of which some are linked, in two places of the line and with runs that move."""
    monkeypatch.setattr(lists, "PAIRS_AN_ENTRY", -1)
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(500)]
    rows = []
    for length in (5, 14, 40):
        base = rng.choices(words, k=length)
        for _ in range(25):
            other = list(base)
            for _ in range(rng.randint(0, length // 6)):
                at = rng.randrange(length)
                other[at] = rng.choice(words) + rng.choice(["", " of"])
            rows.append((len(rows), " ".join(other)))
    wanted = linked_lines(rows)
    assert 10 < sum(map(len, wanted.values())) < 70
    got = {r.row_id: r.dropped for r in dropped_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == wanted
    some = {r.row_id: r.component_id for r in jaccard_components(docs).collect()}
    assert some == {i: label for i, (_, label) in brute.jaccard_components(texts).items()}


def test_pairs_are_candidates_in_one_list_and_short_ones_by_their_counts(spark):
    """Two lists of both lines list a similar pair once; lines of other characters are no candidates."""
    names = ["key", "chars", "place", "start", "sides", "keys", "places", "starts"]
    kinds = ["long", "int", "int", "int", "array<smallint>", "array<long>", "array<int>", "array<int>"]
    schema = ", ".join(["a long", "b long", *[f"{p}_{n} {k}" for p in "ab" for n, k in zip(names, kinds)]])

    def line(key, chars, sides, places):
        return [key, chars, places[key - 1], 5 * places[key - 1], sides, [1, 2], places, [5 * p for p in places]]

    alike, unlike, far = [10, 10, 40, 40], [5, 15, 20, 60], [40, 60]
    rows = [(1, 2, *line(k, 100, alike, [4, 9]), *line(k, 100, alike, [4, 9])) for k in (1, 2)]
    rows += [(3, 4, *line(k, 100, alike, [4, 9]), *line(k, 100, unlike, [4, 9])) for k in (1, 2)]
    rows += [(5, 6, *line(k, 100, alike, far), *line(k, 100, alike, [4, 60])) for k in (1, 2)]
    met = spark.createDataFrame(rows, schema)
    got = met.where(line_dedup._fits_once("a", "b")).select("a", "a_key").collect()
    assert sorted(map(tuple, got)) == [(1, 1), (5, 2)]
    assert met.where(line_dedup._sides_fit("a", "b")).groupBy("a").count().where("a = 3").isEmpty()

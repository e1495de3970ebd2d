"""Merkle manifest, packing and periodic runs."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import merkle, packing, periodic_runs
from lectern.llm.queries import QUERIES, loop_words
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Column names that the operators use themselves.
CLASHING = ("key", "row_id", "pos", "part", "digest", "n", "ids", "rest", "runs", "start", "chunk", "above")


def clashing(docs):
    return docs.withColumns({name: F.lit(1) for name in CLASHING})


def odd_rows():
    """Nulls everywhere, empty and blank texts, repeated rows and ids, a long text."""
    rows = [(i, f"Text {i} of A and B", "en", f"s{i % 3}", 10) for i in range(40)]
    rows += [(i, "x", "en", "big", 1) for i in range(100, 145)]
    rows += [(1, "other text of an id", "en", "s1", 3), (7, "Text 7 of A and B", "en", "s1", 10), (7, "Text 7 of A and B", "en", "s1", 10)]
    rows += [(None, "no id", None, None, None), (None, "no id", None, None, None), (200, None, "de", None, None)]
    rows += [(201, "", "en", "", 0), (202, " \t\n", "en", "Ω", 3), (203, "é ü 𝄞 ", "fr", "s😀", 6)]
    return rows + [(204, "a b c d e f g h i j " * 60_000, "en", "long", 1_200_000)]


# Merkle manifest


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes):
    """(last node, [(left, right), ...] per node) of one tree."""
    ways, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, k in enumerate(at):
            run = k // 16 * 16
            ways[i].append(("".join(level[run:k]), "".join(level[k + 1:run + 16])))
            at[i] = k // 16
        level = [sha256("".join(level[i:i + 16]).encode()).hexdigest() for i in range(0, len(level), 16)]
    return level[0], ways


def plain_proofs(rows):
    """[(id, leaf, subroot, root, siblings)] in any order."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row[0]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {n: plain_tree([leaf for _, _, leaf, _ in sorted(groups[n], key=lambda x: x[:3])]) for n in names}
    root, upper = plain_tree([trees[n][0] for n in names])
    out = []
    for n, above in zip(names, upper):
        for (_, _, leaf, doc_id), way in zip(sorted(groups[n], key=lambda x: x[:3]), trees[n][1]):
            out.append((doc_id, leaf, trees[n][0], root, tuple(way + above)))
    return out


def manifest_of(docs, changed=None):
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    return merkle.build_manifest(docs, merkle.leaf_digest(*columns), changed)


def listed(rows):
    return sorted(((r.row_id, r.leaf, r.subroot, r.root, tuple(map(tuple, r.siblings))) for r in rows), key=str)


def test_proofs_agree_with_plain_trees(spark):
    docs = clashing(spark.createDataFrame(odd_rows(), DOCS)).repartition(5)
    got = merkle.proofs(manifest_of(docs), with_siblings=True).collect()
    assert listed(got) == sorted(plain_proofs(odd_rows()), key=str)
    assert all(r.verified and r.folded_root == r.root for r in got)
    for r in got:
        assert r.proof_sha256 == sha256("".join(a + b for a, b in r.siblings).encode()).hexdigest()


def test_proofs_over_several_written_levels(spark, monkeypatch):
    """With one level kept in place of three, small trees have several written levels, of groups and over groups."""
    monkeypatch.setattr(merkle, "LEVELS_KEPT", 1)
    monkeypatch.setattr(merkle, "SPAN", 16)
    rows = [(i, "t", "en", "hot", 1) for i in range(600)] + [(1000 + i, "t", "en", f"s{i % 40}", 1) for i in range(700)]
    manifest = manifest_of(spark.createDataFrame(rows, DOCS))
    assert len(manifest.levels) == 3 and len(manifest.top) == 2
    assert listed(merkle.proofs(manifest, with_siblings=True).collect()) == sorted(plain_proofs(rows), key=str)


def test_only_changed_leaves_fail(spark):
    docs = spark.createDataFrame(odd_rows(), DOCS)
    other = F.when(F.col("doc_id").isin(3, 104), F.sha2(F.lit("x"), 256))
    got = merkle.proofs(manifest_of(docs, other)).collect()
    assert {r.row_id for r in got if not r.verified} == {3, 104}
    assert len({r.root for r in got}) == 1 and len(got) == len(odd_rows())


def test_empty_and_single_manifests(spark):
    none = spark.createDataFrame([], DOCS)
    manifest = manifest_of(none)
    assert merkle.proofs(manifest).count() == 0 and manifest.root.count() == 0
    one = [(5, "only", "en", "s", 4)]
    row = merkle.proofs(manifest_of(spark.createDataFrame(one, DOCS)), with_siblings=True).first()
    assert row.leaf == row.subroot == row.root == plain_leaf(one[0]) and row.siblings == [] and row.verified


# Packing


@pytest.fixture(scope="module")
def tokenizer_file():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def assert_packed(pieces, texts, tokenizer_file, window=4096, padding=0):
    """Every token of each row in one piece, sequences without gaps and with little padding; rows are told apart by ids."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    wanted = sorted(bytes(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")) for t in texts)
    by_sequence, whole = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0 and p.ids_crc32 == zlib.crc32(p.ids)
        by_sequence[p.sequence_id].append((p.offset, p.length))
        whole[p.row_id].append((p.start, bytes(p.ids), p.doc_tokens))
    padded = 0
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        padded += 0 if end & (end - 1) == 0 else window - end
    assert padded <= padding
    got = []
    for parts in whole.values():
        # Rows that share an id also share each start; these tests give them one text.
        copies = sum(start == 0 for start, _, _ in parts)
        lines = [[] for _ in range(copies)]
        for start, ids, n in sorted(parts, key=lambda p: p[0]):
            line = next(x for x in lines if sum(map(len, x)) == 4 * start)
            line.append(ids)
            assert n * 4 >= sum(map(len, line))
        got += [b"".join(x) for x in lines]
    assert sorted(got) == wanted


def test_packs_whole_texts(spark, tokenizer_file):
    rows = [(i, t) for i, t in enumerate([
        None, "", " \n ", "word " * 5000, "don't I'LL <|endoftext|> x<|startoftext|>y", "é é ΣΑΣ İ ﬁ 全角　１２", "a" * 200_000,
        "-".join(map(str, range(3000)))])]
    rng = random.Random(3)
    rows += [(100 + i, " ".join(rng.choice(["alpha", "beta", "Gamma,"]) for _ in range(rng.randint(0, 900)))) for i in range(300)]
    rows += [(100, rows[8][1])] * 3 + [(None, "null id")]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string")).repartition(4)
    pieces = packing.packed(docs, tokenizer_file, 2, with_ids=True).collect()
    assert_packed(pieces, [t for _, t in rows], tokenizer_file)


def test_packing_of_nothing_and_little(spark, tokenizer_file):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.packed(docs, tokenizer_file, 2).count() == 0
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    pieces = packing.packed(docs, tokenizer_file, 2, window=8, with_ids=True).collect()
    assert_packed(pieces, ["one two three"], tokenizer_file, window=8)
    with pytest.raises(ValueError, match="power of two"):
        packing.packed(docs, tokenizer_file, 2, window=100)


def test_packing_query(spark, small, tokenizer_file):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet")
    full = packing.packed(docs, tokenizer_file, 2, with_ids=True)
    assert_packed(full.collect(), texts.values(), tokenizer_file)
    got = QUERIES["op13_packing"](spark, small)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.drop("ids").collect()))


def place_all(plan):
    """{sequence: [(offset, length)]} and the pieces of each (rest, rank)."""
    sequences, pieces = defaultdict(list), defaultdict(list)
    for i in range(len(plan.rest)):
        for k in range(int(plan.number[i])):
            block = int(plan.block[i]) + k
            per = int(plan.per[i])
            sequences[int(plan.sequence[i]) + block // per].append((block % per * int(plan.size[i]) + int(plan.offset[i]), int(plan.length[i])))
            pieces[int(plan.rest[i]), int(plan.rank[i]) + k].append((int(plan.start[i]), int(plan.length[i])))
    return sequences, pieces


@pytest.mark.parametrize("seed", range(12))
def test_plans_place_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    window = int(2 ** rng.integers(1, 13))
    kinds = [rng.integers(1, window, 800), np.minimum(rng.geometric(0.02, 1500), window - 1), np.full(999, max(1, window * 3 // 4)), np.ones(50, int)]
    counts = np.bincount(kinds[seed % 4], minlength=window)
    plan = packing.pack_plan(counts, window)
    sequences, pieces = place_all(plan)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window and end & (end - 1) == 0
    assert sorted(sequences) == list(range(plan.sequences))
    assert sorted(pieces) == [(n, k) for n in range(1, window) for k in range(counts[n])]
    for (rest, _), cuts in pieces.items():
        end = 0
        for start, length in sorted(cuts):
            assert start == end
            end += length
        assert end == rest


def test_plan_size_depends_on_the_window_alone():
    rng = np.random.default_rng(0)
    counts = np.bincount(np.clip(rng.lognormal(6.3, 0.9, 200_000).astype(int), 1, 4095), minlength=4096)
    small, large = packing.pack_plan(counts), packing.pack_plan(counts * 100_000)
    tokens = (counts * np.arange(4096)).sum()
    assert len(large.rest) < 200_000 and len(small.rest) < 200_000
    assert (large.number * large.length).sum() == tokens * 100_000
    # Hardly any sequence over the least possible number; few documents are cut.
    assert large.sequences <= tokens * 100_000 // 4096 + 16
    assert small.number[small.start > 0].sum() < 0.1 * counts.sum()


def test_repeat_counts_fit_a_histogram_that_combinations_make():
    blocks, lengths = packing.combinations(64)
    assert (lengths.sum(1) == blocks).all() and len({tuple(x) for x in np.c_[blocks, lengths].tolist()}) == len(lengths)
    rng = np.random.default_rng(1)
    counts = np.zeros(65, np.int64)
    for row in lengths[rng.choice(len(lengths), 20, replace=False)]:
        for n in row[row > 0]:
            counts[n] += 50
    x = packing.repeat_counts(lengths, counts, rounds=5000)
    met = np.zeros(65)
    np.add.at(met, lengths.ravel(), np.repeat(x, 3))
    assert (x >= 0).all() and np.abs(met - counts)[1:].max() < 0.5


# Periodic runs


def collapsed(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("seed", range(8))
def test_groups_and_runs_of_random_words(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(150):
        k, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 70)
        words = [rng.randrange(k) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            a, p = rng.randrange(n - 4), rng.randint(1, 6)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append([b"%d" % w for w in words])
        if words:
            dense = np.unique(words, return_inverse=True)[1]
            group, length = periodic_runs.lyndon_groups(dense)
            wanted = brute.lyndon_lengths(dense.tolist())
            assert length.tolist() == wanted
            shared = {}
            for i, g in enumerate(group.tolist()):
                word = tuple(dense[i:i + wanted[i]].tolist())
                assert shared.setdefault(g, word) == word
            assert len(set(shared.values())) == len(shared)
    assert periodic_runs.runs_of_texts(texts) == [brute.periodic_runs(t) for t in texts]
    assert periodic_runs.runs_of_texts(texts, 9, 3) == [brute.periodic_runs(t, 9, 3) for t in texts]


def test_runs_of_odd_rows(spark):
    rows = odd_rows() + [(300, "go " * 6, "en", "s", 1), (301, "go " * 5, "en", "s", 1), (302, "a b " * 4, "en", "s", 1), (303, "a b " * 3 + "a", "en", "s", 1),
                         (304, "a a a a a a b b b b b b", "en", "s", 1), (305, "x y " * 8, "en", "s", 1)]
    docs = clashing(spark.createDataFrame(rows, DOCS))
    got = sorted((str(r.row_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs.periodic_runs(docs).collect())
    wanted = []
    for row in rows:
        words = (row[1] or "").encode().split()
        if len(words) > 10_000:
            runs = [(0, 600_000, 10)]
        else:
            runs = brute.periodic_runs(words)
        wanted.append((str(row[0]), len(words), runs, collapsed(words, runs).decode()))
    assert got == sorted(wanted)
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_hard_texts_take_near_linear_time():
    n = 60_000
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    for symbols in (np.zeros(n, np.int64), np.arange(n) % 2, np.arange(n), np.arange(n)[::-1].copy(), np.array(b[:n])):
        for _, length, period in periodic_runs.runs_of(symbols):
            assert length >= max(6, 4 * period)


def test_periodic_query(spark, small):
    texts = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    wanted = {}
    for doc_id, text in texts:
        words = loop_words(doc_id, (text or "").encode().split())
        runs = brute.periodic_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        digest = sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
        head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        wanted[doc_id] = (len(runs), *head, digest, sha256(collapsed(words, runs)).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, small).collect()}
    assert got == wanted and sum(x[0] > 0 for x in got.values()) >= 10

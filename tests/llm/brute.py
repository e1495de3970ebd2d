"""Plain Python answers to hold the operators against; for small tables only."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np


def smallest_reachable(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def shingle_sets(rows, size=5):
    out = {}
    for row_id, text in rows:
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        out[row_id] = {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set()
    return out


def jaccard_components(rows):
    """{id: (set size, smallest reachable id)}; compares every pair that shares a shingle."""
    sets = shingle_sets(rows)
    lists = defaultdict(list)
    for row_id, grams in sets.items():
        for gram in grams:
            lists[gram].append(row_id)
    shared = defaultdict(int)
    for ids in lists.values():
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                shared[a, b] += 1
    edges = [(a, b) for (a, b), n in shared.items() if 4 * n >= 3 * (len(sets[a]) + len(sets[b]) - n)]
    label = smallest_reachable(sets, edges)
    return {i: (len(sets[i]), label[i]) for i in sets}


WORD10 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def without_repeats(rows, length=50):
    """{id: (bytes, removed, spans, kept)}; ids are unique."""
    first = {}
    texts = {i: (t or "").encode() for i, t in rows}
    for i, text in texts.items():
        for at in range(len(text) - length + 1):
            run = text[at:at + length]
            if first.get(run, i) >= i:
                first[run] = i
    out = {}
    for i, text in texts.items():
        gone = bytearray(len(text))
        for at in range(len(text) - length + 1):
            if first[text[at:at + length]] < i:
                gone[at:at + length] = b"\1" * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(text), sum(gone), spans, bytes(b for b, g in zip(text, gone) if not g))
    return out


def contamination(rows, items, window=10):
    """{id: (words, hit words, sorted item ids, any hit)}."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def words(text):
        return WORD10.findall((text or "").translate(lower))
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = {}
    for i, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for a in range(len(w) - n + 1):
                owners = windows.get(tuple(w[a:a + n]))
                if owners:
                    hit.update(range(a, a + n))
                    found |= owners
        out[i] = (len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None)), bool(hit))
    return out


def edit_distance(a, b):
    while a and b and a[0] == b[0]:
        k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        a, b = a[k:], b[k:]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def close_pairs(pairs):
    """The (a, b) of (a, b, most) with an edit distance of at most ``most``."""
    import duckdb
    import pyarrow as pa

    if not pairs:
        return []
    pairs_table = pa.table({c: [p[i] for p in pairs] for i, c in enumerate("abm")})  # noqa: F841
    return duckdb.connect().sql("select a, b from pairs_table where levenshtein(a, b) <= m").fetchall()


def dropped_lines(rows):
    """{id: (lines with a word, numbers of dropped ones)}; compares every pair of distinct lines."""
    import regex
    lines = []
    for i, text in rows:
        for at, line in enumerate((text or "").split("\n")):
            value = regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")
            if value:
                lines.append((i, at, value))
    values = sorted({v for _, _, v in lines}, key=lambda v: (len(v), v))
    counts = [Counter(v) for v in values]
    pairs = []
    for k, a in enumerate(values):
        for j in range(k + 1, len(values)):
            b = values[j]
            most = int(0.1 * len(b) + 1e-9)
            if len(b) - len(a) > most:
                break
            # Letters that one has and the other lacks need an edit each.
            if sum((counts[j] - counts[k]).values()) <= most:
                pairs.append((a, b, most))
    edges = close_pairs(pairs)
    label = smallest_reachable(values, edges)
    first, out = {}, {}
    for i, at, v in sorted(lines):
        n, gone = out.setdefault(i, (0, []))
        if first.setdefault(label[v], (i, at)) != (i, at):
            gone.append(at)
        out[i] = (n + 1, gone)
    return out


def lyndon_lengths(symbols):
    """Length of the longest Lyndon word at each place: up to the next smaller suffix."""
    out = []
    for i in range(len(symbols)):
        j = i + 1
        while j < len(symbols) and symbols[i:] < symbols[j:]:
            j += 1
        out.append(j - i)
    return out


def periodic_runs(words, shortest=6, copies=4):
    """(start, length, period) of all runs, by trying every period."""
    found = {}
    for p in range(1, len(words) // copies + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(shortest, copies * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def discriminant_scores(learned, x, pooled, diagonal):
    """Probability of label 1 by Bayes' rule over two normal densities, from inverses and determinants.

    ``learned`` has the rows of label 0 and of label 1.
    """
    total = sum(map(len, learned))
    spread = [np.cov(rows, rowvar=False, bias=True) for rows in learned]
    joint = sum(len(rows) / total * c for rows, c in zip(learned, spread))
    logs = []
    for rows, c in zip(learned, spread):
        c = (1 - pooled) * c + pooled * joint
        c = (1 - diagonal) * c + diagonal * (np.trace(c) / len(c) + 1e-6) * np.eye(len(c))
        away = x - rows.mean(axis=0)
        mahalanobis = np.einsum("ij,jk,ik->i", away, np.linalg.inv(c), away)
        logs.append(np.log(len(rows) / total) - (mahalanobis + np.linalg.slogdet(c)[1]) / 2)
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -40, 40)))


def letter_grams(text, gram=3):
    """Counts of the n-grams of the lower-case letters, with one blank for every other run and at both ends."""
    text = (text or "").lower()
    if not any(c.isalpha() for c in text):
        return Counter()
    clean = " " + re.sub(" +", " ", "".join(c if c.isalpha() else " " for c in text)) + " "
    return Counter(clean[i:i + gram] for i in range(len(clean) - gram + 1))


def bundle(grams, letter, dimensions):
    """Sum of the n-gram vectors: product of the letters' vectors, each rotated by its distance from the end."""
    out = np.zeros(dimensions)
    for gram, n in grams.items():
        vector = np.ones(dimensions)
        for back, c in enumerate(reversed(gram)):
            vector = vector * np.roll(letter(ord(c)), back)
        out += n * vector
    return out


def languages(rows, letter, dimensions):
    """id -> (language or und, cosine) of rows (id, text, lang, learned from)."""
    bundles = {i: bundle(letter_grams(text), letter, dimensions) for i, text, _, _ in rows}
    sums = defaultdict(lambda: np.zeros(dimensions))
    for i, text, lang, learned in rows:
        if learned and text is not None and lang is not None:
            sums[lang] = sums[lang] + bundles[i]
    out = {}
    for i, text, _, _ in rows:
        if not letter_grams(text) or not sums:
            out[i] = ("und", 0.0)
            continue
        own = bundles[i] / np.linalg.norm(bundles[i])
        cosines = {lang: float(own @ total / max(np.linalg.norm(total), 1e-12)) for lang, total in sums.items()}
        best = max(sorted(cosines), key=cosines.get)
        out[i] = (best, min(1.0, max(0.0, cosines[best])))
    return out

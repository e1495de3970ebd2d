"""Periodic runs of words: Lyndon groups under both orders, roots extended into runs.

A run is a stretch of consecutive words with smallest period q that no neighbour
extends keeping it.  Every run has a Lyndon root: under one of the two orders of
the words (ascending, descending), the longest Lyndon word that starts at a
root's place is the root itself.

`lyndon_groups` gives these words for all places at once.  It is the first phase
of suffix sorting by groups: places are grouped by the Lyndon word known so far,
first by single words; from the highest group down, each place of the group
looks for the nearest earlier place in a lower group, whose Lyndon word the
group's continues.  At the end, places with the same longest Lyndon word share a
group, so no suffix is ever ordered.  A root that follows itself (same group one
period on) is extended to both sides by the longest common extension.

Only runs of at least `COPIES` periods and `SHORTEST` words are reported, so a
root must be followed by itself.  Each word of such a run occurs in it as often
as there are periods, so a text is first cut at the words that are too rare in
it, then the stretches between at those too rare in them, until all words of a
stretch are frequent (`stretches`).  No run crosses such a word; the groups are
made of what remains, and every run comes from them.

Nulls and texts without words have no runs and collapse to the empty text.  Rows
that repeat get the same result each.  Runs of one length are told apart by
start, then period.  An empty table gives no rows.  Only the two named columns
are read, so others may have any name.  Texts are worked on whole, in time close
to linear in their words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need
from lectern.llm.words import byte_texts

SHORTEST, COPIES = 6, 4

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def lyndon_groups(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, length) of the longest Lyndon word starting at each place.

    ``symbols`` are numbers from 0 without gaps.  Groups are numbered by the
    slots they fill when all places are in order, so a group that is split stays
    between its neighbours.
    """
    n = len(symbols)
    counts = np.bincount(symbols)
    starts = np.cumsum(counts) - counts
    order = np.argsort(symbols, kind="stable").tolist()
    group = starts[symbols].tolist()
    size, length, ending, members = [0] * n, [1] * n, [0] * (n + 1), [None] * n
    for at, many in zip(starts.tolist(), counts.tolist(), strict=True):
        size[at], ending[at + many], members[at] = many, at, order[at:at + many]
    lower = [-1] * n
    high = n
    while high:
        own = ending[high]
        high = own
        # The nearest earlier places in lower groups, with the number of copies that follow each.
        last, copies, found = -1, 0, []
        for place in members[own]:
            if group[place] != own:
                continue  # has moved on
            before = place - 1
            while before >= 0 and group[before] >= own:
                before = lower[before]
            lower[place] = before
            if before == last:
                copies += 1
            else:
                if last >= 0:
                    found.append((group[last], copies, last))
                last, copies = before, 1
        if last >= 0:
            found.append((group[last], copies, last))
        if not found:
            continue
        unit = length[own]
        if len(found) == 1:
            old, copies, place = found[0]
            moved = {old: {copies: [place]}}
        else:
            moved = {}
            for old, copies, place in found:
                moved.setdefault(old, {}).setdefault(copies, []).append(place)
        for old, by_copies in moved.items():
            end, base = old + size[old], length[old]
            # More copies come higher; all of them come above the places that stay.
            for copies in sorted(by_copies, reverse=True):
                places = by_copies[copies]
                start = end - len(places)
                for place in places:
                    group[place] = start
                size[start], length[start], ending[end], members[start] = len(places), base + copies * unit, start, places
                end = start
            if end > old:
                size[old], ending[end] = end - old, old
    group = np.array(group, np.int64)
    return group, np.array(length, np.int64)[group]


def _alike(symbols: np.ndarray, a: int, b: int, step: int) -> int:
    """Longest common extension of places a < b, rightwards for step 1, leftwards for -1."""
    most = len(symbols) - b if step > 0 else a + 1
    done, size = 0, 16
    while done < most:
        size = min(size, most - done)
        if step > 0:
            same = symbols[a + done:a + done + size] == symbols[b + done:b + done + size]
        else:
            same = (symbols[a - done - size + 1:a - done + 1] == symbols[b - done - size + 1:b - done + 1])[::-1]
        if not same.all():
            return done + int(np.argmin(same))
        done += size
        size *= 2
    return done


def runs_of(symbols: np.ndarray, shortest: int = SHORTEST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period; ``copies`` is 3 at least."""
    n = len(symbols)
    found = set()
    if n < shortest:
        return []
    for ordered in (symbols, symbols.max() - symbols):
        group, period = lyndon_groups(ordered)
        place = np.arange(n)
        after = place + period
        inside = after < n
        follows = np.zeros(n, bool)
        follows[inside] = group[after[inside]] == group[inside]
        # The first root of each chain: the one before is another word.
        before = place - period
        chained = np.zeros(n, bool)
        back = before >= 0
        chained[back] = group[before[back]] == group[back]
        for i in np.flatnonzero(follows & ~chained).tolist():
            p = int(period[i])
            left = _alike(symbols, i - 1, i + p - 1, -1) if i else 0
            length = left + p + _alike(symbols, i, i + p, 1)
            if length >= max(shortest, copies * p):
                found.add((i - left, length, p))
    return sorted(found, key=lambda run: (run[0], run[2]))


def stretches(symbols: np.ndarray, owner: np.ndarray, shortest: int, copies: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of the longest stretches of one owner in which each symbol occurs ``copies`` times or more."""
    place, part = np.arange(len(symbols)), owner
    while len(place):
        where, counts = np.unique(part * (symbols.max() + 1) + symbols[place], return_inverse=True, return_counts=True)[1:]
        often = counts[where] >= copies
        if often.all():
            break
        place, part = place[often], part[often]
        part = np.cumsum(np.r_[True, (np.diff(place) > 1) | (np.diff(part) != 0)]) - 1 if len(place) else part
        long = np.bincount(part)[part] >= shortest if len(place) else often[:0]
        place, part = place[long], part[long]
    if len(place):
        first = np.flatnonzero(np.r_[True, np.diff(part) != 0])
        yield from zip(place[first].tolist(), (place[np.r_[first[1:] - 1, len(place) - 1]] + 1).tolist(), strict=True)


def runs_of_texts(texts: list[list[bytes]], shortest: int = SHORTEST, copies: int = COPIES) -> list[list[tuple[int, int, int]]]:
    """The runs of each list of words."""
    known: dict[bytes, int] = {}
    symbols = np.array([known.setdefault(w, len(known)) for words in texts for w in words], np.int64)
    sizes = np.array([len(words) for words in texts], np.int64)
    begins = np.cumsum(sizes) - sizes
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for begin, end in stretches(symbols, np.repeat(np.arange(len(texts)), sizes), shortest, copies):
        text = int(np.searchsorted(begins, begin, "right")) - 1
        at = begin - int(begins[text])
        dense = np.unique(symbols[begin:end], return_inverse=True)[1]
        out[text] += [(at + start, length, period) for start, length, period in runs_of(dense, shortest, copies)]
    return out


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Rewrite | None = None,
    shortest: int = SHORTEST,
    copies: int = COPIES,
) -> DataFrame:
    """row_id, n_words, runs and the collapsed text of every row.

    Words are what stands between ASCII blanks.  ``runs`` has start (word from
    0), length and period, by start, then period.  The collapsed text leaves out
    every word that a run has after its first period, and joins the others by
    one blank.  ``rewrite``, if given, makes the words to look at from row id and
    words.
    """
    need(docs, [id_col, text_col])
    if copies < 3:
        raise ValueError("a run needs three copies at least for its root to follow itself")
    out = pa.schema([("row_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                ids, rows = some.column(0).to_pylist(), []
                texts = [(text or b"").split() for text in byte_texts(some.column(1))]
                if rewrite is not None:
                    texts = [rewrite(row_id, words) for row_id, words in zip(ids, texts, strict=True)]
                for row_id, words, runs in zip(ids, texts, runs_of_texts(texts, shortest, copies), strict=True):
                    kept = words
                    if runs:
                        keep = np.ones(len(words), bool)
                        for start, length, period in runs:
                            keep[start + period:start + length] = False
                        kept = [words[i] for i in np.flatnonzero(keep).tolist()]
                    rows.append((
                        row_id, len(words), [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs],
                        b" ".join(kept).decode()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), out.types, strict=True)], schema=out)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        find, "row_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")

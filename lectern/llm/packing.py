"""Packing documents into sequences: least squares over shallow combinations of lengths.

A document is its tokens and an end token.  Whole windows of it are sequences of
their own; the rest is a piece of 1 to window - 1 tokens.  What follows looks at
the histogram of these lengths alone, which has fewer bins than a window has
tokens, however many documents there are:

1. *Combinations* of at most three lengths that fill a block exactly are listed
   (`combinations`).  Blocks are the window and its halves, quarters and so on,
   since blocks of one size stack into windows without a gap; three short
   lengths could not fill a whole window.  Triples are listed up to
   `TRIPLES_UP_TO`, where short pieces meet, pairs for all blocks.
2. *Non-negative least squares* (`repeat_counts`) finds how often each is to be
   used so that the histogram is met, and the counts are rounded down to what
   the histogram holds and to whole windows of blocks.
3. *The residual* is packed greedily (`_Pieces`, `greedy`): longest first, what
   does not fit last is cut, and the remainder goes on as a piece.  One step
   repeats its pattern for as many sequences as its lengths allow.  The last
   piece of all is cut at powers of two, so no sequence has padding.

The result is a table of runs: the pieces of one length from rank a to b go to
consecutive blocks at one offset.  It is bounded by the window, so each task has
it and places its documents by their ranks; ranks come from counts by (task,
length).  Documents meet in no shuffle but the join with those counts.

Null and empty texts are the end token alone.  Rows that repeat are packed each.
An empty table gives no pieces.  Only the two named columns are read, so others
may have any name.  A text of any length is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored
from lectern.llm.words import byte_texts

WINDOW = 4096
#: Largest block that is filled by triples.
TRIPLES_UP_TO = 512
SOLVER_ROUNDS = 400
#: Rows and bytes of texts that are encoded in one step; a longer text is a step of its own.
STEP_ROWS, STEP_BYTES = 1000, 4_000_000
#: Bytes of chunks that are remembered from batch to batch.
REMEMBERED = 3_000_000

#: Fresh words that are encoded as one text, and the stops that may follow a word.
TOGETHER, STOPS = 64, "!#$%&()*+,-./:;=?@_{|}~"

_RANK_BITS = 37


class TextEncoder:
    """Token ids of texts by the library, chunk by chunk where that is the same.

    It is the same if the tokenizer drops white space and joins nothing across
    it: then a text is the sequence of its chunks between blanks, and chunks that
    occur often are encoded once.  Any other tokenizer gets whole texts.

    Where each word's last token is marked as such, new words of letters alone
    are handed over as one text and told apart by these marks; stops after a
    word are a chunk of their own.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        parts = json.loads(self.tokenizer.to_str())
        self.by_chunk = self._drops_blanks(parts)
        mark = parts["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if mark:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    @staticmethod
    def _drops_blanks(parts: dict) -> bool:
        normalizer = parts.get("normalizer") or {}
        steps = normalizer.get("normalizers", [normalizer])
        splitter = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        pattern = splitter.get("pattern", {}).get("Regex", "")
        return (
            {s.get("type") for s in steps} <= {"NFC", "Replace", "Lowercase"}
            and all(s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps if s.get("type") == "Replace")
            and splitter.get("type") == "Split" and splitter.get("behavior") == "Removed" and splitter.get("invert") is True
            and pattern.endswith(r"[^\s\p{L}\p{N}]+") and "(?" not in pattern
            and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["normalized"] or t["single_word"]
                        for t in parts.get("added_tokens", [])))

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in encoded]

    def _words(self, words: list[str]) -> Iterator[bytes]:
        """The ids of each of these words of letters."""
        if not self.ends.any():
            yield from (ids.tobytes() for ids in self._ids(words))
            return
        groups = [words[i:i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        for group, ids in zip(groups, self._ids([" ".join(g) for g in groups]), strict=True):
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) == len(group):
                data, stops = ids.tobytes(), (4 * last).tolist()
                yield from (data[a:b] for a, b in zip([0, *stops], stops))
            else:  # the library sees other characters than letters
                yield from (own.tobytes() for own in self._ids(group))

    def _learn(self, chunks: list[bytes]) -> None:
        """Note the ids of chunks that are not known yet."""
        texts = b"\n".join(chunks).decode("utf-8", "replace").split("\n")
        letters = list(map(str.isalpha, texts))
        self.known.update(zip(compress(chunks, letters), self._words(list(compress(texts, letters)))))
        others, stopped, stems = [], [], {}
        for chunk, text in compress(zip(chunks, texts), [not x for x in letters]):
            stem = text.rstrip(STOPS)
            if stem.isalpha():
                cut = len(stem) - len(text)  # stops are single bytes
                stopped.append((chunk, cut))
                if chunk[:cut] not in self.known:
                    stems[chunk[:cut]] = stem
                if chunk[cut:] not in self.known:
                    self.known[chunk[cut:]] = self._ids([text[cut:]])[0].tobytes()
            else:
                others.append((chunk, text))
        self.known.update(zip(stems, self._words(list(stems.values()))))
        for chunk, cut in stopped:
            self.known[chunk] = self.known[chunk[:cut]] + self.known[chunk[cut:]]
        for (chunk, _), ids in zip(others, self._ids([t for _, t in others]), strict=True):
            self.known[chunk] = ids.tobytes()
        self.held += sum(map(len, chunks))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, 32-bit little endian."""
        if not self.by_chunk:
            return [ids.tobytes() for ids in self._ids([t.decode("utf-8", "replace") for t in texts])]
        split = [t.split() for t in texts]
        used = set().union(*split)
        fresh = list(used.difference(self.known))
        if fresh:
            self._learn(fresh)
        out = [b"".join(map(self.known.__getitem__, chunks)) for chunks in split]
        if self.held > REMEMBERED:
            # What has just been used is likely to come again.
            self.known = {chunk: self.known[chunk] for chunk in used}
            self.held = 0
        return out


def combinations(window: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, lengths): every listed combination, lengths padded with 0 to three."""
    blocks, rows = [], []
    block = window
    while block:
        first = np.arange(1, block // 2 + 1)
        pairs = np.stack([block - first, first, np.zeros_like(first)], 1)
        found = [np.array([[block, 0, 0]]), pairs]
        if block <= TRIPLES_UP_TO:
            small, middle = np.meshgrid(first, first, indexing="ij")
            large = block - small - middle
            fits = (small <= middle) & (middle <= large)
            found.append(np.stack([large[fits], middle[fits], small[fits]], 1))
        rows += found
        blocks.append(np.full(sum(map(len, found)), block))
        block //= 2
    return np.concatenate(blocks), np.concatenate(rows)


def repeat_counts(lengths: np.ndarray, counts: np.ndarray, rounds: int = SOLVER_ROUNDS) -> np.ndarray:
    """How often to use each combination: min |A x - counts| over x >= 0.

    Accelerated projected gradients; only combinations of lengths that occur
    take part.  ``counts[n]`` is the number of pieces of length n.
    """
    held = counts.astype(float)
    usable = np.flatnonzero(np.where(lengths > 0, counts[lengths] > 0, True).all(1))
    used = lengths[usable]
    x = np.zeros(len(lengths))
    if not len(usable):
        return x
    flat = used.T.ravel()

    def met(y: np.ndarray) -> np.ndarray:
        out = np.bincount(flat, np.tile(y, 3), len(held))
        out[0] = 0
        return out

    # The norm of A by a few power steps sets the step length.
    v = np.ones(len(usable))
    for _ in range(20):
        v = met(v)[used].sum(1)
        norm = np.linalg.norm(v)
        v /= norm
    step = 0.95 / norm
    current = previous = np.zeros(len(usable))
    t = 1.0
    for _ in range(rounds):
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = current + (t - 1) / after * (current - previous)
        gap = met(ahead) - held
        gap[0] = 0
        previous, current, t = current, np.maximum(ahead - step * gap[used].sum(1), 0), after
    x[usable] = current
    return x


@dataclass
class Plan:
    """Runs of pieces; each field is one array over the runs.

    Pieces of ``length`` tokens, whose document rests have ``rest`` tokens and
    ranks ``rank`` to ``rank + number``, begin at token ``start`` of the rest.
    Piece k of the run is block ``block + k``; ``per`` blocks of a size make a
    sequence, numbered from ``sequence``, and the piece lies at ``offset`` in its block.
    """

    rest: np.ndarray
    rank: np.ndarray
    number: np.ndarray
    start: np.ndarray
    length: np.ndarray
    block: np.ndarray
    per: np.ndarray
    size: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def finder(self) -> np.ndarray:
        """Sort keys of the runs, by which `place` looks them up."""
        return _run_key(self.rest, self.start, self.rank)


def _run_key(rest: np.ndarray, start: np.ndarray, rank: np.ndarray) -> np.ndarray:
    return (rest.astype(np.int64) * (WINDOW + 1) + start) << _RANK_BITS | rank


class _Pieces:
    """The pieces that are not placed yet, as runs of ranks by their length."""

    def __init__(self, counts: np.ndarray) -> None:
        self.left = counts.astype(np.int64)
        self.runs: dict[int, deque] = {n: deque([(n, 0, int(counts[n]), 0)]) for n in np.flatnonzero(counts).tolist()}
        self.placed: list[tuple] = []

    def take(self, length: int, number: int) -> Iterator[tuple[int, int, int, int]]:
        """(rest, first rank, number, start in the rest) of the next ``number`` pieces."""
        self.left[length] -= number
        runs = self.runs[length]
        while number:
            rest, rank, held, start = runs.popleft()
            if held > number:
                runs.appendleft((rest, rank + number, held - number, start))
                held = number
            yield rest, rank, held, start
            number -= held

    def place(self, length: int, number: int, block: int, per: int, size: int, sequence: int, offset: int, keep: int = 0) -> None:
        """Put pieces of ``length`` at ``offset`` of blocks from ``block`` on; cut ``keep`` tokens off first, if given."""
        put = keep or length
        for rest, rank, held, start in self.take(length, number):
            self.placed.append((rest, rank, held, start, put, block, per, size, sequence, offset))
            block += held
            if keep:
                self.left[length - keep] += held
                self.runs.setdefault(length - keep, deque()).append((rest, rank, held, start + keep))


def _use_combinations(pieces: _Pieces, window: int, sequence: int) -> int:
    """Place the rounded repeat counts; returns the next free sequence number."""
    blocks, lengths = combinations(window)
    rests = lengths.max(1) < window  # a whole window is no rest
    blocks, lengths = blocks[rests], lengths[rests]
    wanted = np.floor(repeat_counts(lengths, pieces.left) + 1e-6).astype(np.int64)
    order = np.flatnonzero(wanted)
    order = order[np.argsort(-wanted[order], kind="stable")]
    free = pieces.left.copy()
    chosen: dict[int, list[list]] = {}
    for at in order.tolist():
        parts = [n for n in lengths[at].tolist() if n]
        number = min(int(wanted[at]), *(int(free[n]) // parts.count(n) for n in set(parts)))
        if number:
            for n in parts:
                free[n] -= number
            chosen.setdefault(int(blocks[at]), []).append([parts, number])
    for size, rows in chosen.items():
        per = window // size
        spare = sum(number for _, number in rows) % per
        # Blocks that do not fill a last window go back, from the rarest combinations.
        for row in reversed(rows):
            back = min(spare, row[1])
            row[1] -= back
            spare -= back
        block = 0
        for parts, number in rows:
            offset = 0
            for n in parts:
                if number:
                    pieces.place(n, number, block, per, size, sequence, offset)
                offset += n
            block += number
        sequence += block // per
    return sequence


def greedy(pieces: _Pieces, window: int, sequence: int) -> int:
    """Fill windows from what is left, longest first; a last piece too long is cut.

    Patterns of lengths with many pieces go first, so that one step makes many
    sequences; the number of steps so depends on the window, not on the pieces.
    """
    while pieces.left.any():
        tier = 1 << (int(pieces.left.max()).bit_length() - 1)
        while tier:
            enough = pieces.left >= tier
            space, pattern, cut = window, [], 0
            used = np.zeros_like(pieces.left)
            while space:
                open_ = np.flatnonzero(enough[:space + 1] & (pieces.left[:space + 1] >= used[:space + 1] + tier))
                if not len(open_):
                    break
                n = int(open_[-1])
                times = min(space // n, int(pieces.left[n]) // tier - int(used[n]) // tier)
                pattern.append((n, times))
                used[n] += times * tier
                space -= n * times
            if space:
                longer = np.flatnonzero(pieces.left[space + 1:] >= used[space + 1:] + tier)
                if len(longer):
                    # The length with the most pieces: its remainders stay many.
                    over = longer + space + 1
                    cut = int(over[np.argmax(pieces.left[over])])
                elif tier > 1:
                    tier >>= 1
                    continue
            if not pattern and not cut:
                break
            number = tier
            offset = 0
            if space and not cut:
                sequence = _last(pieces, pattern, sequence)
                break
            for n, times in pattern:
                for _ in range(times):
                    pieces.place(n, number, 0, 1, window, sequence, offset)
                    offset += n
            if cut:
                pieces.place(cut, number, 0, 1, window, sequence, offset, keep=space)
            sequence += number
    return sequence


def _last(pieces: _Pieces, pattern: list[tuple[int, int]], sequence: int) -> int:
    """Lay the last pieces, less than a window, into sequences of powers of two."""
    line = [n for n, times in pattern for _ in range(times)]
    total = sum(line)
    while total:
        size = 1 << (total.bit_length() - 1)
        offset = 0
        while offset < size:
            n = line.pop(0)
            put = min(n, size - offset)
            pieces.place(n, 1, 0, 1, size, sequence, offset, keep=put if put < n else 0)
            if put < n:
                line.insert(0, n - put)
            offset += put
        total -= size
        sequence += 1
    return sequence


def pack_plan(counts: np.ndarray, window: int = WINDOW, sequence: int = 0) -> Plan:
    """The runs of pieces for a histogram of rests (``counts[n]`` of n tokens, n < window)."""
    pieces = _Pieces(counts)
    if counts.max(initial=0) >> _RANK_BITS:
        raise ValueError("too many documents of one length")
    sequence = greedy(pieces, window, _use_combinations(pieces, window, sequence))
    rows = np.array(pieces.placed, np.int64).reshape(-1, 10)
    rows = rows[np.argsort(_run_key(rows[:, 0], rows[:, 3], rows[:, 1]))]
    return Plan(*rows.T.copy(), sequence)


def _steps(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of bounded number and size."""
    begin, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if i > begin and (i - begin == STEP_ROWS or held + (size or 0) > STEP_BYTES):
            yield begin, i
            begin, held = i, 0
        held += size or 0
    if len(texts) > begin:
        yield begin, len(texts)


def _encoded(docs: DataFrame, tokenizer_file: str, end_id: int, window: int, id_col: str, text_col: str) -> DataFrame:
    """row_id, n, ids (32-bit little endian), rest, part and the ranks in it, for every row."""
    out = pa.schema([
        ("row_id", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("rest", pa.int32()), ("part", pa.int32()),
        ("full_at", pa.int64()), ("rest_at", pa.int64())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TextEncoder(tokenizer_file)
        end = end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        full, seen = 0, np.zeros(window, np.int64)
        for batch in batches:
            for begin, stop in _steps(batch.column(1)):
                some = batch.slice(begin, stop - begin)
                rows = []
                texts = [t or b"" for t in byte_texts(some.column(1))]
                for row_id, ids in zip(some.column(0).to_pylist(), encoder.encode(texts), strict=True):
                    ids += end
                    n = len(ids) // 4
                    rest = n % window
                    rows.append((row_id, n, ids, rest, part, full, int(seen[rest])))
                    full += n // window
                    seen[rest] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), out.types, strict=True)], schema=out)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        encode, "row_id long, n long, ids binary, rest int, part int, full_at long, rest_at long")


_PIECE = pa.schema([
    ("row_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def packed(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """row_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece; its ids too if asked for.

    ``window`` is a power of two of at most `WINDOW` tokens.  ``tokenizer_file``
    must be there on every executor.
    """
    need(docs, [id_col, text_col])
    if window & (window - 1) or not 1 < window <= WINDOW:
        raise ValueError(f"window is no power of two from 2 to {WINDOW}: {window}")
    tokens = stored(_encoded(docs, tokenizer_file, end_id, window, id_col, text_col), "tokens")
    counts = stored(tokens.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.floor(F.col("n") / window)).cast("long").alias("full")), "lengths")
    before = W.unboundedPreceding, -1
    # One row per task is ranked in one place.
    wholes = counts.groupBy("part").agg(F.sum("full").alias("full")).select(
        "part", F.coalesce(F.sum("full").over(W.orderBy("part").rowsBetween(*before)), F.lit(0)).alias("full_before"))
    offsets = counts.select(
        "part", "rest", F.coalesce(F.sum("rows").over(W.partitionBy("rest").orderBy("part").rowsBetween(*before)), F.lit(0))
        .alias("rest_before")).join(wholes, "part")
    histogram = np.zeros(window, np.int64)
    whole = 0
    for row in counts.groupBy("rest").agg(F.sum("rows").alias("rows"), F.sum("full").alias("full")).collect():
        histogram[row.rest] = row.rows
        whole += row.full
    histogram[0] = 0
    plan = pack_plan(histogram, window, whole)
    key = plan.finder()
    schema = _PIECE.append(pa.field("ids", pa.binary())) if with_ids else _PIECE

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                for row_id, n, ids, rest, full, rank in zip(*(c.to_pylist() for c in batch.slice(at, 200).columns), strict=True):
                    cuts = [(k * window, window, full + k, 0) for k in range(n // window)]
                    start = 0
                    while start < rest:
                        wanted = (rest * (WINDOW + 1) + start) << _RANK_BITS | rank
                        i = int(np.searchsorted(key, wanted, "right")) - 1
                        block = int(plan.block[i]) + rank - int(plan.rank[i])
                        per, length = int(plan.per[i]), int(plan.length[i])
                        cuts.append((n - rest + start, length, int(plan.sequence[i]) + block // per,
                                     block % per * int(plan.size[i]) + int(plan.offset[i])))
                        start += length
                    for begin, length, sequence, offset in cuts:
                        own = ids[4 * begin:4 * (begin + length)]
                        rows.append((row_id, begin, length, zlib.crc32(own), n, sequence, offset, *([own] if with_ids else [])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    ranked = tokens.join(offsets, ["part", "rest"]).select(
        "row_id", "n", "ids", "rest", F.col("full_at") + F.col("full_before"), F.col("rest_at") + F.col("rest_before"))
    return ranked.mapInArrow(
        place, "row_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
        + (", ids binary" if with_ids else ""))

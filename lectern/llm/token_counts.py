"""Token counts by rank-synchronous merging of ragged numpy arrays.

Texts are split into pieces that no merge can cross: white-space marks followed
by other characters.  Distinct pieces of a batch are laid end to end in one
array of symbols; each round finds, for every piece, its lowest-rank pair, and
all pieces merge theirs at the same time.  What is left is counted: one token
for a symbol of the vocabulary, one per UTF-8 byte for any other.

Null text is empty and has no tokens.  A piece of any length is merged whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need

MARK = "▁"
TOKEN_LIMIT = 4096
#: Pieces up to this many characters are remembered between batches.
REMEMBERED_LENGTH, REMEMBERED = 64, 400_000
#: Symbols merged together in one array.
AT_ONCE = 500_000


class PieceMerger:
    """Counts tokens of texts under a merge vocabulary with byte fallback."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces, scores = [], []
        for i in range(model.get_piece_size()):
            if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i)):
                pieces.append(model.id_to_piece(i))
                scores.append(model.get_score(i))
        # Symbols are numbered by rank: the best score first, ties share a rank.
        order = sorted(range(len(pieces)), key=lambda i: -scores[i])
        self.symbol = {pieces[i]: k for k, i in enumerate(order)}
        ranks = np.unique(-np.array([scores[i] for i in order]), return_inverse=True)[1]
        self.rank = np.append(ranks, np.iinfo(np.int64).max)
        self.none = len(pieces)  # the rank of a pair that does not merge
        pairs: dict[int, int] = {}
        for piece, k in self.symbol.items():
            for cut in range(1, len(piece)):
                a, b = self.symbol.get(piece[:cut]), self.symbol.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = k
        # Single characters that are no piece can still be the parts of none.
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys = keys
        self.pair_result = np.array([pairs[k] for k in keys.tolist()], np.int64)
        # Merging all places of a pair at once is safe if the new symbol starts no better merge.
        self.safe = np.ones(len(pieces) + 1, bool)
        for key, k in pairs.items():
            for part in (key >> 32, key & 0xFFFFFFFF):
                if ranks[k] <= ranks[part]:
                    self.safe[part] = False
        self.counts: dict[str, int] = {}

    def pair_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_result[at], self.none)

    def merge(self, pieces: list[str]) -> np.ndarray:
        """The number of tokens of each piece."""
        lengths = np.array([len(p) for p in pieces], np.int64)
        chars = np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32)
        codes, inverse = np.unique(chars, return_inverse=True)
        known = np.array([self.symbol.get(chr(c), -1) for c in codes.tolist()], np.int64)
        # A character outside the vocabulary gets a number of its own that merges with nothing.
        symbols = np.where(known >= 0, known, self.none + 1 + np.arange(len(codes)))[inverse]
        width = np.where(known >= 0, 1, [len(chr(c).encode()) for c in codes.tolist()])[inverse]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        out = np.zeros(len(pieces), np.int64)
        pair = np.full(len(symbols), self.none, np.int64)
        inside = owner[1:] == owner[:-1]
        pair[:-1][inside] = self.pair_of(symbols[:-1][inside], symbols[1:][inside])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = self.rank[pair]
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.r_[starts, len(symbols)])
            active = best < np.iinfo(np.int64).max
            done = np.repeat(~active, counts)
            if done.any():
                np.add.at(out, owner[done], width[done])
                keep = ~done
                symbols, width, owner, pair, rank = symbols[keep], width[keep], owner[keep], pair[keep], rank[keep]
                if not len(symbols):
                    break
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                counts = np.diff(np.r_[starts, len(symbols)])
                best = best[active]
            hit = np.flatnonzero(rank == np.repeat(best, counts))
            hit_piece = owner[hit]
            first = np.r_[True, hit_piece[1:] != hit_piece[:-1]]
            # Within a piece: all places of the first hit's pair that do not overlap, or just the first.
            first_at = np.maximum.accumulate(np.where(first, np.arange(len(hit)), 0))
            same = (pair[hit] == pair[hit[first_at]]) & (first | self.safe[pair[hit]])
            hit = hit[same]
            touching = np.r_[False, hit[1:] == hit[:-1] + 1]
            run_at = np.maximum.accumulate(np.where(touching, 0, np.arange(len(hit))))
            hit = hit[(np.arange(len(hit)) - run_at) % 2 == 0]
            symbols[hit] = pair[hit]
            gone = np.zeros(len(symbols), bool)
            gone[hit + 1] = True
            keep = np.flatnonzero(~gone)
            at = np.searchsorted(keep, hit)
            symbols, width, owner, pair = symbols[keep], width[keep], owner[keep], pair[keep]
            # Only the pairs beside the new symbols change.
            for i in (at, at[at > 0] - 1):
                right = np.minimum(i + 1, len(symbols) - 1)
                fresh = self.pair_of(symbols[i], symbols[right])
                fresh[(right == i) | (owner[right] != owner[i])] = self.none
                pair[i] = fresh
        return out

    @staticmethod
    def pieces_of(text: str) -> list[str]:
        """White-space marks and the characters up to the next mark."""
        parts = text.replace(" ", MARK).split(MARK)
        out, marks = [], 1  # one mark is put before the text
        for i, part in enumerate(parts):
            if i:
                marks += 1
            if part:
                out.append(MARK * marks + part)
                marks = 0
        if marks:
            out.append(MARK * marks)
        return out

    def count(self, texts: list[str]) -> list[int]:
        split = [self.pieces_of(t) if t else [] for t in texts]
        fresh = list(dict.fromkeys(p for pieces in split for p in pieces if p not in self.counts))
        held, weight, passing = [], 0, {}
        for piece in [*fresh, None]:
            if piece is not None:
                held.append(piece)
                weight += len(piece)
            if held and (piece is None or weight > AT_ONCE):
                for name, n in zip(held, self.merge(held).tolist(), strict=True):
                    (self.counts if len(name) <= REMEMBERED_LENGTH else passing)[name] = n
                held, weight = [], 0
        look = self.counts.get
        totals = [sum(n if (n := look(p)) is not None else passing[p] for p in pieces) for pieces in split]
        if len(self.counts) > REMEMBERED:
            self.counts.clear()
        return totals


def token_counts(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """row_id, n_bytes, n_tokens, over_limit for every row.

    ``model_file`` must be there on every executor.
    """
    need(docs, [id_col, text_col])
    out = pa.schema([("row_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = PieceMerger(model_file)
        for batch in batches:
            sizes, totals = [], []
            for at in range(0, batch.num_rows, 500):
                data = batch.column(1).slice(at, 500).cast(pa.binary()).to_pylist()
                sizes += [len(x or b"") for x in data]
                totals += merger.count([(x or b"").decode("utf-8", "replace") for x in data])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64())], schema=out)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        count, "row_id long, n_bytes long, n_tokens long")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)

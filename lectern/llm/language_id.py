"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a hash of the letter.
An n-gram is the product of its letters' vectors, each rotated by its place; a
text is the sum of its n-grams, and so is a language: the sum over all its
documents.  A text gets the language whose prototype has the highest cosine.
Sums are linear, so n-grams are counted first and weighted with their vectors.

Null texts and texts without a letter are ``und`` with score 0.  With no
labelled text at all every text is ``und``.  A null id is not held out, and is
not learned from.  Ties go to the language that sorts first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need

DIMENSIONS = 1024
GRAM = 3
UNKNOWN = "und"
#: Prototypes travel with the tasks: so many languages, DIMENSIONS numbers each.
MOST_LANGUAGES = 2000
_BLANK = 32


def letter_vector(code: int, dimensions: int) -> np.ndarray:
    """The random vector of a character, the same everywhere."""
    words = [xxhash.xxh3_64_intdigest(f"{code}:{i}".encode()) for i in range(dimensions // 64)]
    bits = np.unpackbits(np.array(words, np.uint64).view(np.uint8))
    return bits.astype(np.float32) * 2 - 1


class Profiles:
    """n-gram vectors, remembered up to a bound."""

    def __init__(self, dimensions: int = DIMENSIONS, gram: int = GRAM, bound: int = 20_000) -> None:
        self.dimensions, self.gram, self.bound = dimensions, gram, bound
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.matrix = np.zeros((0, dimensions), np.int8)
        self.used = 0
        self.is_letter = np.array([chr(c).isalpha() for c in range(0x10000)])

    def codes(self, text: str) -> np.ndarray:
        """Lower-case letters; every other run is one blank.  Empty without letters."""
        chars = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        small = np.minimum(chars, 0xFFFF)
        letter = self.is_letter[small]
        large = np.flatnonzero(chars > 0xFFFF)
        if len(large):
            letter = letter.copy()
            letter[large] = [chr(c).isalpha() for c in chars[large].tolist()]
        if not letter.any():
            return np.zeros(0, np.uint64)
        keep = letter | np.r_[True, letter[:-1]]
        clean = np.where(letter, chars, _BLANK)[keep]
        return np.r_[_BLANK, clean, _BLANK].astype(np.uint64)

    def grams(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams, 21 bits a letter, and their counts."""
        codes = self.codes(text)
        n = len(codes) - self.gram + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        packed = codes[:n].copy()
        for i in range(1, self.gram):
            packed = (packed << np.uint64(21)) | codes[i:n + i]
        return np.unique(packed, return_counts=True)

    def _letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) > self.bound:
                self.letters.clear()
            self.letters[code] = letter_vector(code, self.dimensions)
        return self.letters[code]

    def _bound_vector(self, packed: int) -> np.ndarray:
        out = np.ones(self.dimensions, np.float32)
        for place in range(self.gram):
            out = out * np.roll(self._letter(packed & 0x1FFFFF), place)
            packed >>= 21
        return out

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        names = grams.tolist()
        if self.used + len(names) > self.bound:
            self.rows.clear()
            self.used = 0
        fresh = [g for g in names if g not in self.rows]
        if fresh:
            if self.used + len(fresh) > len(self.matrix):
                grown = np.zeros((2 * (self.used + len(fresh)), self.dimensions), np.int8)
                grown[:self.used] = self.matrix[:self.used]
                self.matrix = grown
            for g in fresh:
                self.rows[g] = self.used
                self.matrix[self.used] = self._bound_vector(g)
                self.used += 1
        return self.matrix[[self.rows[g] for g in names]].astype(np.float32)

    def bundles(self, texts: list[str]) -> np.ndarray:
        """One vector per text."""
        found = [self.grams(t) for t in texts]
        every = np.unique(np.concatenate([g for g, _ in found])) if found else np.zeros(0, np.uint64)
        out = np.zeros((len(texts), self.dimensions), np.float64)
        for a in range(0, len(every), 4096):
            part = every[a:a + 4096]
            counts = np.zeros((len(texts), len(part)), np.float32)
            for i, (grams, n) in enumerate(found):
                lo, hi = np.searchsorted(grams, part[0]), np.searchsorted(grams, part[-1], side="right")
                counts[i, np.searchsorted(part, grams[lo:hi])] = n[lo:hi]
            out += counts @ self.vectors(part)
        return out


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The vector of each language over all rows of ``labelled(text, lang)``."""
    out = pa.schema([("lang", pa.string()), ("place", pa.int32()), ("value", pa.float64())])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions)
        counted: dict[str, dict[int, int]] = {}
        for batch in batches:
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = counted.setdefault(lang, {})
                grams, counts = profiles.grams(text)
                for g, n in zip(grams.tolist(), counts.tolist(), strict=True):
                    own[g] = own.get(g, 0) + n
        for lang, own in counted.items():
            total = np.zeros(dimensions)
            grams = np.fromiter(own, np.uint64, len(own))
            counts = np.fromiter(own.values(), np.float64, len(own))
            for a in range(0, len(grams), 4096):
                total += counts[a:a + 4096] @ profiles.vectors(grams[a:a + 4096])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(total)], schema=out)

    sums = labelled.select("text", "lang").mapInArrow(learn, "lang string, place int, value double").groupBy(
        "lang", "place").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {r["lang"]: np.array([x["value"] for x in r["v"]]) for r in sorted(rows, key=lambda r: r["lang"])}


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             dimensions: int = DIMENSIONS) -> DataFrame:
    """row_id, held_out, lang_pred, score for every row.

    Learns from rows with a language whose crc32(id) mod 4 is not 2.
    """
    need(docs, [id_col, text_col, lang_col])
    fold = F.crc32(F.col(id_col).cast("string")) % 4
    rows = docs.select(F.col(id_col).cast("long").alias("row_id"), F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       fold.alias("fold"))
    known = prototypes(rows.where("fold <> 2 and text is not null and lang is not null"), dimensions)
    names = list(known)
    matrix = np.array([known[n] / max(np.linalg.norm(known[n]), 1e-12) for n in names]).reshape(len(names), dimensions)
    out = pa.schema([("row_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles = Profiles(dimensions)
        for batch in batches:
            said, scores = [], []
            for at in range(0, batch.num_rows, 128):
                texts = batch.column(2).slice(at, 128).to_pylist()
                bundle = profiles.bundles([t or "" for t in texts])
                norm = np.sqrt((bundle ** 2).sum(axis=1))
                cosine = bundle @ matrix.T / np.maximum(norm, 1e-12)[:, None]
                for i in range(len(texts)):
                    if not norm[i] or not names:
                        said.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        best = int(cosine[i].argmax())
                        said.append(names[best])
                        scores.append(float(min(1.0, max(0.0, cosine[i, best]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(said, pa.string()), pa.array(scores, pa.float64())], schema=out)

    return rows.select("row_id", "held_out", "text").mapInArrow(
        compare, "row_id long, held_out boolean, lang_pred string, score double")

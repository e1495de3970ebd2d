"""Quality classifier: a regularised quadratic discriminant on text statistics.

Each text becomes a dozen numbers, the logs of shares that do not depend on its length.  Class
means and covariances are summed natively over every labelled row that is not
held out; covariances are shrunk towards the pooled one and towards a diagonal.
The score is the posterior of class 1 from the difference of the two Gaussian
log densities, whose Cholesky factors are computed once.

Empty and null texts have the statistics of an empty text and get a score too.
Labels that are null or neither 0 nor 1 do not count; repeated labels count
repeatedly.  If a class has no labelled row, every score is the share of class 1
(one half without any).  A null id is not held out and has no label.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored
from lectern.llm.words import byte_texts

CUTOFF = 0.7
#: Weight of the pooled covariance, and of the diagonal of mean variances.
POOLED, DIAGONAL = 0.1, 0.01
FEATURES = ("word_length", "upper", "digits", "stops", "symbols", "bars", "stutter", "lines", "non_ascii",
            "doubled", "spaces")
#: Added to shares before the logarithm, so that none at all looks alike in short and long texts.
FLOOR = 0.02
_DOUBLED = re.compile(rb"([!-/:-@\[-`{-~])\1")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_CLASSES = {
    "upper": _UPPER,
    "digits": np.isin(np.arange(256), np.arange(48, 58)),
    "stops": np.isin(np.arange(256), list(b".,;:?'\"()-")),
    "symbols": np.isin(np.arange(256), list(b"!#$%&*+/<=>@[\\]^_`{}~")),
    "bars": np.isin(np.arange(256), list(b"|")),
    "non_ascii": np.arange(256) >= 128,
}


def statistics(text: bytes) -> list[float]:
    """The numbers of one text, in the order of FEATURES."""
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.lower().split()
    n, size = max(1, len(words)), max(1, len(text))
    of = {name: int(counts[mask].sum()) for name, mask in _CLASSES.items()}
    letters = sum(map(len, words))
    return [float(np.log(x + FLOOR)) for x in (
        letters / n,
        of["upper"] / size,
        of["digits"] / size,
        of["stops"] / size,
        of["symbols"] / size,
        of["bars"] / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        int(counts[10]) / n,
        of["non_ascii"] / size,
        sum(1 for _ in _DOUBLED.finditer(text)) / n,
        (len(text) - letters) / size,
    )]


def document_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row_id and x (array of doubles) for every row."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or b"") for t in byte_texts(batch.column(1))]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))],
                names=["row_id", "x"])
    return docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string")).mapInArrow(
        measure, "row_id long, x array<double>")


@dataclass
class Discriminant:
    """Means and Cholesky factors of both classes, or a constant score."""

    means: np.ndarray | None
    roots: list[np.ndarray]
    prior: float

    @staticmethod
    def fit(counts: list[int], sums: list[np.ndarray], products: list[np.ndarray]) -> Discriminant:
        total = sum(counts)
        prior = counts[1] / total if total else 0.5
        if min(counts) == 0:
            return Discriminant(None, [], prior)
        means = [s / n for s, n in zip(sums, counts, strict=True)]
        spread = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, means, strict=True)]
        pooled = sum(s * n for s, n in zip(spread, counts, strict=True)) / total
        roots = []
        for s in spread:
            shrunk = (1 - POOLED) * s + POOLED * pooled
            shrunk = (1 - DIAGONAL) * shrunk + DIAGONAL * np.eye(len(s)) * (np.trace(shrunk) / len(s) + 1e-6)
            roots.append(np.linalg.cholesky(shrunk))
        return Discriminant(np.array(means), roots, prior)

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.prior)
        density = []
        for mean, root in zip(self.means, self.roots, strict=True):
            z = np.linalg.solve(root, (x - mean).T)
            density.append(-0.5 * (z ** 2).sum(axis=0) - np.log(np.diag(root)).sum())
        odds = density[1] - density[0] + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """From rows (row_id, x) and labels (row_id, label), all of them."""
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rows = (
        measured.join(labels, "row_id").groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(v) for v in x]).alias("s"),
             F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("p"))
        .collect()
    )  # two rows at most
    counts, sums, products = [0, 0], [np.zeros(d)] * 2, [np.zeros((d, d))] * 2
    for row in rows:
        counts[row["label"]], sums[row["label"]] = row["n"], np.array(row["s"])
        full = np.zeros((d, d))
        for (i, j), value in zip(pairs, row["p"], strict=True):
            full[i, j] = full[j, i] = value
        products[row["label"]] = full
    return Discriminant.fit(counts, sums, products)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", cutoff: float = CUTOFF) -> DataFrame:
    """row_id, held_out, score, predicted for every row of ``docs``.

    Learns from labelled rows whose crc32(id) mod 4 is not 2.
    """
    need(docs, [id_col, text_col])
    need(labels, [id_col, label_col])
    measured = stored(document_statistics(docs, id_col, text_col), "statistics")
    held_out = F.coalesce(_fold() == 2, F.lit(False))
    model = fit(measured.where(~held_out), _labels(labels, id_col, label_col))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.asarray(batch.column(2).flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(model.score(x))], names=["row_id", "held_out", "score"])

    rows = measured.select("row_id", held_out.alias("held_out"), "x").mapInArrow(
        judge, "row_id long, held_out boolean, score double")
    return rows.withColumn("predicted", (F.col("score") >= cutoff).cast("int"))


def _fold() -> Column:
    return F.crc32(F.col("row_id").cast("string")) % 4


def _labels(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.select(F.col(id_col).cast("long").alias("row_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", cutoff: float = CUTOFF) -> DataFrame:
    """The rows of ``docs`` that score the cutoff or more, all columns as they are.

    Learns like `quality_scores`; only labelled texts are measured for that, and
    the documents are then judged where they are scanned.
    """
    need(docs, [id_col, text_col])
    need(labels, [id_col, label_col])
    marked = _labels(labels, id_col, label_col).where(_fold() != 2)
    texts = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text"))
    model = fit(document_statistics(texts.join(marked.select("row_id").distinct(), "row_id", "left_semi"), "row_id", "text"), marked)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or b"") for t in byte_texts(batch.column(at))]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= cutoff))

    return docs.mapInArrow(keep, docs.schema)

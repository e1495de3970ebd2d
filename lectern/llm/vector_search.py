"""Exact top-k search by inner product, MaxScore over quantised vectors.

Every dimension is a query term.  A component is floor(256 x); to have scores
that only add up, a term's contribution is taken from its smallest value in the
block on, which moves all scores of a query by one constant.  For a query, terms
are ordered by the most they can add.  The *essential* ones are traversed for
all rows of the block; the rest, whose bounds together cannot reach the
threshold, are probed in order for the rows that are still competitive.  The
threshold is the k-th best exact score known for the query in the block.

Rows are packed into blocks of bounded size, queries too; each pair of blocks is
one task's work, and their best k are merged.  All arithmetic is on integers.

Vectors that are null or hold a null or non-finite component, or have another
length than the query, take no part.  A null id takes no part.  Rows with one id
are one another's candidates only if their ids differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.llm.scratch import need, stored

SCALE = 256
BLOCK_ROWS, BLOCK_QUERIES = 8192, 2048
HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, terms (integers) and their number, for the vectors that take part."""
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & value.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(value, lambda x: F.floor(x * SCALE)).alias("terms"), F.size(value).alias("width"))


def best_of_block(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                  k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The k best (or all tied with the k-th) of a block for each query."""
    exact = rows.dtype == np.int64
    low, high = rows.min(axis=0), rows.max(axis=0)
    columns = np.ascontiguousarray(rows.T)  # the postings: one per term
    for q, query in zip(query_ids.tolist(), queries, strict=True):
        # The least of q*v over the block; contributions count from there.
        least = np.where(query >= 0, query * low, query * high)
        bound = np.where(query >= 0, query * high, query * low) - least
        order = np.argsort(-bound, kind="stable")
        rest = np.r_[np.cumsum(bound[order][::-1])[::-1][1:], 0]
        # A first threshold: exact scores of the rows that lead on the widest terms.
        head = order[:8]
        partial = query[head] @ columns[head]
        eligible = ids != q
        lead = np.argpartition(np.where(eligible, partial, -np.inf if not exact else np.iinfo(np.int64).min), -min(4 * k, len(ids)))[-min(4 * k, len(ids)):]
        lead = lead[eligible[lead]]
        threshold = -np.inf
        base = least.sum()
        if len(lead) >= k:
            threshold = np.sort(rows[lead] @ query)[-k] - base
        essential = int(np.searchsorted(-rest, -threshold, side="right")) + 1 if np.isfinite(threshold) else len(order)
        essential = max(len(head), min(essential, len(order)))
        more = order[len(head):essential]
        total = partial - least[head].sum() + (query[more] @ columns[more] - least[more].sum() if len(more) else 0)
        alive = np.flatnonzero(eligible & (total + rest[essential - 1] >= threshold))
        total = total[alive]
        for at in range(essential, len(order), 8):
            terms = order[at:at + 8]
            total = total + query[terms] @ columns[np.ix_(terms, alive)] - least[terms].sum()
            keep = total + rest[min(at + 8, len(order)) - 1] >= threshold
            alive, total = alive[keep], total[keep]
        score = total + base
        if len(score) > k:
            keep = score >= np.partition(score, -k)[-k]
            alive, score = alive[keep], score[keep]
            if len(score) > k:  # ties go to the smaller id
                order = np.lexsort((ids[alive], -score))[:k]
                alive, score = alive[order], score[order]
        yield np.full(len(alive), q, np.int64), ids[alive], score.astype(np.int64)


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and terms; doubles hold the integers exactly unless they are very large."""
    ids = table.column("vec_id").to_numpy()
    terms = table.column("terms").combine_chunks()
    flat = np.asarray(terms.flatten()).astype(np.int64).reshape(len(ids), -1)
    return ids, flat


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of ``vectors`` for each query.

    Fewer than k rows give all; ties go to the smaller id.
    """
    need(vectors, [id_col, vector_col])
    need(queries, [id_col, vector_col])
    rows = stored(quantised(vectors, id_col, vector_col).withColumn("deal", F.rand(17)), "vectors")
    asked = stored(quantised(queries, id_col, vector_col).withColumn("deal", F.rand(19)), "asked")
    n_blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    n_asked = max(1, -(-asked.count() // BLOCK_QUERIES))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        number: Column = F.floor(F.col("deal") * n_own).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.select("vec_id", "terms", "width", number.alias(own), every.alias(other))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [np.zeros(0, np.int64)] * 3
        if left.num_rows and right.num_rows:
            ids, block = _matrix(left)
            query_ids, wanted = _matrix(right)
            # Sums of products below 2**53 are exact in doubles, which multiply faster.
            largest = float(np.abs(block).max(initial=0)) * float(np.abs(wanted).max(initial=0)) * max(1, block.shape[1])
            if largest < 2 ** 52:
                block, wanted = block.astype(np.float64), wanted.astype(np.float64)
            parts = list(best_of_block(ids, block, query_ids, wanted, k))
            found = [np.concatenate(x) for x in zip(*parts, strict=True)]
        return pa.Table.from_arrays([pa.array(x) for x in found], schema=HITS)

    one = dealt(rows, "block", n_blocks, "queries", n_asked)
    two = dealt(asked, "queries", n_asked, "block", n_blocks)
    cell = ["block", "queries", "width"]
    hits = one.groupBy(*cell).cogroup(two.groupBy(*cell)).applyInArrow(search, "query_id long, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

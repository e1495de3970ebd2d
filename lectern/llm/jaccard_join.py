"""N-gram Jaccard join: a size-aware heavy-light set join on word shingles.

Texts with the same shingle set form one class at once.  Between classes:

* *Light* sets, up to a size boundary, are joined by enumerating subsets.  Two
  sets of sizes m <= n are similar when they share c(m, n) shingles, so every set
  lists its c-subsets for each pair of sizes it can be part of.  Sets that meet
  in a list are similar without any further check.
* *Heavy* sets scan inverted lists.  Shingles are ordered by the number of sets
  that have them; similar sets share a shingle among the first few of both.  Only
  these are listed, bounds on sizes and positions drop most candidates, and the
  rest is counted exactly.
* The boundary is the size with the smallest sum of subsets below it and list
  entries above it, both counted over all sets.

A list may hold a group of thousands of near copies.  It is first compared with
its most central set; sets that this joins into one component need no further
comparison with one another.  Only pairs of sets of one list that are still in
different components are compared pair by pair.

Null or blank texts have no set and no link.  Repeated rows are copies of one
another.  A null id takes part, but is never the smallest id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.components import components, list_links
from lectern.llm.postings import shared_postings
from lectern.llm.scratch import need, stored
from lectern.llm.words import KEY_MASK, WordIds, byte_texts, shingles
from lectern.operators.relational import join_per_key

SHINGLE = 5
#: Similarity as a fraction: linked when 4 * shared >= 3 * union.
NUMERATOR, DENOMINATOR = 3, 4
#: No set above this size is ever light; the cost rule picks the boundary below it.
LARGEST_LIGHT = 20

SIGNED = pa.schema([("row_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.int64())])
SETS = pa.schema([("set_id", pa.int64()), ("n", pa.int32()), ("own", pa.int32()), ("listed", pa.int32()),
                  ("weight", pa.float64()), ("scan", pa.float64()), ("subsets", pa.float64()), ("keys", pa.list_(pa.int64()))])
SETS_DDL = ("set_id long, n int, own int, listed int, weight double, scan double, subsets double, "
            "keys array<long>")


def overlap_needed(m: int, n: int) -> int:
    """Shared shingles from which sets of sizes m and n are similar."""
    return -(-NUMERATOR * (m + n) // (NUMERATOR + DENOMINATOR))


def least_overlap(n: int) -> int:
    return -(-NUMERATOR * n // DENOMINATOR)


def partner_sizes(n: int) -> range:
    return range(least_overlap(n), n * DENOMINATOR // NUMERATOR + 1)


def _set_id(keys: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(keys.tobytes()) - (1 << 63)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row_id, n_shingles, set_id (null without words) for every row."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = WordIds()
        for batch in batches:
            sizes, keys = [], []
            for text in byte_texts(batch.column(1)):
                found = shingles(ids.of((text or b"").lower().split()), SHINGLE)
                sizes.append(len(found))
                keys.append(_set_id(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], schema=SIGNED)
    return docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).cast("string")).mapInArrow(
        sign, "row_id long, n_shingles long, set_id long")


def linkable_sets(docs: DataFrame, text_col: str) -> DataFrame:
    """The sets that may have a partner, with their shared shingles from rare to common.

    ``own`` counts the shingles no other set has; ``listed`` how many of the
    shared ones belong to the prefix.  A set with too many own shingles is out.
    """
    ids = WordIds()

    def keys_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for text in byte_texts(batch.column(0)):
            found = shingles(ids.of((text or b"").lower().split()), SHINGLE)
            if len(found):
                yield _set_id(found), len(found), np.unique(found & KEY_MASK)

    def judge(owners: Iterator[tuple[int, int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        rows = []
        for owner, n, keys, ranks in owners:
            own = n - len(keys)
            listed = n - least_overlap(n) + 1 - own
            if listed <= 0:
                continue
            subsets = float("inf")
            if n <= LARGEST_LIGHT:
                subsets = float(sum(comb(len(keys), overlap_needed(m, n)) for m in partner_sizes(n)))
            scan = float(np.exp2(ranks[:listed] / 16).sum())
            rows.append((owner, n, own, listed, ranks.sum() / n, scan, subsets, keys.astype(np.int64)))
            if len(rows) == 500:
                yield _set_rows(rows)
                rows = []
        if rows:
            yield _set_rows(rows)

    return shared_postings(docs.select(F.col(text_col).cast("string").alias("text")), keys_of, judge, SETS_DDL)


def _set_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SETS.types)], schema=SETS)


def light_boundary(sets: DataFrame) -> int:
    """The size up to which listing subsets costs less than scanning lists."""
    rows = (
        sets.where(F.col("n") <= LARGEST_LIGHT).groupBy("n")
        .agg(F.sum("subsets").alias("subsets"), F.sum("scan").alias("scan")).collect()
    )  # at most LARGEST_LIGHT rows
    cost = {r.n: (r.subsets, r.scan) for r in rows}

    def total(bound: int) -> float:
        return sum(light if n <= bound else heavy for n, (light, heavy) in cost.items())
    return min(range(LARGEST_LIGHT + 1), key=lambda b: (total(b), b))


def light_links(sets: DataFrame, boundary: int) -> DataFrame:
    """Edges (a, b) between similar sets of at most ``boundary`` shingles."""
    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, n, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                buckets, smaller = [], []
                for m in partner_sizes(n):
                    lo, hi = min(m, n), max(m, n)
                    if hi > boundary:
                        continue
                    for chosen in itertools.combinations(sorted(keys), overlap_needed(m, n)):
                        buckets.append(xxhash.xxh3_64_intdigest(np.array((lo, hi, *chosen), np.int64).tobytes()) - (1 << 63))
                        smaller.append(owner if n == lo else None)
                    if len(buckets) > 50_000:
                        yield _subset_rows(owner, buckets, smaller)
                        buckets, smaller = [], []
                yield _subset_rows(owner, buckets, smaller)

    listed = sets.where(F.col("n") <= boundary).select("set_id", "n", "keys").mapInArrow(
        enumerate_subsets, "bucket long, set_id long, smaller long")
    # All smaller sets of a list are similar to all its sets: one of them is the centre.
    centres = listed.groupBy("bucket").agg(F.min("smaller").alias("centre"), F.count(F.lit(1)).alias("met")).where("met > 1")
    return (
        join_per_key(listed, centres, "bucket")
        .where("centre <> set_id").select(F.col("set_id").alias("a"), F.col("centre").alias("b")).distinct()
    )


def _subset_rows(owner: int, buckets: list[int], smaller: list[int | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(buckets, pa.int64()), pa.array([owner] * len(buckets), pa.int64()), pa.array(smaller, pa.int64())],
        names=["bucket", "set_id", "smaller"])


def _needed(a: str, b: str) -> str:
    return f"(({NUMERATOR} * ({a}_n + {b}_n) + {NUMERATOR + DENOMINATOR - 1}) div {NUMERATOR + DENOMINATOR})"


def _fits(a: str, b: str) -> Column:
    """What sizes and positions allow, for the first shingle that a similar pair shares.

    From there on the sets can share at most what either has left.
    """
    sizes = f"{DENOMINATOR} * least({a}_n, {b}_n) >= {NUMERATOR} * greatest({a}_n, {b}_n)"
    return F.expr(f"{sizes} and 1 + least({a}_n - {a}_pos, {b}_n - {b}_pos) >= {_needed(a, b)}")


def verified(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """The similar pairs (a, b) among candidates (a, a_n, b, b_n)."""
    pairs = candidates.select("a", "b", F.expr(_needed("a", "b")).alias("needed")).distinct()
    left = sets.select(F.col("set_id").alias("a"), F.col("keys").alias("a_keys"))
    right = sets.select(F.col("set_id").alias("b"), F.col("keys").alias("b_keys"))
    return (
        pairs.join(left, "a").join(right, "b")
        .where(F.size(F.array_intersect("a_keys", "b_keys")) >= F.col("needed")).select("a", "b")
    )


def heavy_links(sets: DataFrame, boundary: int) -> DataFrame:
    """Edges between similar sets of which at least one is above ``boundary``.

    Enough edges to join every component; pairs that are known to be in one
    component already are left out.
    """
    large = sets.where(F.col("n") >= least_overlap(boundary + 1))
    entries = stored(
        large.select(F.col("set_id").alias("node"), "n", "own", "weight",
                     F.posexplode(F.slice("keys", 1, F.col("listed"))).alias("at", "key"))
        .select("key", "node", "weight", "n", (F.col("own") + F.col("at") + 1).alias("pos")), "entries")
    return list_links(entries, ["n", "pos"], _fits, lambda candidates: verified(candidates, sets))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_id, n_shingles, component_id (smallest id reachable by links) for every row."""
    need(docs, [id_col, text_col])
    signed = stored(signatures(docs, id_col, text_col), "signed")
    sets = stored(linkable_sets(docs, text_col), "sets")
    boundary = light_boundary(sets)
    edges = light_links(sets, boundary).union(heavy_links(sets, boundary))
    labels = components(edges)
    smallest = signed.where("set_id is not null").groupBy("set_id").agg(F.min("row_id").alias("first_id"))
    labelled = stored(
        smallest.join(labels, smallest["set_id"] == labels["node"], "left")
        .select("set_id", "first_id", F.coalesce("label", "set_id").alias("label")), "classes")
    heads = labelled.groupBy("label").agg(F.min("first_id").alias("head"))
    per_set = join_per_key(labelled.select("set_id", "label"), heads, "label").select("set_id", "head")
    rows = signed.where("set_id is not null").join(per_set, "set_id").select(
        "row_id", "n_shingles", F.col("head").alias("component_id"))
    blank = signed.where("set_id is null").select("row_id", "n_shingles", F.col("row_id").alias("component_id"))
    return rows.union(blank)

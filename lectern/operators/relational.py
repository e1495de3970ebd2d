"""Projection, filter, join, aggregate and ranking operators.

No join here carries a broadcast hint: Spark broadcasts a side on its own when
its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and sorts
and merges otherwise, where adaptive execution splits a skewed key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#  -- projections and filters -------------------------------------------------

def project(df: DataFrame, **renamed: str) -> DataFrame:
    """Keep and rename columns: ``project(df, new="old")``."""
    return df.select(*[F.col(old).alias(new) for new, old in renamed.items()])


def where_all(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows for which every condition is true; null counts as not true."""
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def since(df: DataFrame, column: str, cutoff: str) -> DataFrame:
    """Rows at or after a cutoff such as ``2024-07-01T00:00:00Z``."""
    return df.where(F.col(column) >= F.lit(cutoff).cast("timestamp"))


def with_status(df: DataFrame, status: str = "generated") -> DataFrame:
    return df.where(F.col("status") == status)


def lookup_by_id(
    df: DataFrame, value: str, key: str = "id", order_by: Sequence[str] = ()
) -> DataFrame:
    """The first row with this id as a one-row table; ``ValueError`` if there is none."""
    found = df.where(F.col(key) == value)
    if order_by:
        found = found.orderBy(*order_by)
    rows = found.take(1)
    if not rows:
        raise ValueError(f"no row with {key} = {value!r}")
    return df.sparkSession.createDataFrame(rows, df.schema)


# -- joins -------------------------------------------------------------------

def join_per_key(
    rows: DataFrame, per_key: DataFrame, key: str, how: str = "inner"
) -> DataFrame:
    """Join rows that may have hot keys with an aggregate that has one row per key.

    Adaptive execution splits a skewed key only where both sides of the join
    come straight from a shuffle.  An aggregate by the join key is already
    partitioned right and would be joined as it is.  Its key is passed on as an
    expression that Spark does not take for the same column, so the small side
    gets a shuffle of its own, and a key with very many rows can be split.
    """
    linked = "__linked_key"
    relinked = per_key.withColumn(
        linked, F.when(F.col(key).isNotNull(), F.col(key))
    ).drop(key)
    return rows.join(relinked, F.col(key) == F.col(linked), how).drop(linked)


def edges_with_owner(dependencies: DataFrame, versions: DataFrame) -> DataFrame:
    """Dependency edges with the package that owns the depending version."""
    owner = project(versions, version_id="id", dependant_id="crate_id")
    return dependencies.join(owner, "version_id")


def with_both_repositories(edges: DataFrame, packages: DataFrame) -> DataFrame:
    """Look both ends of each edge up in one package-to-repository table."""
    target = project(packages, crate_id="id", target_repo="repository")
    dependant = project(packages, dependant_id="id", dependant_repo="repository")
    return edges.join(target, "crate_id").join(dependant, "dependant_id")


def same_repository(edges: DataFrame) -> DataFrame:
    """Edges inside one repository; a missing repository matches nothing."""
    return edges.where(F.col("target_repo") == F.col("dependant_repo"))


def without_listed(df: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """Rows whose key is not in the other table; a null key is dropped too.

    An anti join: unlike SQL ``NOT IN``, a null in the list changes nothing.
    """
    ids = listed.select(F.col(listed_key).alias(key)).distinct()
    return join_per_key(df.where(F.col(key).isNotNull()), ids, key, "left_anti")


def with_metrics(packages: DataFrame, downloads: DataFrame, dependants: DataFrame) -> DataFrame:
    """Left joins of download and dependant counts; packages without keep nulls."""
    loads = project(downloads, id="crate_id", downloads="downloads")
    counts = project(dependants, id="crate_id", direct_dependant_count="direct_dependant_count")
    return packages.join(loads, "id", "left").join(counts, "id", "left")


def zip_by_key(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Pair inputs with results on a record key instead of on row position."""
    return left.join(right, list(keys))


# -- aggregates --------------------------------------------------------------

def first_seen(packages: DataFrame) -> DataFrame:
    """Earliest package date per repository; rows without a repository do not count."""
    return (
        packages.where(F.col("repository").isNotNull())
        .groupBy("repository")
        .agg(F.min("created_at").alias("repo_start_date"))
    )


def distinct_count(
    df: DataFrame,
    key: str,
    value: str,
    name: str,
    count_null: bool = True,
    approximate_error: float | None = None,
) -> DataFrame:
    """Distinct values per key.

    ``count_null`` counts null as one more value.  The pairs are made distinct
    before they are counted, so a key that holds many rows is spread over the
    shuffle by (key, value) and reaches its final task as partial counts.
    """
    if approximate_error is not None:
        exact = F.approx_count_distinct(value, approximate_error)
        null_seen = F.max(F.col(value).isNull().cast("int")) if count_null else F.lit(0)
        return df.groupBy(key).agg((exact + null_seen).alias(name))
    counted = F.count(F.lit(1)) if count_null else F.count(value)
    return df.select(key, value).distinct().groupBy(key).agg(counted.alias(name))


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


# -- order and limit ---------------------------------------------------------

def top_k(df: DataFrame, by: str, k: int, tie_break: str) -> DataFrame:
    """The k largest, ties settled by a key: one bounded heap per task, one merge."""
    return df.orderBy(F.col(by).desc(), F.col(tie_break)).limit(k)


def sorted_head(df: DataFrame, n: int | None, *order: str) -> DataFrame:
    """The first n rows in code-point order of the given columns; ``None`` keeps all."""
    return df if n is None else df.orderBy(*order).limit(n)


def input_prefix(df: DataFrame, n: int | None, *positions: str) -> DataFrame:
    """The first n rows in input order; ``None`` keeps all."""
    return sorted_head(df, n, *positions)


def sample_one(df: DataFrame, key: str, seed: int) -> DataFrame:
    """Exactly one row, each equally likely over seeds; no row if there is none."""
    draw = F.md5(F.concat_ws("#", F.col(key), F.lit(str(seed))))
    return df.orderBy(draw, F.col(key)).limit(1)


# -- nested ------------------------------------------------------------------

def explode_with_parent(df: DataFrame, array: str, pos: str, item: str) -> DataFrame:
    """One row per element with its position; an empty list gives no row."""
    kept = [c for c in df.columns if c != array]
    return df.select(*kept, F.posexplode(array).alias(pos, item))


def union_results(*parts: DataFrame | None) -> DataFrame:
    """Partial results by column name; ``None`` adds nothing."""
    present = [p for p in parts if p is not None]
    if not present:
        raise ValueError("no result to join together")
    return reduce(DataFrame.unionByName, present)

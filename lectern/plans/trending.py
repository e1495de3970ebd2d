"""Rank the new, documented packages that are not parts of a larger one."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schemas as S
from lectern.functions.scalars import fill_numeric_nulls, longer_than
from lectern.functions.timestamps import parse_iso_timestamp
from lectern.operators import relational as R
from lectern.sources.csv_tables import read_csv_lenient, read_csv_strict
from lectern.sources.identity import Files
from lectern.sources.stages import stage_once

# Fixed values of the ranking.
CUTOFF = "2024-07-01T00:00:00Z"
MIN_DESCRIPTION, MIN_README = 10, 100
TOP = 20

RESULT_COLUMNS = (
    "name", "created_at", "direct_dependant_count", "downloads",
    "description", "repository", "homepage", "documentation",
)


def load_registry(
    spark: SparkSession, folder: str, work: str, splittable: Collection[str] = ("crate_downloads", "dependencies", "versions")
) -> dict[str, DataFrame]:
    """The four CSV tables of a registry dump, turned into Parquet once.

    Downloads are read strictly; writing the table checks all of it.  The tables
    of ``splittable`` hold no line break inside a value, so many tasks read one
    file; the packages with their readmes are not among them by default.
    """
    readers = {
        "crates": (read_csv_lenient, S.CRATES),
        "crate_downloads": (read_csv_strict, S.CRATE_DOWNLOADS),
        "dependencies": (read_csv_lenient, S.DEPENDENCIES),
        "versions": (read_csv_lenient, S.VERSIONS),
    }
    return {
        name: stage_once(
            spark, f"{work}/{name}",
            lambda read=read, schema=schema, name=name: read(
                spark, f"{folder}/{name}.csv", schema, multi_line=name not in splittable
            ),
            [Files(spark, (f"{folder}/{name}.csv",)), read, schema, name in splittable],
        )
        for name, (read, schema) in readers.items()
    }


def with_parsed_dates(packages: DataFrame) -> DataFrame:
    """Text dates parsed leniently; a timestamp column is taken as it is."""
    if isinstance(packages.schema["created_at"].dataType, T.StringType):
        return packages.withColumn("created_at", parse_iso_timestamp("created_at"))
    return packages.withColumn("created_at", F.col("created_at").cast("timestamp"))


def has_quality() -> Column:
    return (
        longer_than("description", MIN_DESCRIPTION)
        & F.col("documentation").isNotNull()
        & F.col("homepage").isNotNull()
        & longer_than("readme", MIN_README)
    )


def trending_packages(
    crates: DataFrame,
    downloads: DataFrame,
    dependencies: DataFrame,
    versions: DataFrame,
    cutoff: str = CUTOFF,
    top: int = TOP,
) -> DataFrame:
    """The ``top`` packages by distinct dependants, as one lazy plan.

    What is kept small: the readme is judged in the scan and goes no further.
    Edges meet the packages of new repositories first, which drops most of them
    before they meet the versions.  Pairs are made distinct before anything else
    is joined to them, so an id that occurs in several rows counts once.
    """
    packages = with_parsed_dates(crates)
    new_repositories = R.since(R.first_seen(packages), "repo_start_date", cutoff)
    new_packages = R.join_per_key(
        packages.select("id", "repository"), new_repositories.select("repository"), "repository"
    )

    new_ids = R.project(new_packages, crate_id="id").distinct()
    to_new = R.join_per_key(dependencies.select("version_id", "crate_id"), new_ids, "crate_id")
    pairs = R.distinct_rows(R.edges_with_owner(to_new, versions), "crate_id", "dependant_id")
    usage = pairs.groupBy(F.col("crate_id").alias("id")).agg(F.count(F.lit(1)).alias("direct_dependant_count"))
    homes = R.project(packages, dependant_id="id", repository="repository").where(
        F.col("repository").isNotNull()
    )
    # Packages that another one of their own repository depends on.
    internal = pairs.join(homes, "dependant_id").select(
        F.col("crate_id").alias("id"), "repository"
    ).join(new_packages, ["id", "repository"], "left_semi").select("id").distinct()

    candidates = packages.where(F.col("id").isNotNull() & has_quality()).select(
        "id", "name", "created_at", "description", "repository", "homepage", "documentation"
    )
    loads = R.project(downloads, id="crate_id", downloads="downloads")
    ranked = (
        R.join_per_key(candidates, new_repositories.select("repository"), "repository")
        .join(loads, "id", "left")
        .join(usage, "id", "left")
    )
    frontends = ranked.join(internal, "id", "left_anti")
    filled = fill_numeric_nulls(frontends)
    return R.top_k(filled, "direct_dependant_count", top, "id").select(*RESULT_COLUMNS)

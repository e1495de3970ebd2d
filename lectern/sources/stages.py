"""Materialised stages."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lectern.session import hadoop_path, path_exists
from lectern.sources.identity import digest

_NOTE = "_MADE_FROM"


def is_complete(spark: SparkSession, path: str) -> bool:
    """A table counts as present only once its job has committed."""
    return path_exists(spark, f"{path}/_SUCCESS")


def _noted(spark: SparkSession, path: str) -> dict | None:
    """Identity and schema noted beside a table."""
    fs, target = hadoop_path(spark, f"{path}/{_NOTE}")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _note(spark: SparkSession, path: str, made_from: str, schema: T.StructType) -> None:
    fs, target = hadoop_path(spark, f"{path}/{_NOTE}")
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(json.dumps({"made_from": made_from, "schema": schema.jsonValue()}).encode()))
    finally:
        stream.close()


def stage_once(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    made_from: Sequence[object] | None = None,
) -> DataFrame:
    """Load the table at ``path``, or build and write it first.

    The table is taken only if it was made from the same: ``made_from`` names
    tables, models, functions and settings (see `identity.digest`), by default
    ``build`` itself with all it refers to.  Another filter, literal, limit,
    model, template or input file so builds it again, and the same ones do not
    call ``build`` at all.

    Reading the written table back cuts the lineage: later actions neither
    repeat the work nor draw new random values, and a lost executor costs at
    most the tasks of the stage that was running.
    """
    wanted = digest(build) if made_from is None else digest(*made_from)
    if is_complete(spark, path):
        noted = _noted(spark, path)
        if noted is not None and noted["made_from"] == wanted:
            return spark.read.schema(T.StructType.fromJson(noted["schema"])).parquet(path)
    built = build()
    built.write.mode("overwrite").option("compression", "zstd").parquet(path)
    _note(spark, path, wanted, built.schema)
    return spark.read.schema(built.schema).parquet(path)

"""Training sets as Parquet, the form that dataset loaders read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_training_set(df: DataFrame, path: str) -> None:
    """Nested columns such as ``messages`` are kept as they are."""
    df.write.mode("overwrite").parquet(path)


def read_training_set(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

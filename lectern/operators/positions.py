"""Row numbers over a whole table without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lectern.sources.stages import stage_once


def with_position(df: DataFrame, order_by: Sequence[str], path: str, name: str = "pos") -> DataFrame:
    """Number the rows from 0 in the given order, which must be unique.

    The rows are range-partitioned and written once under ``path``.  Only the
    start of each partition is then ranked in one place, which is one row per
    partition however many rows there are; it is also what bounds the broadcast.
    """
    spark = df.sparkSession
    part, local = "__part", "__local"

    def placed() -> DataFrame:
        return (
            df.repartitionByRange(*order_by)
            .sortWithinPartitions(*order_by)
            .withColumn(part, F.spark_partition_id())
            .withColumn(local, F.monotonically_increasing_id())
        )

    rows = stage_once(spark, path, placed, [df, list(order_by)])
    starts = rows.groupBy(part).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(local).alias("__first")
    )
    before = W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)
    offsets = starts.select(
        part, "__first", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset")
    )
    numbered = rows.join(F.broadcast(offsets), part)
    return numbered.withColumn(
        name, F.col("__offset") + F.col(local) - F.col("__first")
    ).drop(part, local, "__first", "__offset")

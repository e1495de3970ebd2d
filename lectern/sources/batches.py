"""Resumable batches: a file stream over the input is the log of what is done."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.positions import with_position
from lectern.session import path_exists
from lectern.sources.identity import digest
from lectern.sources.stages import is_complete

_BATCH = T.StructField("batch_id", T.IntegerType())
#: How batches lie under the folder; older folders are not gone on with.
_LAYOUT = "batches side by side"
#: Batches that a micro-batch takes where they are only copied, and for each that runs at a time.
COPIED, PER_THREAD = 256, 4


def checkpointed_batches(
    df: DataFrame,
    path: str,
    order_by: Sequence[str],
    batch_size: int,
    process: Callable[[DataFrame, str], DataFrame] | None = None,
    made_from: Sequence[object] | None = None,
    at_once: int = 1,
    together: int = 1,
) -> DataFrame:
    """Process a table batch by batch and skip the batches already done.

    ``order_by`` must be a unique order; rows ``k * batch_size`` onwards form
    batch k.  The numbered input is written once, one file per batch.  One
    streaming query then takes the files that are there and notes them in its
    checkpoint: a restart goes on with the batches not finished, and writes their
    results over what they left.  Batches follow one another in the order in
    which their files were written.  A batch counts as done also when it yields
    no rows.

    ``process`` gets the rows of a batch and a folder for its own stages, which
    a restart finds again.  ``at_once`` batches are processed side by side, since
    a batch of small steps mostly waits for the driver; all of their tasks then
    share the cluster.  Without ``process`` a micro-batch copies many batches.
    With ``together`` that many batches go through ``process`` as one table, so that
    its steps cost the driver once for all of them: it then also gets the column
    ``batch_id`` and keeps it in its result, and a restart takes up what of the
    group's stages is there.
    Everything lies under a folder named for the input, the order, the batch
    size and what ``process`` does (``made_from``, by default its code with all
    it refers to), so a run on other input, with other batches or another model
    starts anew.
    """
    spark = df.sparkSession
    what = [process] if made_from is None else list(made_from)
    path = f"{path}/{digest(df, list(order_by), batch_size, what, _LAYOUT, *[together][:together - 1])[:16]}"
    schema = T.StructType([*df.schema.fields, _BATCH])

    def numbered() -> DataFrame:
        placed = with_position(df, order_by, f"{path}/ordered", "__pos")
        batch = F.floor(F.col("__pos") / F.lit(batch_size)).cast("int")
        # One task writes a batch, so that a batch is one file.
        return placed.withColumn("batch_id", batch).drop("__pos").repartition("batch_id").withColumn("__folder", F.col("batch_id"))

    source_path, done_path = f"{path}/input", f"{path}/done"
    if not path_exists(spark, f"{source_path}/_SUCCESS"):
        numbered().write.mode("overwrite").option("compression", "zstd").partitionBy("__folder").parquet(source_path)

    def work_off(rows: DataFrame, epoch: int) -> None:
        # The query's own session; streams switch adaptive execution off.
        session = rows.sparkSession
        session.conf.set("spark.sql.adaptive.enabled", "true")
        if process is None:
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{done_path}/epoch={epoch}")
            return

        def finish(numbers: list[int]) -> None:
            number = numbers[0]
            target = f"{done_path}/epoch={number}"
            if is_complete(session, target):
                return
            batch = session.read.schema(schema).parquet(*[f"{source_path}/__folder={n}" for n in numbers])
            if together == 1:
                result = process(batch.select(*df.columns), f"{path}/work/{number}").withColumn("batch_id", F.lit(number).cast("int"))
            else:
                result = process(batch, f"{path}/work/{number}")
            result.write.mode("overwrite").option("compression", "zstd").parquet(target)

        # The log gives a restart the same batches of a micro-batch, and so the same groups.
        numbers = sorted(row[0] for row in rows.distinct().collect())
        groups = [numbers[i:i + together] for i in range(0, len(numbers), together)]
        if at_once == 1:
            for group in groups:
                finish(group)
            return
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(inheritable_thread_target(session)(finish), groups))

    arriving = (
        spark.readStream.schema(T.StructType([*schema.fields, T.StructField("__folder", T.IntegerType())]))
        .option("maxFilesPerTrigger", COPIED if process is None else together if at_once == 1 else PER_THREAD * at_once * together)
        .parquet(source_path)
    )
    arriving = arriving.drop("__folder") if process is None else arriving.select("__folder")
    query = (
        arriving.writeStream.foreachBatch(work_off).option("checkpointLocation", f"{path}/log")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if not path_exists(spark, done_path):
        empty = df.limit(0) if process is None else process(df.limit(0), f"{path}/work/none")
        return empty.withColumn("batch_id", F.lit(None).cast("int"))
    return spark.read.parquet(done_path).drop("epoch")

"""Documentation files as whole texts."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schemas as S
from lectern.session import hadoop_path
from lectern.sources.json_records import load_json_lines, save_json_lines


#: Bytes of small files that a task reads at least.
TASK_BYTES = 32 << 20
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def read_texts(spark: SparkSession, *paths: str, written: bool = False) -> DataFrame:
    """``file_path`` and ``text`` of every file under the given paths.

    ``written`` says that ``write_texts`` made the files: a folder for each, none of them
    compressed.  These are listed by few tasks, not by one for every five of them, their folders'
    names are not made columns, and they are read as bytes, since the reader of whole texts
    sets itself up anew for each file.
    """
    if written:
        return _read_written(spark, paths)
    return spark.read.text(list(paths), wholetext=True).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("text")
    )


def _read_written(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    parts = 4 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(_LISTERS)
    spark.conf.set(_LISTERS, parts)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    finally:
        spark.conf.set(_LISTERS, before)
    size = int(files._jdf.queryExecution().analyzed().stats().sizeInBytes())
    # The scan takes each file for 4 MB and would make a task of every few.
    return files.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("content").cast("string").alias("text")
    ).coalesce(max(parts, size // TASK_BYTES))


def texts_of(listed: DataFrame, texts: DataFrame, key: str = "file_path") -> DataFrame:
    """The text of each listed file; a file that does not exist has an empty text."""
    return listed.join(texts.select(key, "text"), key, "left").withColumn("text", F.coalesce("text", F.lit("")))


def _folder_value(value: str | None) -> str:
    """A value in a folder's name, as Spark writes it."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda found: f"%{ord(found[0]):02X}", value)


def _file_writer(folder: str, name: str):
    """Rows sorted by name to ``folder/name=value``; a repeated task writes over what it left."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, file = None, f"part-{TaskContext.get().partitionId():05d}.txt"
        for batch in batches:
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                place = f"{folder}/{name}={_folder_value(value)}"
                os.makedirs(place, exist_ok=True)
                with open(f"{place}/{file}", "ab" if place == last else "wb") as out:
                    out.write((text.as_py() or b"") + b"\n")
                last = place
            yield pa.RecordBatch.from_pydict({"rows": [batch.num_rows]})

    return write


def write_texts(
    df: DataFrame, path: str, name: str, text: str = "text", tasks: int | None = None
) -> None:
    """One file per row, in a folder ``name=value``; each ends with a newline.

    Making a file takes longer than its bytes do, so the rows are spread over
    ``tasks`` writers (by default the parallelism of the cluster).  On a mounted
    file system the tasks make the files themselves: Hadoop starts a process for
    the rights of each new file and folder, and the driver then moves them all.
    Rows that share a name share its file.
    """
    spark = df.sparkSession
    writers = tasks or spark.sparkContext.defaultParallelism
    spread = df.select(F.col(name), F.col(text).alias("value")).repartition(writers, name)
    fs, target = hadoop_path(spark, path)
    root = fs.makeQualified(target).toUri()
    if root.getScheme() != "file":
        spread.write.mode("overwrite").partitionBy(name).text(path, compression="none")
        return
    fs.delete(target, True)
    fs.mkdirs(target)
    rows = spread.select(F.col(name).cast("string").alias("name"), F.col("value").cast("binary")).sortWithinPartitions("name")
    rows.mapInArrow(_file_writer(root.getPath(), name), "rows long").agg(F.sum("rows")).collect()
    fs.create(hadoop_path(spark, f"{path}/_SUCCESS")[1], True).close()


def write_packed(df: DataFrame, path: str, compression: str = "none") -> None:
    """``file_path`` and ``text`` of many documents to a file, one JSON line each.

    As many files as the input has partitions, however many documents there are;
    line breaks inside a text are escaped, so texts come back as they were.
    """
    save_json_lines(df.select(*S.DOCUMENT.names), path, compression)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Documents written by ``write_packed``; large files are split over tasks.

    A line without one of the two fields stops the job.
    """
    return load_json_lines(spark, path, S.DOCUMENT)

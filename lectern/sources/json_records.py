"""Typed record collections in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.structured import fail_unless, parse_structured


def _source() -> Column:
    return F.col("_metadata.file_path").alias("source_file")


def _checked(raw: DataFrame, schema: T.StructType) -> DataFrame:
    parsed = parse_structured(raw, "value", schema, "record", "valid")
    message = F.concat(F.lit("record of the wrong type in "), F.col("source_file"))
    return fail_unless(parsed, F.col("valid"), message)


def load_json_document(
    spark: SparkSession, path: str, record: T.StructType, root: str = "problems"
) -> DataFrame:
    """Records of documents like ``{"problems": [...]}``, one document per file.

    ``path`` may be a folder or pattern with many documents, which are read in
    parallel.  A missing or mistyped field fails the job.  ``pos`` is the place
    of the record in its document, ``source_file`` the document.
    """
    raw = spark.read.text(path, wholetext=True).select("value", _source())
    holder = T.StructType([
        T.StructField(root, T.ArrayType(record, containsNull=False), nullable=False)
    ])
    rows = _checked(raw, holder).select(
        "source_file", F.posexplode(f"record.{root}").alias("pos", "item")
    )
    return rows.select("source_file", "pos", "item.*")


def load_json_lines(spark: SparkSession, path: str, record: T.StructType) -> DataFrame:
    """Records written by ``save_json_lines``, with the same checks."""
    raw = spark.read.text(path).select("value", _source())
    return _checked(raw, record).select("record.*")


def save_json_lines(df: DataFrame, path: str, compression: str = "none") -> None:
    """One record per line; every task writes its own file, which is read as a whole if compressed."""
    df.write.mode("overwrite").option("ignoreNullFields", False).option("compression", compression).json(path)


def save_json_documents(documents: DataFrame, path: str, tasks: int | None = None) -> None:
    """One file per row, each row being a whole document such as ``{"problems": [...]}``.

    The rows are spread over ``tasks`` writers, by default the parallelism of
    the cluster.
    """
    writers = tasks or documents.sparkSession.sparkContext.defaultParallelism
    text = documents.select(F.to_json(F.struct(*documents.columns)).alias("value"))
    spread = text.repartition(writers, "value")
    spread.write.mode("overwrite").option("maxRecordsPerFile", 1).text(path)

"""CSV tables with declared schemas.

Quoted text may span lines, so a file is read by one task: keep a large table in
many files, or turn it into Parquet once with ``stage_once``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.structured import checked_rows

# Stands for null nowhere in the data, so that a quoted empty string stays one.
_NO_NULL_TEXT = "\\N"


def _read(
    spark: SparkSession, path: str, schema: T.StructType, mode: str, multi_line: bool
) -> DataFrame:
    """Columns are found by the names in the header; others in the file are not read.

    Files of one table may order their columns differently: each header gives a
    read of its own, and the reads are united by name.
    """
    reader = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .option("nullValue", _NO_NULL_TEXT)
    )
    declared = {f.name: f for f in schema.fields}
    tables = []
    for header, files in sorted(_headers(spark, reader, path).items()):
        missing = set(schema.names) - set(header)
        if missing:
            raise ValueError(f"{files[0]} has no column {sorted(missing)}")
        full = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in header])
        tables.append(reader.schema(full).option("mode", mode).csv(files).select(*schema.names))
    return reduce(DataFrame.unionByName, tables)


def _headers(spark: SparkSession, reader: DataFrameReader, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files by header.  One file is read as it is; of several, the first lines are compared in one job."""
    whole = tuple(reader.csv(path).columns)
    files = spark.read.text(path).inputFiles()
    if len(files) < 2:
        return {whole: [path]}
    # The first line of a file is the only one at offset 0 of its first block.
    first = (
        spark.read.text(path).select(F.input_file_name().alias("file"), F.input_file_block_start().alias("at"),
                                     F.monotonically_increasing_id().alias("id"), "value")
        .where("at = 0").groupBy("file").agg(F.min_by("value", "id").alias("line"))
    )
    lines: dict[str, list[str]] = {}
    for row in first.collect():  # one row per file
        lines.setdefault(row["line"], []).append(row["file"])
    if len(lines) == 1:
        return {whole: [path]}
    found: dict[tuple[str, ...], list[str]] = {}
    for some in lines.values():
        found.setdefault(tuple(reader.csv(some[0]).columns), []).extend(some)
    return found


def read_csv_lenient(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """A value that does not parse becomes null and its row stays."""
    return _read(spark, path, schema, "PERMISSIVE", multi_line)


def read_csv_strict(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """A value that does not parse fails the job, whichever columns and rows are used.

    The reader parses only the columns a query needs.  The filter is true for
    every row but takes all columns to find that out, so none is left unparsed.
    """
    rows = _read(spark, path, schema, "FAILFAST", multi_line)
    return checked_rows(rows, F.hash(*schema.names) >= F.lit(-(2**31)))


def write_csv(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; empty strings and nulls stay apart."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

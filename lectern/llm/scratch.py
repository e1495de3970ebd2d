"""Intermediate tables in the shared folder, and column checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.relational import join_per_key
from lectern.session import fresh_path, hadoop_path, shared_dir

#: Key tables of more rows than this are not broadcast.
BROADCAST_ROWS = 1_000_000


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write once under the shared folder and read back.

    This cuts the lineage: a lost executor costs its running tasks, and no later
    action computes the rows again.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        own = f"{shared_dir(spark)}/lectern/"
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            fs, target = hadoop_path(spark, folder)
            if own.split("://")[-1].strip("/") in folder:
                fs.delete(target, True)


def need(df: DataFrame, columns: Sequence[str]) -> None:
    """Stop with a message when an input lacks a column."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def free_names(df: DataFrame, names: Sequence[str]) -> dict[str, str]:
    """For each name one that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        free = name
        while free.lower() in taken:
            free = f"_{free}"
        taken.add(free.lower())
        out[name] = free
    return out


def shuffle_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is in the stored one-column table ``keys`` of distinct keys.

    Counted first: a table of a few megabytes is broadcast, a larger one is
    shuffled and joined so that hot keys can be split.
    """
    if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keys), key, "left_semi")
    return join_per_key(rows, keys.groupBy(key).agg(F.count(F.lit(1)).alias("__times")), key).drop("__times")

"""Small column functions: defaults, identifiers, paths, outcomes."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def longer_than(text: Column | str, limit: int) -> Column:
    """True when the text has more than ``limit`` characters (code points)."""
    return F.length(as_column(text)) > F.lit(limit)


def fill_numeric_nulls(df: DataFrame, value: int = 0) -> DataFrame:
    """Null to ``value`` in numeric columns; other types keep their nulls."""
    return df.na.fill(value)


def default_when_empty(text: Column | str, default: Column | str) -> Column:
    """The default for a null or empty string."""
    fallback = F.lit(default) if isinstance(default, str) else default
    return F.coalesce(F.nullif(as_column(text), F.lit("")), fallback)


def default_when_absent(df: DataFrame, column: str, default: str) -> Column:
    """The column as it is if the table has it, else the default."""
    return F.col(column) if column in df.columns else F.lit(default)


def uuid_layout(hex32: Column) -> Column:
    """32 hex digits in the 8-4-4-4-12 layout."""
    pieces = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(hex32, start, size) for start, size in pieces])


def prefixed_id(key: Column | str, prefix: str | None = None) -> Column:
    """An id in uuid layout, made from the record key so that reruns agree."""
    body = uuid_layout(F.md5(as_column(key)))
    return body if prefix is None else F.concat_ws("-", F.lit(prefix), body)


def random_id(prefix: str | None = None) -> Column:
    """A random id.  Write the table before reuse: each run draws new ids."""
    return F.uuid() if prefix is None else F.concat_ws("-", F.lit(prefix), F.uuid())


def path_basename(path: Column | str) -> Column:
    """The last segment of a path; trailing slashes do not count."""
    trimmed = F.rtrim(as_column(path), F.lit("/"))
    return F.element_at(F.split(trimmed, "/"), -1)


def path_join(*segments: Column | str) -> Column:
    """Segments joined by one slash; a plain string is a literal segment."""
    cleaned = [F.lit(s) if isinstance(s, str) else s for s in segments]
    heads = [F.rtrim(s, F.lit("/")) for s in cleaned[:-1]]
    return F.concat_ws("/", *heads, cleaned[-1])


def run_outcome(exit_code: Column | str, stdout: Column | str, stderr: Column | str) -> list[Column]:
    """``is_success`` and ``output`` of one test run."""
    empty = F.lit("")
    output = F.concat(F.coalesce(as_column(stdout), empty), F.coalesce(as_column(stderr), empty))
    return [
        (as_column(exit_code) == 0).alias("is_success"),
        output.alias("output"),
    ]


def generation_status(error: Column | str) -> Column:
    """``generated``, or ``failed: ...`` with the error text."""
    reason = as_column(error)
    return F.when(reason.isNull(), F.lit("generated")).otherwise(
        F.concat(F.lit("failed: "), reason)
    )


def vectorised(function: Callable[[object], object], returns: T.DataType | str):
    """Wrap a value-by-value Python function as an Arrow-batched column function.

    Nulls are not passed to the function and come back as null.  Built-in
    functions stay inside code generation and should be tried first.
    """

    def apply(values: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(values), index=values.index, dtype=object)
        present = values.notna()
        out[present] = [function(v) for v in values[present]]
        return out

    apply.__annotations__ = {"values": pd.Series, "return": pd.Series}
    return F.pandas_udf(apply, returnType=returns)

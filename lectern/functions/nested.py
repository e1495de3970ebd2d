"""Column functions over arrays of records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.scalars import as_column


def items_of_kind(items: Column | str, kind: str) -> Column:
    """The elements whose ``kind`` is the given one, in order."""
    return F.filter(as_column(items), lambda item: item["kind"] == F.lit(kind))


def first_content(items: Column | str, kind: str, default: str = "") -> Column:
    """Content of the first element of a kind, or the default."""
    return F.coalesce(F.get(items_of_kind(items, kind), F.lit(0))["content"], F.lit(default))


def last_content(items: Column | str, kind: str, default: str | None = None) -> Column:
    """Content of the last element of a kind, or the default."""
    return F.coalesce(
        F.try_element_at(items_of_kind(items, kind), F.lit(-1))["content"], F.lit(default)
    )

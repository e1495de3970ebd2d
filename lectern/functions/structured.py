"""Typed reading of JSON text: a response must match its record type."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The variant type a JSON value must have for each declared leaf type.  A double
# may be written as a whole or a decimal number.
_VARIANT_TYPES = {T.StringType: "STRING", T.BooleanType: "BOOLEAN", T.LongType: "BIGINT"}
_NUMBER = r"^(DOUBLE|FLOAT|BIGINT|DECIMAL.*)$"


def _loose(kind: T.DataType) -> T.DataType:
    """The same shape with every leaf left untyped."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_loose(kind.elementType))
    if type(kind) not in (*_VARIANT_TYPES, T.DoubleType):
        raise TypeError(f"records may not hold {kind.simpleString()}")
    return T.VariantType()


def _matches(value: Column, kind: T.DataType, nullable: bool) -> Column:
    if isinstance(kind, T.StructType):
        inner = [_matches(value[f.name], f.dataType, f.nullable) for f in kind.fields]
        good = value.isNotNull() & reduce(Column.__and__, inner)
        return value.isNull() | good if nullable else good
    if isinstance(kind, T.ArrayType):
        good = F.coalesce(
            F.forall(value, lambda x: _matches(x, kind.elementType, kind.containsNull)),
            F.lit(False),
        )
        return value.isNull() | good if nullable else good
    found = F.schema_of_variant(value)
    fits = found.rlike(_NUMBER) if isinstance(kind, T.DoubleType) else (
        found == _VARIANT_TYPES[type(kind)]
    )
    good = F.coalesce(fits, F.lit(False))
    return good | F.coalesce(found == "VOID", F.lit(True)) if nullable else good


def _typed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_typed(value[f.name], f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _typed(x, kind.elementType))
    return F.try_variant_get(value, "$", kind.simpleString())


def parse_structured(
    df: DataFrame, response: str, schema: T.StructType, parsed: str = "parsed", valid: str = "valid"
) -> DataFrame:
    """Add ``parsed`` (typed struct, null when wrong) and ``valid``.

    Wrong means: not JSON, a required field missing or null, or a value of
    another JSON type.  Unknown fields are ignored.  Leaves are parsed untyped
    first, since a plain ``from_json`` would turn a number into a string field.
    """
    loose = "__loose"
    shaped = df.withColumn(loose, F.from_json(F.col(response), _loose(schema)))
    checked = shaped.withColumn(
        valid, F.coalesce(_matches(F.col(loose), schema, nullable=False), F.lit(False))
    )
    typed = F.when(F.col(valid), _typed(F.col(loose), schema))
    return checked.withColumn(parsed, typed).drop(loose)


def checked_rows(df: DataFrame, check: Column) -> DataFrame:
    """A filter that sees every row.

    Spark moves the filters of later steps past an ordinary filter, down to the
    scan, and the rows they drop would go unchecked.  It does not move them past
    a non-deterministic one, so a row id that is never negative is added.
    """
    return df.where(check & (F.monotonically_increasing_id() >= 0))


def fail_unless(df: DataFrame, condition: Column, message: Column) -> DataFrame:
    """Stop the job at the first row that breaks the condition.

    A filter, so that column pruning cannot skip the check.
    """
    stop = F.raise_error(message).cast("boolean")
    return checked_rows(df, F.when(condition, F.lit(True)).otherwise(stop))

"""Projection of a batch on a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _checked_cast(column: Column, have: T.DataType, want: T.DataType, name: str) -> Column:
    """Cast that fails where a whole number would lose its fraction.

    Overflow and malformed text already fail under ANSI; a fraction would not.
    """
    cast = column.cast(want)
    if isinstance(have, _FRACTIONAL) and isinstance(want, _WHOLE):
        lossy = cast.cast("double") != column.cast("double")
        message = F.concat(F.lit(f"lossy cast of {name}: "), column.cast("string"))
        return F.when(lossy, F.raise_error(message).cast(want)).otherwise(cast)
    return cast


def align_to_schema(df: DataFrame, schema: T.StructType, lossless: bool = True) -> DataFrame:
    """Reorder and cast to ``schema``; missing columns become null, extra ones go.

    ``lossless`` makes fraction-losing casts an error at run time. Matching
    columns pass through untouched, so pruning and pushdown still reach the scan.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        if field.name not in have:
            column = F.lit(None).cast(field.dataType)
        elif have[field.name] == field.dataType:
            column = F.col(f"`{field.name}`")
        elif lossless:
            column = _checked_cast(
                F.col(f"`{field.name}`"), have[field.name], field.dataType, field.name
            )
        else:
            column = F.col(f"`{field.name}`").cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns)

"""Newest row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__rank"


def orderable(dtype: T.DataType) -> bool:
    """Have values of this type an order?"""
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def latest_per_key(df: DataFrame, key: tuple[str, ...], version: str, tie_breakers: tuple[str, ...] | None = None) -> DataFrame:
    """Keep the row with the greatest ``version`` of each key; a NULL version is oldest.

    Equal versions are decided by ``tie_breakers`` (default: all other columns,
    greatest first), so the result does not depend on the order of arrival; columns that hold
    maps or variants have no order, and rows that differ in those alone are a tie.  Spark
    plans a rank limit on both sides of the shuffle: every input task sends on at
    most one row per key, however many rows a hot key has.
    """
    if tie_breakers is None:
        tie_breakers = tuple(
            f.name for f in df.schema.fields if f.name not in key and f.name != version and orderable(f.dataType)
        )
    order = [F.col(c).desc_nulls_last() for c in (version, *tie_breakers)]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)

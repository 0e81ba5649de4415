"""Casts that are safe with ANSI mode on: a cell that cannot be read becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import types as T

_SMALL_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType)


def safe_cast(column: Column, data_type: T.DataType) -> Column:
    """Cast, with NULL for unreadable or out-of-range cells.

    Text such as `173.00` counts as an integer and loses its fraction. A direct
    try_cast would give NULL for it, so integer targets go through a wider number:
    double holds every 32-bit integer exactly, a decimal every 64-bit one.
    """
    if isinstance(data_type, _SMALL_INTEGERS):
        return column.try_cast("double").try_cast(data_type)
    if isinstance(data_type, T.LongType):
        return column.try_cast("decimal(38,18)").try_cast(data_type)
    return column.try_cast(data_type)

"""Shaping a frame: columns kept, named, typed and filled. All narrow, one projection each."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.casting import safe_cast


def run_steps(frame: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply frame functions in order."""
    for step in steps:
        frame = frame.transform(step)
    return frame


def drop_columns(frame: DataFrame, names: Collection[str]) -> DataFrame:
    """Without the named columns; names the frame lacks are ignored."""
    return frame.drop(*names)


def rename_columns(frame: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename many columns in one projection; names the frame lacks are ignored."""
    return frame.withColumnsRenamed(dict(mapping))


def lowercase_names(frame: DataFrame) -> DataFrame:
    """All column names in lower case; an error if two would become the same."""
    lowered = [name.lower() for name in frame.columns]
    clashes = sorted(name for name, n in Counter(lowered).items() if n > 1)
    if clashes:
        raise ValueError(f"columns differ in case only: {clashes}")
    return frame.toDF(*lowered)


def cast_columns(
    frame: DataFrame, types: Mapping[T.DataType, Collection[str]]
) -> DataFrame:
    """Cast columns given as {type: names}; unreadable cells become NULL."""
    return frame.withColumns({
        name: safe_cast(F.col(name), data_type)
        for data_type, names in types.items()
        for name in names
    })


def null_count(columns: Collection[str]) -> Column:
    """Number of NULL cells of a row among some columns."""
    total = F.lit(0)
    for name in columns:
        total = total + F.col(name).isNull().cast("int")
    return total


def keep_rows_with_fewer_nulls(
    frame: DataFrame, limit: int, columns: Collection[str] | None = None
) -> DataFrame:
    """Rows with fewer than `limit` NULL cells."""
    return frame.where(null_count(columns or frame.columns) < limit)


def fill_nulls(frame: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL cells by a constant per column."""
    return frame.na.fill(dict(values))


def fill_false(frame: DataFrame, column: str) -> DataFrame:
    """Replace NULL by false in one boolean column."""
    return frame.na.fill(False, subset=[column])


def drop_rows_with_nulls(frame: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without any NULL cell (among the given columns)."""
    return frame.na.drop(subset=columns)


def query_as(frame: DataFrame, view: str, text: str) -> DataFrame:
    """Run SQL text over a frame under a view name."""
    frame.createOrReplaceTempView(view)
    return frame.sparkSession.sql(text)

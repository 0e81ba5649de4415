"""Cleaning of the two dimension tables of the flights star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallyfold.operators.aggregates import one_row_per_key
from tallyfold.operators.shape import cast_columns, drop_columns


def clean_airports(frame: DataFrame) -> DataFrame:
    """One row per airport code, without the unnamed last column."""
    return one_row_per_key(drop_columns(frame, ["_c2"]), ["AIRPORT"])


def clean_carriers(frame: DataFrame) -> DataFrame:
    """Validity bounds as dates, exact copies of rows removed."""
    dated = cast_columns(frame, {T.DateType(): ("START_DATE_SOURCE", "THRU_DATE_SOURCE")})
    return drop_columns(dated, ["_c4"]).distinct()

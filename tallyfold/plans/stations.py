"""Cleaning of a bike-share stations table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.text import instant_of, split_coordinates
from tallyfold.functions.truth import to_bool_normalised
from tallyfold.operators.shape import cast_columns, rename_columns

# Column names and the words for true and false.
SHORT_COLUMNS = ("number", "Bike Stands", "Available Bike Stands", "Available Bikes")
FLAG_NAMES = {"banking": "has_banking", "bonus": "has_bonus", "status": "is_closed"}
TRUE_WORDS, FALSE_WORDS = ("True", "closed"), ("False", "open")
UPDATED, POSITION = "Last Update", "position"


def clean_stations(frame: DataFrame) -> DataFrame:
    """Counts as shorts, flags as booleans, the update time and the two coordinates."""
    typed = cast_columns(frame, {T.ShortType(): SHORT_COLUMNS}).withColumns({
        **{c: to_bool_normalised(F.col(c), TRUE_WORDS, FALSE_WORDS) for c in FLAG_NAMES},
        UPDATED: instant_of(F.col(UPDATED)),
    })
    return split_coordinates(rename_columns(typed, FLAG_NAMES), POSITION)

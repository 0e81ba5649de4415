"""Text cells: case, coordinates, timestamps with an offset."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: ISO timestamp text with a zone offset.
ISO_WITH_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"


def title_case(column: Column) -> Column:
    """Letters that follow no letter in upper case, all others in lower case: `O'Neil-Smith`."""
    # A zero-width cut between a letter and what is none, so that joining restores the text.
    runs = F.split(column, r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})")
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 2**31 - 1)))), "")


def instant_of(column: Column, pattern: str = ISO_WITH_OFFSET) -> Column:
    """Timestamp from text with an offset; NULL if the text does not fit."""
    return F.try_to_timestamp(column, F.lit(pattern))


def split_coordinates(
    frame: DataFrame,
    column: str,
    separator: str = ",",
    latitude_pos: int = 0,
    longitude_pos: int = 1,
) -> DataFrame:
    """Replace "lat,lon" text by float columns `latitude` and `longitude`.

    The separator is taken literally. A missing or unreadable part gives NULL.
    """
    parts = F.split(F.col(column), re.escape(separator))
    return frame.withColumns({
        "latitude": F.get(parts, F.lit(latitude_pos)).try_cast("float"),
        "longitude": F.get(parts, F.lit(longitude_pos)).try_cast("float"),
    }).drop(column)

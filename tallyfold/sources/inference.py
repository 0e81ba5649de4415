"""Column types of delimited text, found in the one pass that reads the text.

Each cell is of the narrowest kind its text can be read as. What is known of a column is the set of kinds
seen, one whole number; the sets of two tasks join by union, in any order and any number of times, so the
tasks that store the text collect them on the way.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import materialise
from tallyfold.sources.catalog import read_text_table

# Kinds of cells, from the narrowest on; a cell is of the first kind that it can be read as.
INT, LONG, WHOLE, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << i for i in range(8))
NUMBERS = INT | LONG | WHOLE | DOUBLE
# Numbers that are not whole, as Java reads them.
FRACTION = (
    r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[dDfF]?|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+[dDfF]?)\s*$"
    r"|^(NaN|[+-]?Infinity|-?Inf)$"
)
# Digits that a decimal can hold, and those that int and bigint need.
WIDEST, INT_DIGITS, LONG_DIGITS = 38, 10, 20


def whole_digits(cell: Column) -> Column:
    """Digits of a whole number, leading zeros left out."""
    return F.length(F.regexp_extract(cell, r"^[+-]?0*(\d+)\.?$", 1))


def cell_kind(cell: Column) -> Column:
    """The kind of one cell of text; NULL and empty cells are of none (0).

    Days are written 2020-01-31, other texts that Spark reads as points in time are timestamps. Of the words for
    numbers only NaN, Inf and Infinity count, in this spelling, and of those for truth only true and false.
    """
    # Casts that fail cost far more than patterns, so a cast is tried only where it will mostly do.
    plain, short = cell.rlike(r"^[+-]?\d+$"), F.length(cell) <= 18
    fits = F.when(short, cell.try_cast("bigint").between(-(2**31), 2**31 - 1)).otherwise(cell.try_cast("int").isNotNull())
    kinds = (
        (plain & fits, INT),
        (plain & (short | cell.try_cast("bigint").isNotNull()), LONG),
        (cell.rlike(r"^[+-]?\d+\.?$") & (whole_digits(cell) <= WIDEST), WHOLE),
        (cell.rlike(FRACTION), DOUBLE),
        (cell.rlike(r"^\d{4}-\d\d-\d\d$") & cell.try_cast("date").isNotNull(), DATE),
        (F.lower(cell).isin("true", "false"), BOOLEAN),
        (cell.rlike(r"^\s*(T\d|\d{1,2}:|[+-]?\d{4,6}-\d)") & cell.try_cast("timestamp").isNotNull(), TIMESTAMP),
    )
    found = F.when(cell.isNull() | (cell == ""), F.lit(0))
    for test, kind in kinds:
        found = found.when(test, F.lit(kind))
    return found.otherwise(F.lit(TEXT))


def type_of(kinds: int, digits: int = 0) -> str:
    """The narrowest type that holds all kinds of a set; text where they have none in common."""
    if kinds and not kinds & ~NUMBERS:
        if kinds & DOUBLE:
            return "double"
        if kinds & WHOLE:
            least = LONG_DIGITS if kinds & LONG else INT_DIGITS if kinds & INT else 1
            return f"decimal({max(digits, least)},0)"
        return "bigint" if kinds & LONG else "int"
    if kinds and not kinds & ~(DATE | TIMESTAMP):
        return "timestamp" if kinds & TIMESTAMP else "date"
    return "boolean" if kinds == BOOLEAN else "string"


class ColumnTypes:
    """Collects the kinds of a text frame's cells while another action runs over it.

    `watch` gives the frame to go on with; after the action over what was made of it, `found` names the types.
    """

    def __init__(self):
        self._seen = Observation()
        self._names: list[str] = []

    def watch(self, frame: DataFrame) -> DataFrame:
        self._names = frame.columns
        if not self._names:
            return frame
        # Kinds are columns below the metrics, as compiled code makes them; metrics are evaluated one by one.
        known: dict[str, Column] = {}
        for i, name in enumerate(self._names):
            cell = F.col(f"`{name}`")
            known[f"__kinds_{i}"] = cell_kind(cell)
            # Asked for only where a whole number is too long for a bigint, or ends in a point.
            known[f"__digits_{i}"] = F.when((F.length(cell) >= 19) | cell.endswith("."), whole_digits(cell))
        joined = [F.bit_or(c).alias(c) if c.startswith("__kinds") else F.max(c).alias(c) for c in known]
        return frame.withColumns(known).observe(self._seen, *joined).drop(*known)

    def found(self) -> Mapping[str, str]:
        """Type by column. A column without any cell is text."""
        seen = self._seen.get if self._names else {}
        return {name: type_of(seen.get(f"__kinds_{i}") or 0, seen.get(f"__digits_{i}") or 0) for i, name in enumerate(self._names)}


def read_typed(spark: SparkSession, path: str, separator: str = ",", null_token: str | None = None) -> DataFrame:
    """Delimited text with a header line, each column in the narrowest type that holds all its cells.

    The text is read once: the tasks that store its cells in the shared folder also find their kinds. What is
    returned reads the stored columns, only those that are asked for, and casts them. Empty cells are NULL.
    """
    types = ColumnTypes()
    stored = materialise(types.watch(read_text_table(spark, path, separator, null_token=null_token)), "typed")
    return stored.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in types.found().items()])

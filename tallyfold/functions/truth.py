"""Booleans from value sets, and three-valued logic."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_bool(column: Column, true_values: Collection, false_values: Collection) -> Column:
    """True for the one set of values, false for the other, NULL for all else."""
    return (
        F.when(column.isin(*true_values), F.lit(True))
        .when(column.isin(*false_values), F.lit(False))
    )


def to_bool_normalised(
    column: Column,
    true_values: Collection[str] = ("TRUE", "YES"),
    false_values: Collection[str] = ("FALSE", "NO"),
) -> Column:
    """As `to_bool`, blind to case and to surrounding blanks on both sides."""

    def norm(values):
        return sorted({value.strip().upper() for value in values})

    return to_bool(F.upper(F.trim(column)), norm(true_values), norm(false_values))


def kleene(a: Column, b: Column) -> dict[str, Column]:
    """OR, AND and NOT where NULL means "unknown"."""
    return {"a or b": a | b, "a and b": a & b, "not a": ~a}

"""Predicates on closed ranges that may be open at either end (NULL bound)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ranges_overlap(start1: Column, stop1: Column, start2: Column, stop2: Column) -> Column:
    """Whether [start1, stop1] and [start2, stop2] share a point; never NULL.

    The ranges are apart if one begins after the other has ended. Where a NULL
    bound leaves that unknown, the ranges count as overlapping.
    """
    apart = (start1 > stop2) | (stop1 < start2)
    return ~F.coalesce(apart, F.lit(False))


def in_range(point: Column, start: Column, stop: Column) -> Column:
    """Whether a known point lies in [start, stop]; an open end does not limit."""
    return point.isNotNull() & ranges_overlap(point, point, start, stop)


def step_number(column: Column, cuts: Sequence[float]) -> Column:
    """How many of the ascending cuts are at or below a value, by halving; NULL counts none."""

    def steps(first: int, last: int) -> Column:
        if first == last:
            return F.lit(first)
        middle = (first + last + 1) // 2
        return F.when(column >= F.lit(cuts[middle - 1]), steps(middle, last)).otherwise(steps(first, middle - 1))

    return steps(0, len(cuts))

"""Exact order statistics of columns too long for one task.

Spark's exact `median` keeps every distinct value of a column in one buffer. Here a
bounded sketch proposes two pivots close to the wanted rank, one more pass counts the
rows around them, and only rows between the pivots stay in play. Each round keeps a
small share of the rows, so even 10^12 rows need only a few rounds; the rest is small
enough to be sorted in one array.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that may be gathered to finish a search.
GATHER_ROWS = 500_000
# Of the sketch: pivots lie within 1/ACCURACY of the rows from where they should.
ACCURACY = 2_000


@dataclass
class _Search:
    """A wanted rank (from 0) among the `size` values between `low` and `high` (both excluded)."""

    column: str
    rank: int
    size: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def cell(self) -> Column:
        cell = _number(self.column)
        inside = cell.isNotNull()
        if self.low is not None:
            inside = inside & (cell > self.low)
        if self.high is not None:
            inside = inside & (cell < self.high)
        return F.when(inside, cell)


def _number(column: str) -> Column:
    # NaN means "missing" for statistics.
    cell = F.col(column).cast("double")
    return F.when(~F.isnan(cell), cell)


def _by_interval(searches: list[_Search]) -> list[list[_Search]]:
    """Searches among the same values, such as those for the two middle ranks, share work."""
    groups: dict[tuple, list[_Search]] = {}
    for search in searches:
        groups.setdefault((search.column, search.low, search.high), []).append(search)
    return list(groups.values())


def _propose_pivots(frame: DataFrame, groups: list[list[_Search]]) -> list[tuple[float, float]]:
    margin = 5.0 / ACCURACY

    def shares(group: list[_Search]) -> list[float]:
        wanted = [search.rank / search.size for search in group]
        return [max(min(wanted) - margin, 0.0), min(max(wanted) + margin, 1.0)]

    row = frame.agg(*[
        F.percentile_approx(group[0].cell(), shares(group), ACCURACY).alias(f"p{i}")
        for i, group in enumerate(groups)
    ]).first()
    return [tuple(pivots) for pivots in row]


def _narrow(frame: DataFrame, searches: list[_Search]) -> None:
    groups = _by_interval(searches)
    pivots = _propose_pivots(frame, groups)
    counts = []
    for i, (group, (a, b)) in enumerate(zip(groups, pivots)):
        cell = group[0].cell()
        tests = (cell < a, cell <= a, cell < b, cell <= b)
        counts += [F.count(F.when(test, 1)).alias(f"c{i}_{j}") for j, test in enumerate(tests)]
    row = frame.agg(*counts).first()
    for i, (group, (a, b)) in enumerate(zip(groups, pivots)):
        below_a, upto_a, below_b, upto_b = row[4 * i: 4 * i + 4]
        for search in group:
            if search.rank < below_a:
                search.high, search.size = a, below_a
            elif search.rank < upto_a:
                search.value = a
            elif search.rank < below_b:
                search.low, search.high = a, b
                search.rank, search.size = search.rank - upto_a, below_b - upto_a
            elif search.rank < upto_b:
                search.value = b
            else:
                search.low = b
                search.rank, search.size = search.rank - upto_b, search.size - upto_b


def _gather(frame: DataFrame, searches: list[_Search]) -> None:
    # The ranks wanted of one interval are read from one sorted array.
    groups = _by_interval(searches)

    def ranked(group: list[_Search]) -> Column:
        cells = F.sort_array(F.collect_list(group[0].cell()))
        return F.transform(F.array(*[F.lit(s.rank) for s in group]), lambda rank: F.get(cells, rank))

    row = frame.agg(*[ranked(group).alias(f"v{i}") for i, group in enumerate(groups)]).first()
    for group, values in zip(groups, row):
        for search, value in zip(group, values):
            search.value = value


def exact_medians(
    frame: DataFrame, columns: Sequence[str], gather_rows: int = GATHER_ROWS
) -> dict[str, float | None]:
    """Median of each number column, NULL and NaN left out; None for a column without values.

    An even count gives the mean of the two middle values.
    """
    frame = frame.select(*[F.col(c) for c in dict.fromkeys(columns)])
    sizes = frame.agg(*[F.count(_number(c)).alias(c) for c in columns]).first().asDict()
    middle = {
        c: [_Search(c, rank, n) for rank in sorted({(n - 1) // 2, n // 2})]
        for c, n in sizes.items() if n
    }
    todo = [search for searches in middle.values() for search in searches]
    while True:
        few = [s for s in todo if s.size <= gather_rows]
        if few:
            _gather(frame, few)
        todo = [s for s in todo if s.size > gather_rows]
        if not todo:
            break
        _narrow(frame, todo)
        todo = [s for s in todo if s.value is None]
    return {
        c: sum(s.value for s in middle[c]) / len(middle[c]) if c in middle else None
        for c in columns
    }

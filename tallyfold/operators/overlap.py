"""Joins on overlapping ranges, without comparing every pair of rows.

Two ranges overlap exactly if one of them begins inside the other. That turns the
join into "point in range", which a segment tree answers with equality alone: the
line is cut into 2^depth leaves; a range is covered by few tree nodes, a point lies
under one node per level, and exactly one node is common to both if the point is in
the range. Nodes are numbers (root 1, children 2n and 2n+1), so both sides are plain
column expressions and Spark joins them by hash or sort.

- Pair kind A: the right range begins inside the left one, or where it begins.
- Pair kind B: the left range begins inside the right one, after its first leaf.

Every overlapping pair is of one kind only, so no de-duplication is needed. Leaves
are a never-decreasing function of the bound, hence no overlap is lost wherever they
end; pairs that only share a leaf are removed by the exact predicate. Leaves are
narrow where many bounds lie, so a crowded hour does not meet as one leaf.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.ranges import ranges_overlap
from tallyfold.operators.joins import BROADCAST_BYTES, is_small, salted_join
from tallyfold.session import materialise

# Up to this many rows on the right, each left row is simply compared with all of them.
COMPARE_ROWS = 64
# Leaves are about four for each row on the right, between these powers of two. With equality keys of which
# none has more than COMPARE_ROWS rows on the right, there are only as many as the fullest key has rows.
LEAST_DEPTH, MOST_DEPTH = 6, 28
# A right row is at most at two nodes per level as a range and at one as a point.
NODES_PER_LEVEL = 3

# Stretches of the line, equally full, that the leaves are dealt out to.
PIECES = 64

_TICK = "__tick"
_NODE, _FIRST, _LAST, _PIECE = "__node", "__first", "__last", "__piece"


def _tick(frame: DataFrame, name: str) -> Column:
    """A bound as a number, never decreasing in the bound."""
    data_type = frame.schema[name].dataType
    column = F.col(name)
    if isinstance(data_type, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(data_type, T.TimestampNTZType):
        # Whole seconds, without a detour over the session's time zone.
        day = F.unix_date(column.cast("date")).cast("double")
        return day * 86400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    if isinstance(data_type, T.NumericType):
        return column.cast("double")
    raise TypeError(f"cannot place ranges of type {data_type.simpleString()} on a line")


def _cuts(sides) -> tuple[list[float], int]:
    """Ticks between which about equally many bounds of both sides lie, and the right side's rows.

    Found in one job. The outer pieces are thin, so that a few stray bounds take few others along.
    Bounds that are not finite are left out; they lie beyond the ends of the line.
    """
    ticks = [
        frame.select(F.explode(F.array(*[_tick(frame, name) for name in names])).alias("tick"), F.lit(side).alias("side"))
        for side, (frame, names) in enumerate(sides)
    ]
    shares = [0.001, *[i / PIECES for i in range(1, PIECES)], 0.999]
    finite = F.when(F.abs("tick") < F.lit(math.inf), F.col("tick"))
    row = reduce(DataFrame.unionAll, ticks).agg(
        F.percentile_approx(finite, shares, 2_000).alias("cuts"),
        F.min(finite).alias("low"),
        F.max(finite).alias("high"),
        (F.count(F.when(F.col("side") == 1, 1)) / len(sides[1][1])).cast("long").alias("rows"),
    ).first()
    return sorted({*(row["cuts"] or []), row["low"] or 0.0, row["high"] or 0.0}), row["rows"]


def _fullest_key(frame: DataFrame, keys: Sequence[str]) -> int:
    """Rows of the key that has most of them; a key with a NULL meets nothing."""
    rows = frame.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return rows.agg(F.max("rows")).first()[0] or 0


def _with_leaf(frame: DataFrame, name: str, leaf: str, open_leaf: int, cuts: list[float],
               leaves: int) -> DataFrame:
    """Add the leaf of a bound: the piece it lies in, and its place within the piece.

    Every piece gets equally many leaves, so crowded stretches have narrow ones. An
    open end has `open_leaf`. Never decreasing in the bound, and a bound outside all
    pieces belongs to the first or last leaf.
    """
    tick = _tick(frame, name)
    # A bound that is not finite lies at the end of the line. greatest() skips NULLs.
    tick = F.when(tick.isNotNull(), F.least(F.greatest(tick, F.lit(cuts[0])), F.lit(cuts[-1])))
    frame, tick = frame.withColumn(_TICK, tick), F.col(_TICK)
    # A line of few leaves has fewer pieces; what lies beyond the last goes to its end.
    cuts = cuts[::-(-(len(cuts) - 1) // leaves) or 1]
    pieces = max(len(cuts) - 1, 1)
    per_piece = leaves // pieces

    # As SQL text, since building thousands of Column objects one by one takes seconds.
    def piece_of(first: int, last: int) -> str:
        if first == last:
            return str(first)
        middle = (first + last + 1) // 2
        lower, upper = piece_of(first, middle - 1), piece_of(middle, last)
        return f"CASE WHEN {_TICK} < {cuts[middle]!r}D THEN {lower} ELSE {upper} END"

    def numbers(values: list[float]) -> str:
        return "array(" + ", ".join(f"{value!r}D" for value in values) + ")"

    ends = [*cuts[1:], cuts[-1] + 1.0][:pieces]
    widths = [end - begin for begin, end in zip(cuts, ends)]
    frame = frame.withColumn(_PIECE, F.expr(piece_of(0, pieces - 1)))
    piece = F.col(_PIECE)
    begin, width = (F.get(F.expr(numbers(v)), piece) for v in (cuts[:pieces], widths))
    inside = F.floor((tick - begin) / width * per_piece)
    place = F.least(F.greatest(inside, F.lit(0)), F.lit(per_piece - 1)).cast("int")
    # least() and greatest() skip NULLs, so an open end is told apart first.
    found = F.when(tick.isNotNull(), piece * per_piece + place).otherwise(open_leaf)
    return frame.withColumn(leaf, found).drop(_TICK, _PIECE)


def _cover(first: str, last: str, depth: int) -> Column:
    """Fewest tree nodes that together hold the leaves first to last (none if first > last)."""
    size = 1 << depth
    nodes = []
    for level in range(depth + 1):
        begin = f"shiftright({first} + {size + (1 << level) - 1}, {level})"
        end = f"shiftright({last} + {size + 1}, {level})"
        for odd, node in ((begin, begin), (end, f"{end} - 1")):
            nodes.append(f"CASE WHEN {begin} < {end} AND {odd} % 2 = 1 THEN {node} END")
    return F.expr(f"array_compact(array({', '.join(nodes)}))")


def _nodes_above(leaf: Column, levels: list[int], depth: int) -> Column:
    size = 1 << depth
    nodes = [F.shiftright(leaf + size, level) for level in levels]
    return F.array(*nodes).cast("array<int>")


def _levels_in(frame: DataFrame, cover: Column, depth: int) -> list[int]:
    """Levels at which a side's covers have nodes at all: at most depth + 1 flags.

    Short ranges use the lowest levels only, and points then need no other nodes.
    """

    def used(level: int) -> Column:
        at_level = F.exists("cover", lambda node: F.shiftright(node, depth - level) == 1)
        return F.max(at_level).alias(str(level))

    every = range(depth + 1)
    flags = frame.select(cover.alias("cover")).agg(*[used(level) for level in every]).first()
    return [level for level in every if flags[str(level)]]


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    how: str = "inner",
    strategy: str = "auto",
    depth: int | None = None,
    by: Sequence[tuple[str, str]] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
) -> DataFrame:
    """Pairs of rows whose closed ranges overlap (see `ranges_overlap`); inner or left.

    Columns of the two sides have different names. `by` are pairs of columns, left and
    right, that must be equal too, so that the result grows with the data and not with its square.
    Strategies:

    - `compare`: every left row against every right row, right side broadcast. Taken
      by `auto` only for a right side of known small size and COMPARE_ROWS rows.
    - `tree`: equality join on segment-tree nodes, with leaves as many as the right
      side's rows ask for. The right side is broadcast if it is small with all its nodes,
      otherwise both sides shuffle. Ranges may be long, open or inverted.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r} is not supported")
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    small = is_small(right, broadcast_bytes)
    if strategy == "auto":
        strategy = "compare" if small and not by and right.count() <= COMPARE_ROWS else "tree"
    exact = ranges_overlap(*[F.col(c) for c in (*left_range, *right_range)])
    for left_key, right_key in by:
        exact = exact & (F.col(left_key) == F.col(right_key))
    if strategy == "compare":
        if not small:
            raise ValueError("the right side is not of known small size")
        return left.join(F.broadcast(right), exact, how)

    cuts, rows = _cuts([(left, left_range), (right, right_range)])
    if depth is None:
        # Every level is a copy of each row in the shuffle. Where keys leave a row few others to be compared with, however
        # their ranges lie, levels save less than they cost.
        fullest = _fullest_key(right, [r for _, r in by]) if by else rows
        if by and fullest <= COMPARE_ROWS:
            depth = math.ceil(math.log2(max(fullest, 1)))
        else:
            depth = max(LEAST_DEPTH, min(MOST_DEPTH, math.ceil(math.log2(max(rows, 1))) + 2))
    leaves = 1 << depth
    # What is broadcast is a right row for each of its nodes.
    small = is_small(right, broadcast_bytes // (NODES_PER_LEVEL * (depth + 1)))

    def with_leaves(frame: DataFrame, names: tuple[str, str]) -> DataFrame:
        # Columns of their own, as the nodes of all levels refer to them. An open end
        # reaches to the edge of the line.
        frame = _with_leaf(frame, names[0], _FIRST, 0, cuts, leaves)
        return _with_leaf(frame, names[1], _LAST, leaves - 1, cuts, leaves)

    left_leaves, right_leaves = with_leaves(left, left_range), with_leaves(right, right_range)
    first = F.col(_FIRST)
    left_cover, right_cover = _cover(_FIRST, _LAST, depth), _cover(f"{_FIRST} + 1", _LAST, depth)
    every = list(range(depth + 1))
    # Looking up the used levels costs a pass over the bounds; it pays where rows shuffle.
    a_levels = every if small else _levels_in(left_leaves, left_cover, depth)
    b_levels = every if small else _levels_in(right_leaves, right_cover, depth)

    def on_nodes(frame: DataFrame, a_nodes: Column, b_nodes: Column) -> DataFrame:
        # Both kinds of pairs share one join: nodes for kind B are negative.
        nodes = F.concat(a_nodes, F.transform(b_nodes, lambda node: -node))
        return frame.withColumn(_NODE, F.explode(nodes)).drop(_FIRST, _LAST)

    left_nodes = on_nodes(left_leaves, left_cover, _nodes_above(first, b_levels, depth))
    right_nodes = on_nodes(right_leaves, _nodes_above(first, a_levels, depth), right_cover)

    def meet(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
        if small:
            b = b.withColumnRenamed(_NODE, "__right_node")
            match = (a[_NODE] == b["__right_node"]) & exact
            return a.join(F.broadcast(b), match, how).drop(_NODE, "__right_node")
        # Equality keys go into the join's key, under one name on both sides.
        keys = [f"__by{i}" for i in range(len(by))]
        a = a.withColumns({k: F.col(l) for k, (l, _) in zip(keys, by)})
        b = b.withColumns({k: F.col(r) for k, (_, r) in zip(keys, by)})
        return salted_join(a, b, [*keys, _NODE], how, exact, hot_rows=hot_rows).drop(_NODE, *keys)

    matched = meet(left_nodes, right_nodes, "inner")
    if how == "inner":
        return matched

    # A left row is without partner if its range is: rows with equal ranges (and keys) have
    # equal partners. So only ranges are looked up, each once, without listing pairs, and
    # left rows need no unique key.
    asked = [*[l for l, _ in by], *left_range]
    ranges = left_nodes.select(*asked, _NODE).distinct()
    partners = right_nodes.select(*[r for _, r in by], *right_range, _NODE)
    found = meet(ranges, partners if small else partners.distinct(), "left_semi")
    found = materialise(found.select(*asked).distinct(), "overlap-found")
    if is_small(found, broadcast_bytes):
        aliases = {c: f"__found{i}" for i, c in enumerate(asked)}
        found = found.withColumnsRenamed(aliases)
        same = [left[c].eqNullSafe(found[a]) for c, a in aliases.items()]
        lonely = left.join(F.broadcast(found), same, "left_anti")
    else:
        lonely = salted_join(left, found, asked, "left_anti", null_safe=True, hot_rows=hot_rows)
    return matched.unionByName(lonely, allowMissingColumns=True)

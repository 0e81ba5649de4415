"""Group totals, frequencies, one row per key, and column profiles."""

from __future__ import annotations

import math
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.casting import safe_cast
from tallyfold.session import materialise

# Values that a sketch of frequent values follows, and how many of them it lists, the most frequent ones.
TRACKED, LISTED = 12_000, 2_000
# Sketches are joined in so many groups before they are joined to one.
SKETCH_GROUPS = 256
# Types of which values can be sketched and written into a plan.
SKETCHED = (T.StringType, T.IntegralType, T.DateType, T.BooleanType, T.DecimalType)


def group_sum(
    frame: DataFrame, by: Sequence[str], column: str, name: str,
    text_as: T.DataType = T.DoubleType(),  # noqa: B008
) -> DataFrame:
    """Sum per group of a column that may still be text, which is read as `text_as`.

    Cells that cannot be read are left out, like NULL. A decimal type sums exactly.
    """
    column_type = frame.schema[column].dataType
    value = F.col(column)
    if isinstance(column_type, T.StringType):
        value = safe_cast(value, text_as)
    return frame.groupBy(*by).agg(F.sum(value).alias(name))


def group_count(frame: DataFrame, by: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per group."""
    return frame.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def sketch_error(tracked: int = TRACKED) -> float:
    """By which share of the rows, at most, the sketch's count of a value is too high.

    The sketch of frequent items keeps a table of a power of two of places, three quarters of them in use.
    """
    return 3.5 / 2 ** math.ceil(math.log2(tracked / 0.75))


def frequent_candidates(frame: DataFrame, kept: Mapping[str, int], tracked: int = TRACKED) -> dict[str, list]:
    """For columns given as {column: k}, values that hold the k most frequent ones for certain.

    One pass makes a sketch of bounded size per task, joined in two steps. Its count of a value is at most e
    too high, where e is `sketch_error` times the rows. It lists values it has counted more than e times for certain,
    up to `LISTED`, the highest first. A value that is not listed thus occurs 2e times at most or, if the list is
    full, no more often than its last count says. Where the k-th count, less e, is higher, the list holds the k
    most frequent values, ties included. Columns where that is not so, or whose type has no sketch, are left out.
    """
    listed = min(LISTED, tracked)
    able = [c for c in kept if isinstance(frame.schema[c].dataType, SKETCHED) and 0 < kept[c] < listed]
    if not able:
        return {}

    def cells(i: int, name: str) -> Column:
        return F.expr(f"approx_top_k_accumulate(c{i}, {tracked}) FILTER (WHERE c{i} IS NOT NULL)").alias(name)

    columns = frame.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(able)])
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("part")
    parts = columns.withColumn("part", part).groupBy("part").agg(*[
        figure for i in range(len(able)) for figure in (F.count(f"c{i}").alias(f"n{i}"), cells(i, f"s{i}"))])
    # Sketches without values have no type and join with none, so columns that hold any are found out first.
    parts = materialise(parts, "sketches")
    rows = parts.agg(*[F.sum(f"n{i}") for i in range(len(able))]).first()
    full = [i for i in range(len(able)) if rows[i]]
    if not full:
        return dict.fromkeys(able, [])
    row = parts.agg(*[F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(s{i}, {tracked}) FILTER (WHERE n{i} > 0), {listed})").alias(f"top{i}")
        for i in full]).first()
    found = {}
    for i, column in enumerate(able):
        top, error = row[f"top{i}"] if i in full else [], sketch_error(tracked) * (rows[i] or 0)
        unlisted = max(2 * error, top[-1]["count"] if len(top) == listed else 0)
        least = top[kept[column] - 1]["count"] - error if len(top) >= kept[column] else 0
        # A value that is not listed and occurs less than once is none.
        if least > unlisted or unlisted < 1:
            # What occurs less often than the k-th value does at least is out of the question.
            found[column] = [item["item"] for item in top if item["count"] >= least]
    return found


def most_frequent(frame: DataFrame, column: str, k: int, sketch: bool = True) -> DataFrame:
    """The k most frequent non-NULL values with their counts; ties go to the lower value.

    Where a sketch proves which values can be among them, only these are counted, so the shuffle does not grow
    with the number of values; else, or without `sketch`, all are.
    """
    known = frequent_candidates(frame, {column: k}).get(column) if sketch else None
    wanted = F.col(column).isNotNull() if known is None else F.col(column).isin(known)
    counts = group_count(frame.where(wanted), [column])
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(k)


def value_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts of the non-NULL values of some columns as text, as rows (column, value, count).

    All columns in one pass. Counts combine on the map side, so no task holds all
    cells of a frequent value.
    """
    cells = frame.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("cell")).select("cell.*")
    return group_count(cells.where("value is not null"), ["column", "value"])


def modes(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent non-NULL value of each column as rows (column, value as text, count).

    Ties go to the lower value in the column's own order: 9 before 10 in a number column.
    """
    counts = value_counts(frame, columns)
    numbers = [c for c in columns if isinstance(frame.schema[c].dataType, T.NumericType)]
    number = F.when(F.col("column").isin(*numbers), F.col("value").try_cast("decimal(38,10)"))
    best = F.min(F.struct((-F.col("count")).alias("rank"), number.alias("number"), "value")).alias("best")
    return counts.groupBy("column").agg(best).select(
        "column", F.col("best.value").alias("value"), (-F.col("best.rank")).alias("count")
    )


def one_row_per_key(
    frame: DataFrame, key: Sequence[str], order: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key: the first by `order`, by default the least in all other columns.

    Spark's group limit keeps only the first row per key and task before the shuffle,
    so a key with very many rows still sends few.
    """
    order = list(order or [c for c in frame.columns if c not in key] or key)
    ranked = Window.partitionBy(*key).orderBy(*order)
    return frame.withColumn("__rank", F.row_number().over(ranked)).where("__rank = 1").drop("__rank")


def describe_columns(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of non-NULL cells, mean, sample deviation, least and greatest, all as text."""
    return frame.describe(*columns)


def column_profile(
    frame: DataFrame, expected: Mapping[str, T.DataType] | None = None,
    unknown: Mapping[str, Collection[str]] | None = None,
) -> DataFrame:
    """Missing and unusable cells per column, as rows (column, rows, missing, uncastable, unknown).

    `expected` names the type a text column should be read as, `unknown` the cells that
    stand for "not known". One pass with partial aggregation, whatever the number of
    columns.
    """
    expected, unknown = expected or {}, unknown or {}

    def times(condition: Column) -> Column:
        return F.count(F.when(condition, 1))

    def figures(name: str) -> Column:
        cell = F.col(f"`{name}`")
        bad = F.lit(0).cast("long")
        if name in expected:
            bad = times(cell.isNotNull() & safe_cast(cell, expected[name]).isNull())
        odd = F.lit(0).cast("long")
        if unknown.get(name):
            odd = times(cell.isin(*unknown[name]))
        return F.struct(
            F.lit(name).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            times(cell.isNull()).alias("missing"),
            bad.alias("uncastable"),
            odd.alias("unknown"),
        )

    totals = frame.agg(F.array(*[figures(name) for name in frame.columns]).alias("figures"))
    return totals.select(F.explode("figures").alias("f")).select("f.*")


def schema_profile(frame: DataFrame) -> DataFrame:
    """Name, type and nullability of each column as rows; the data is not read."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(frame.schema)]
    schema = "position int, column string, type string, nullable boolean"
    return frame.sparkSession.createDataFrame(rows, schema)

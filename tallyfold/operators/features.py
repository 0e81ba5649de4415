"""Feature preparation. Statistics are small rows learnt in one pass; applying them is narrow."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.aggregates import frequent_candidates, modes, value_counts
from tallyfold.operators.joins import keyed_join, salted_join
from tallyfold.operators.quantiles import GATHER_ROWS, exact_medians
from tallyfold.session import materialise

# One column per value makes a usable table up to this many; beyond, values go into one
# sparse vector, for which the number of values does not matter.
WIDEST = 5_000


def recode(column: Column, groups: Mapping[str, Collection[str]], other: str) -> Column:
    """Group name for listed values, `other` for the rest and for NULL."""
    value = F.lit(other)
    for name, members in groups.items():
        value = F.when(column.isin(*members), F.lit(name)).otherwise(value)
    return value


def keep_most_frequent(
    frame: DataFrame, kept: Mapping[str, int], other: str = "Other"
) -> DataFrame:
    """Replace all but the k most frequent values of text columns, given as {column: k}.

    Ties go to the lower value; NULL counts as other. One pass counts for all columns. In columns where a sketch
    proves which values can be among them, no others are counted.
    """
    ranked = Window.partitionBy("column").orderBy(F.desc("count"), "value")
    texts = frame.select(*[F.col(c).cast("string").alias(c) for c in kept])
    known = frequent_candidates(texts, kept)
    texts = texts.withColumns({c: F.when(F.col(c).isin(values), F.col(c)) for c, values in known.items()})
    best = value_counts(texts, list(kept)).withColumn("rank", F.row_number().over(ranked))
    wanted = F.lit(0)
    for column, k in kept.items():
        wanted = F.when(F.col("column") == column, F.lit(k)).otherwise(wanted)
    top: dict[str, list[str]] = {column: [] for column in kept}
    # The constant limit lets Spark rank before the shuffle; the rest depends on the column.
    best = best.where(F.col("rank") <= max(kept.values())).where(F.col("rank") <= wanted)
    for row in best.collect():
        top[row["column"]].append(row["value"])
    return frame.withColumns({
        column: F.when(F.col(column).isin(*values), F.col(column)).otherwise(F.lit(other))
        for column, values in top.items()
    })


def label_vocabulary(frame: DataFrame, column: str, separator: str = "|") -> DataFrame:
    """Labels that occur in delimited lists, in their order, as rows (value, position)."""
    labels = frame.select(F.explode(_labels(column, separator)).alias("value"))
    return _numbered(labels.where("value <> ''").distinct())


def _numbered(values: DataFrame) -> DataFrame:
    """Distinct values with their position in sorted order, written once.

    Ranges of values are numbered side by side, each from where the ones before it end,
    so no task holds all values.
    """
    ranged = materialise(values.repartitionByRange("value").sortWithinPartitions("value").select(
        "value", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")), "values")
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))
    # One row per task of the range shuffle.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", "first_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    numbered = ranged.join(parts, "part").select(
        "value", (F.col("start") + F.col("id") - F.col("first_id")).alias("position"))
    return materialise(numbered, "vocabulary")


def listed(vocabulary: DataFrame, widest: int = WIDEST) -> list[str] | None:
    """The values of a vocabulary in order, or None if they are more than make columns."""
    rows = vocabulary.orderBy("position").limit(widest + 1).collect()
    return [row["value"] for row in rows] if len(rows) <= widest else None


def few_values(values: DataFrame, widest: int = WIDEST) -> list[str] | None:
    """The distinct values of a frame's column `value` in order, or None if they are more than make columns.

    One job, which stops at one value more; no vocabulary is written for columns that need none.
    """
    rows = values.select("value").distinct().limit(widest + 1).collect()
    return sorted(r["value"] for r in rows) if len(rows) <= widest else None


def label_indicators(frame: DataFrame, column: str, key: Sequence[str], separator: str = "|",
                     prefix: str = "", without: Collection[str] = (), widest: int = WIDEST) -> DataFrame:
    """One 0/1 column per label of a delimited list; more labels than `widest` go into one sparse vector instead.

    The vector is `<column>_vector`, see `indicator_vector`; `key` identifies a row for it. Labels named
    in `without` have no column or entry.
    """
    labels = frame.select(F.explode(_labels(column, separator)).alias("value")).where("value <> ''")
    labels = labels.where(~F.col("value").isin(*without)) if without else labels
    found = few_values(labels, widest)
    if found is not None:
        return add_label_indicators(frame, column, found, separator, prefix)
    return indicator_vector(frame, column, _numbered(labels.distinct()), key, separator)


def one_hot_columns(frame: DataFrame, columns: Sequence[str], key: Sequence[str], drop_first: bool = True,
                    widest: int = WIDEST) -> DataFrame:
    """Replace each column by 0/1 columns, or by a sparse vector `<column>_vector` if it has more values than `widest`.

    The first value is left out either way, so all zeros or no entry stand for it. All values are found in one job.
    """
    counts = value_counts(frame, columns).select("column", "value")
    ranked = counts.withColumn("place", F.row_number().over(Window.partitionBy("column").orderBy("value")))
    found: dict[str, list[str]] = {c: [] for c in columns}
    # The limit lets Spark drop what is beyond it before the shuffle.
    for row in ranked.where(F.col("place") <= widest + 1).collect():
        found[row["column"]].append(row["value"])
    for column, values in found.items():
        if len(values) <= widest:
            frame = one_hot(frame, column, sorted(values), drop_first)
        else:
            own = counts.where(F.col("column") == column).select("value")
            own = own.where(F.col("value") > min(values)) if drop_first else own
            frame = indicator_vector(frame, column, _numbered(own), key).drop(column)
    return frame


def indicator_vector(
    frame: DataFrame, column: str, vocabulary: DataFrame, key: Sequence[str],
    separator: str | None = None, name: str | None = None,
) -> DataFrame:
    """The column's values as one sparse vector: a struct of size, indices and values.

    For vocabularies of any size. `key` identifies a row. With `separator` the column
    holds lists. NULL and values not in the vocabulary have no entry.
    """
    name = name or f"{column}_vector"
    values = F.array_distinct(_labels(column, separator)) if separator else F.array(column)
    cells = frame.select(*key, F.explode(values).alias("value"))
    found = keyed_join(cells, vocabulary, ["value"]).groupBy(*key).agg(
        F.array_sort(F.collect_list(F.col("position").cast("long"))).alias("__indices"))
    size = vocabulary.count()
    indices = F.coalesce("__indices", F.array().cast("array<bigint>"))
    joined = salted_join(frame, found, list(key), "left", null_safe=True)
    return joined.withColumn(name, F.struct(
        F.lit(size).cast("long").alias("size"), indices.alias("indices"),
        F.transform(indices, lambda _: F.lit(1.0)).alias("values"),
    )).drop("__indices")


def _labels(column: str, separator: str) -> Column:
    return F.split(F.col(column), re.escape(separator))


def add_label_indicators(
    frame: DataFrame, column: str, vocabulary: Sequence[str], separator: str = "|",
    prefix: str = "",
) -> DataFrame:
    """One 0/1 column per label of a delimited list; a NULL list has none."""
    labels = _labels(column, separator)
    return frame.withColumns({
        prefix + label: F.coalesce(F.array_contains(labels, label), F.lit(False)).cast("int")
        for label in vocabulary
    })


def category_values(frame: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Values of each text column in order, NULL left out, as rows (value, position)."""
    counts = materialise(value_counts(frame, columns), "values")
    return {c: _numbered(counts.where(F.col("column") == c).select("value")) for c in columns}


def one_hot(
    frame: DataFrame, column: str, values: Sequence[str], drop_first: bool = True
) -> DataFrame:
    """Replace a column by 0/1 columns `<column>_<value>`, the first value left out.

    All are 0 for the first value, for NULL and for a value not listed.
    """
    kept = values[1:] if drop_first else values
    return frame.withColumns({
        f"{column}_{value}": F.coalesce(F.col(column) == value, F.lit(False)).cast("int")
        for value in kept
    }).drop(column)


def learn_fill_values(
    frame: DataFrame,
    mode_columns: Sequence[str] = (),
    median_columns: Sequence[str] = (),
    gather_rows: int = GATHER_ROWS,
) -> dict[str, object]:
    """Exact modes (lowest value on ties) and medians, as {column: value}."""
    values: dict[str, object] = {}
    if mode_columns:
        values |= {row["column"]: row["value"] for row in modes(frame, mode_columns).collect()}
    if median_columns:
        values |= exact_medians(frame, median_columns, gather_rows)
    return {column: value for column, value in values.items() if value is not None}


def impute(frame: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill missing cells with learnt values; number columns become double, NaN counts as missing."""
    numbers = [c for c, v in values.items() if isinstance(v, float)]
    missing = F.lit(None).cast("double")
    frame = frame.withColumns({c: F.nanvl(F.col(c).cast("double"), missing) for c in numbers})
    return frame.na.fill(dict(values))


def learn_scale(frame: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column, in one pass."""
    row = frame.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("deviation")).alias(c)
        for c in columns
    ]).first()
    return {c: (row[c]["mean"], row[c]["deviation"]) for c in columns}


def standardise(frame: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(value - mean) / deviation; a constant column becomes 0, one without values stays NULL."""

    def scaled(column: str, mean: float | None, deviation: float | None) -> Column:
        if mean is None:
            return F.lit(None).cast("double")
        return (F.col(column).cast("double") - mean) / (deviation or 1.0)

    return frame.withColumns({c: scaled(c, *stats) for c, stats in scale.items()})


def split_bucket(key: Sequence[str], seed: int) -> Column:
    """Number from 0 to 9999 drawn from a row's key and a seed: the same on every run."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 10_000


def split_by_key(
    frame: DataFrame, key: Sequence[str], train_share: float, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows.

    A row's side depends on its key alone, so unlike a random split it holds when
    tasks are run again or the data is partitioned differently, and copies of a key
    never end up on both sides.
    """
    limit = round(train_share * 10_000)
    bucket = split_bucket(key, seed)
    return frame.where(bucket < limit), frame.where(bucket >= limit)

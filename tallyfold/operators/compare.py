"""Comparison of two tables as multisets of rows, on the cluster."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Buckets of rows whose sums are compared. Those that differ are broadcast: 8 bytes for each, 0.5 MB at most.
BUCKETS = 2**16

logger = logging.getLogger(__name__)


def schema_difference(left: DataFrame, right: DataFrame, check_nullability: bool = True) -> set:
    """Fields that only one of two frames has, whatever their order."""

    def fields(frame: DataFrame) -> set:
        if check_nullability:
            return {(f.name, f.dataType.simpleString(), f.nullable) for f in frame.schema}
        return {(f.name, f.dataType.simpleString()) for f in frame.schema}

    return fields(left) ^ fields(right)


def _row_digests(columns: list[str]) -> list[Column]:
    """Two hashes of a row by different functions. A null counts as such, so that (null, 1) differs from (1, null)."""
    cells = [F.col(f"`{c}`") for c in columns]
    marks = F.concat(F.lit(""), *[F.when(c.isNull(), "0").otherwise("1") for c in cells])
    return [F.xxhash64(marks, *cells), F.hash(marks, *reversed(cells)).cast("long")]


def unlike_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Column `bucket`: the buckets of rows, dealt by hash, that differ between two frames.

    What a bucket holds is summed up, in any order: its rows, and its rows' two hashes in both halves. Each
    side adds, the other takes away, so a bucket whose sums are all zero holds the same rows. A task
    hands on one row per bucket, however many rows it read.
    """
    columns = left.columns
    first, second = _row_digests(columns)

    def signed(frame: DataFrame, sign: int) -> DataFrame:
        low = F.lit(2**32 - 1).cast("long")
        return frame.select(
            F.pmod(first, F.lit(buckets)).alias("bucket"), F.lit(sign).cast("long").alias("n"),
            *[(F.lit(sign).cast("long") * part).alias(f"h{i}") for i, part in enumerate((
                first.bitwiseAND(low), F.shiftright(first, 32), second))])

    sums = signed(left, 1).unionByName(signed(right, -1)).groupBy("bucket").agg(
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("n", "h0", "h1", "h2")])
    return sums.where("n <> 0 OR h0 <> 0 OR h1 <> 0 OR h2 <> 0").select("bucket")


def frame_diff(left: DataFrame, right: DataFrame, by_digest: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """Rows that do not occur equally often in both, with their number in each.

    NULLs compare equal; columns are matched by name. Rows are dealt into buckets by hash and only those of
    buckets that differ are grouped, so equal tables shuffle one row per task and bucket and no text of
    theirs. Rows grouped are compared whole; a bucket counts as equal by its number of rows and 96 bits of
    sums. Columns that cannot be hashed, or `by_digest=False`, group all rows in one aggregation.
    """
    columns = left.columns
    if by_digest and not any(isinstance(f.dataType, (T.MapType, T.VariantType)) for f in left.schema):
        unlike = F.broadcast(unlike_buckets(left, right, buckets))
        bucket = F.pmod(_row_digests(columns)[0], F.lit(buckets)).alias("__bucket")
        left, right = (
            f.select(*[F.col(f"`{c}`") for c in columns], bucket)
            .join(unlike, F.col("__bucket") == F.col("bucket"), "left_semi").drop("__bucket") for f in (left, right))
    both = left.withColumn("in_left", F.lit(1)).unionByName(right.withColumn("in_left", F.lit(0)))
    return (
        both.groupBy(*columns)
        .agg(
            F.sum("in_left").alias("left_rows"),
            F.sum(1 - F.col("in_left")).alias("right_rows"),
        )
        .where("left_rows <> right_rows")
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return frame_diff(left, right).isEmpty()


def assert_same_frames(left: DataFrame, right: DataFrame, check_nullability: bool = True) -> None:
    """Fail unless both have the same columns and rows; order of either is ignored.

    Schemas are compared first, as that reads no data.
    """
    difference = schema_difference(left, right, check_nullability)
    if difference:
        logger.warning("left: %s", left.schema.simpleString())
        logger.warning("right: %s", right.schema.simpleString())
        raise AssertionError(f"schemas differ in {sorted(difference)}")
    sample = frame_diff(left, right).limit(5).collect()
    if sample:
        raise AssertionError(f"rows differ, for example {sample}")

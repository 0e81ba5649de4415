"""Exact dedup: sorted digest runs of the partitions, merged in a tree.

Every partition of the input makes a run: its digests with the row that stays and the
number of rows of each. In each round, `fan_in` neighbouring runs are merged into one, so
the number of runs falls to the next power below until one is left. A round is a
grouping on (run, digest): runs are merged side by side, each spread by digest, and
a digest with very many copies has one row per run, never one per copy.

"Verified": rows are equal only if SHA-256, length in bytes and a second, unlike hash of
the text agree.

Defined cases: a null text counts as empty; of equal texts one row stays, that with the
largest id (or smallest, by choice), null ids last; among rows with the same id and text
the one with the larger hash of its other columns, so that fully equal rows leave exactly
one; an empty table gives an empty result; columns named as those of the result are
replaced by them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.joins import is_small, keyed_join
from tallyfold.session import materialise

KEYS = ["__sha", "__bytes", "__check"]


def _digests(text: str) -> dict[str, Column]:
    filled = F.coalesce(F.col(text), F.lit(""))
    return {"__sha": F.unhex(F.sha2(filled, 256)), "__bytes": F.octet_length(filled).cast("long"),
            "__check": F.xxhash64(filled)}


def _row_hash(docs: DataFrame, without: set[str]) -> Column:
    """A hash of a row's other columns, to tell rows with the same id and text apart."""
    plain = [f.name for f in docs.schema if f.name not in without and "map" not in f.dataType.simpleString()
             and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(plain)]) if plain else F.lit(0).cast("long")


def digest_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Level 0: id, digest, row hash, and the partition that is the row's run. Written once."""
    keyed = docs.select(
        F.col(id).alias("doc_id"), _row_hash(docs, {id, text}).alias("__row"),
        F.monotonically_increasing_id().alias("__at"),
        F.spark_partition_id().alias("__run"), *[c.alias(n) for n, c in _digests(text).items()],
    )
    return materialise(keyed, "digest-runs")


def merge_runs(runs: DataFrame, keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """One row per digest: the row that stays (id, row hash, place) and the rows it stands for."""
    best = F.max if keep == "largest" else F.min
    # Null ids come last either way: a flag in front of the id.
    known = F.col("doc_id").isNotNull() if keep == "largest" else F.col("doc_id").isNull()
    level = runs.groupBy("__run", *KEYS).agg(
        best(F.struct(known.alias("known"), F.col("doc_id").alias("id"), "__row", "__at")).alias("__best"),
        F.count(F.lit(1)).alias("group_size"),
    )
    last = runs.agg(F.max("__run")).first()[0] or 0
    for _ in range(max(1, math.ceil(math.log(last + 1, fan_in) - 1e-9))):
        level = (
            level.withColumn("__run", F.expr(f"__run div {fan_in}").cast("int"))
            .groupBy("__run", *KEYS)
            .agg(best("__best").alias("__best"), F.sum("group_size").alias("group_size"))
        )
    return level.select(*KEYS, "__best", "group_size")


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest",
                 fan_in: int = 8) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    runs = digest_runs(docs, id, text)
    merged = materialise(merge_runs(runs, keep, fan_in), "digest-tree")
    # Digests of single rows need no partner: they are told from the rest by a look-up
    # of groups only, and a group's row count never meets in one task.
    groups = merged.where("group_size > 1")
    joined = keyed_join(runs, groups, KEYS, "left")
    return joined.select(
        "doc_id",
        F.when(F.col("__best").isNull(), F.col("doc_id")).otherwise(F.col("__best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("__best").isNull() | (F.col("__best.__at") == F.col("__at"))).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", keep: str = "largest",
                fan_in: int = 8) -> DataFrame:
    """The rows of `docs` that stay, with their columns.

    Only rows of groups are looked up. A kept row is known by id, digest and row hash;
    rows alike in all three are equal in all columns that can be compared, and one stays.
    """
    runs = digest_runs(docs, id, text)
    merged = materialise(merge_runs(runs, keep, fan_in), "digest-tree")
    groups = merged.where("group_size > 1").select(
        *KEYS, F.col("__best.id").alias("__id"), F.col("__best.__row").alias("__best_row"))
    keyed = docs.withColumns(_digests(text) | {"__row": _row_hash(docs, {id, text})})
    joined = keyed_join(keyed, groups.withColumn("__grouped", F.lit(True)), KEYS, "left")
    stays = joined.where(F.col("__grouped").isNull() | (
        F.col(id).eqNullSafe(F.col("__id")) & (F.col("__row") == F.col("__best_row"))))
    if is_small(groups):
        # The look-up moved no text; only the few rows that stay of groups move.
        one = stays.where("__grouped").dropDuplicates(KEYS)
        stays = stays.where("__grouped IS NULL").unionByName(one)
    else:
        stays = stays.dropDuplicates(KEYS)
    return stays.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Equality joins that pick broadcast or shuffle by size and do not choke on hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.ranges import in_range, step_number
from tallyfold.session import materialise

# A side is broadcast only if Spark's own size estimate for it is below this.
BROADCAST_BYTES = 16 * 1024 * 1024
UNKNOWN_BYTES = 2**63 - 1
# A key is hot from this many rows on; its rows are spread over tasks of that size.
HOT_ROWS = 1_000_000
# Pieces that the dates of a large dimension are cut into, equally full.
SLOTS = 256

_ROWS, _PARTS = "__rows", "__parts"
_LEFT_PART, _LEFT_PARTS = "__left_part", "__left_parts"
_RIGHT_PART, _RIGHT_PARTS = "__right_part", "__right_parts"


def estimated_bytes(frame: DataFrame) -> int:
    """Spark's size estimate for a frame, taken from its plan without running a job.

    For a stored table this is the size of its files, which are compressed; projections
    and filters do not lower it, and a join counts as the product of its sides. A frame
    whose plan cannot be asked counts as huge, as does one of unknown size.
    """
    plan = getattr(frame, "_jdf", None)
    if plan is None:
        return UNKNOWN_BYTES
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(frame: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return estimated_bytes(frame) <= limit


def hot_keys(frame: DataFrame, on: Sequence[str], hot_rows: int) -> DataFrame:
    """Keys with at least `hot_rows` rows and the number of parts each is split into.

    The count combines on the map side, so a hot key costs one row per task. There are at
    most as many hot keys as the frame has times `hot_rows` rows. No key has more
    parts than a shuffle has tasks.
    """
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    counted = frame.groupBy(*on).agg(F.count(F.lit(1)).alias(_ROWS)).where(F.col(_ROWS) >= hot_rows)
    parts = F.least(F.ceil(F.col(_ROWS) / hot_rows), F.lit(tasks)).cast("int")
    return counted.select(*on, parts.alias(_PARTS))


def _same(left: DataFrame, right: DataFrame, pairs, null_safe: bool) -> Column:
    def equal(l, r):
        return left[l].eqNullSafe(right[r]) if null_safe else left[l] == right[r]

    return reduce(and_, [equal(l, r) for l, r in pairs])


def _plain_join(left, right, on, how, condition, null_safe) -> DataFrame:
    aliases = {name: f"__right{i}" for i, name in enumerate(on)}
    right = right.withColumnsRenamed(aliases)
    match = _same(left, right, list(aliases.items()), null_safe)
    if condition is not None:
        match = match & condition
    return left.join(right, match, how).drop(*aliases.values())


def _hot_keys_of_both(left, right, on, hot_rows) -> DataFrame:
    """Hot keys with the number of parts for the left and for the right rows of each.

    Written once: both sides of the join then split by the same list, and what the
    counted frames are made of is not computed again with it.
    """
    both = hot_keys(left, on, hot_rows).withColumnRenamed(_PARTS, _LEFT_PARTS).unionByName(
        hot_keys(right, on, hot_rows).withColumnRenamed(_PARTS, _RIGHT_PARTS),
        allowMissingColumns=True,
    )
    most = [F.coalesce(F.max(c), F.lit(1)).alias(c) for c in (_LEFT_PARTS, _RIGHT_PARTS)]
    return materialise(both.groupBy(*on).agg(*most), "hot-keys")


def _split_join(left, right, on, how, condition, null_safe, hot, spread) -> DataFrame:
    """The join on keys and parts; a row of a side is repeated for each part of the other."""
    keys = hot.toDF(*[f"__hot{i}" for i in range(len(on))], _LEFT_PARTS, _RIGHT_PARTS)
    keys = F.broadcast(keys) if is_small(hot) else keys
    pairs = [(name, f"__hot{i}") for i, name in enumerate(on)]

    def with_parts(frame: DataFrame) -> DataFrame:
        return frame.join(keys, _same(frame, keys, pairs, True), "left").drop(*[name for _, name in pairs])

    def own_part(frame: DataFrame, parts: str) -> Column:
        columns = [F.col(f"`{c}`") for c in (frame.columns if spread is None else spread) if c in frame.columns]
        return F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.coalesce(F.col(parts), F.lit(1))).cast("int")

    def every_part(parts: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(parts), F.lit(1)) - 1))

    placed_left = with_parts(left).withColumn(_LEFT_PART, own_part(left, _LEFT_PARTS))
    placed_right = with_parts(right).withColumn(_LEFT_PART, every_part(_LEFT_PARTS))
    part_columns = [_LEFT_PART]
    if how == "inner":
        placed_left = placed_left.withColumn(_RIGHT_PART, every_part(_RIGHT_PARTS))
        placed_right = placed_right.withColumn(_RIGHT_PART, own_part(right, _RIGHT_PARTS))
        part_columns.append(_RIGHT_PART)
    joined = _plain_join(
        placed_left.drop(_LEFT_PARTS, _RIGHT_PARTS), placed_right.drop(_LEFT_PARTS, _RIGHT_PARTS),
        [*on, *part_columns], how, condition, null_safe,
    )
    return joined.drop(*part_columns)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    null_safe: bool = False,
    hot_rows: int | None = None,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle join on `on`.

    By default Spark's adaptive execution splits large partitions while it runs, which
    needs no further pass. With `hot_rows`, keys with that many rows are found first,
    in one job, and split by plan: the rows of a hot key fall into parts, and the other
    side's rows of that key are repeated once per part, so every pair still meets once. For
    an inner or left join this holds for keys hot on either side (a left join whose right side has
    hot keys is an inner and an anti join); for semi and anti joins without a condition the
    right needs each key once only.

    A row's part is a hash of the number of the task that holds it and of its `spread`
    columns, by default all of them, so clustered keys and copies in different tasks
    spread, and a task run again after an executor is lost gives the same parts, which
    random ones would not.

    Both sides use the column names in `on`; the result has the left's.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type {how!r} cannot be split")
    on = list(on)
    if how in ("left_semi", "left_anti") and condition is None:
        right = right.select(*on).distinct()
    if hot_rows is None:
        return _plain_join(left, right, on, how, condition, null_safe)
    hot = _hot_keys_of_both(left, right, on, hot_rows)
    if how == "left" and condition is None and not hot.where(F.col(_RIGHT_PARTS) > 1).isEmpty():
        matched = _split_join(left, right, on, "inner", None, null_safe, hot, spread)
        lonely = _split_join(left, right.select(*on).distinct(), on, "left_anti", None, null_safe, hot, spread)
        return matched.unionByName(lonely, allowMissingColumns=True)
    return _split_join(left, right, on, how, condition, null_safe, hot, spread)


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    null_safe: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
    right_bytes: int | None = None,
) -> DataFrame:
    """Equality join on columns both sides have, listed once in the result.

    NULL keys match nothing, or each other with `null_safe`. A right side of known
    small size is broadcast; otherwise see `salted_join`. `right_bytes` is a bound for the
    right's size where the caller knows a better one than Spark's estimate, which
    multiplies the sides of a join.
    """
    small = is_small(right, broadcast_bytes) if right_bytes is None else right_bytes <= broadcast_bytes
    if not small:
        return salted_join(left, right, on, how, null_safe=null_safe, hot_rows=hot_rows)
    return _plain_join(left, F.broadcast(right), list(on), how, None, null_safe)


def attach_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    names: dict[str, str],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
    dimension_bytes: int | None = None,
    check: bool = True,
) -> DataFrame:
    """Left join of dimension columns, chosen and named by {dimension column: new name}.

    With `check`, a dimension with several rows for a key is refused, so that no fact
    doubles; leave it out for a key that is unique by construction. A dimension can be
    attached several times under different names, and each attachment reads the facts once.
    """
    if check:
        rows = dimension.where(F.col(dimension_key).isNotNull()).groupBy(dimension_key).agg(F.count(F.lit(1)).alias(_ROWS))
        if not rows.where(F.col(_ROWS) > 1).isEmpty():
            raise ValueError(f"several rows have the same {dimension_key!r}")
    slim = dimension.select(
        F.col(dimension_key).alias(fact_key),
        *[F.col(old).alias(new) for old, new in names.items()],
    )
    return keyed_join(facts, slim, [fact_key], "left", broadcast_bytes=broadcast_bytes,
                      hot_rows=hot_rows, right_bytes=dimension_bytes)


def overlapping_validity(
    dimension: DataFrame, keys: Sequence[str], start: str, stop: str
) -> DataFrame:
    """Dimension rows that begin before an earlier row of the same key has ended.

    Empty for a dimension fit for `valid_at_join`. The earlier rows of a key are
    compared by their latest end, one running value per key.
    """
    earlier = Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first(), F.col(stop))
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return (
        dimension.withColumn("__latest", F.max(stop).over(earlier))
        .withColumn("__open", F.max(F.col(stop).isNull()).over(earlier))
        .where(F.col("__open") | (F.col(start) <= F.col("__latest"))
               | (F.col(start).isNull() & F.col("__open").isNotNull()))
        .drop("__latest", "__open")
    )


def valid_at_join(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    fact_date: str,
    dimension_key: str,
    start: str,
    stop: str,
    names: dict[str, str],
    check: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = None,
    slots: int = SLOTS,
) -> DataFrame:
    """Left join of the dimension row of the key that is valid at the fact's date.

    Validity is [start, stop] in dates, either end may be open. With `check`, a
    dimension with overlapping ranges for a key is refused, so that a fact never
    matches twice.

    A small dimension is broadcast and hashed on its key. A large one is shuffled on
    key and time slot: time is cut into at most `slots` slots in which about equally many
    ranges begin, so a far-off end date leaves them as they are. A row is repeated for each slot
    it touches, so a key with a long history does not meet all its facts in one task.
    Ranges of a key do not overlap, hence a key grows by at most `slots` rows. Facts are
    not repeated. Dates that cannot be read are NULL: an open end, or a fact without match.
    """
    slim = dimension.select(
        F.col(dimension_key).alias("__key"),
        F.col(start).try_cast("date").alias("__start"),
        F.col(stop).try_cast("date").alias("__stop"),
        *[F.col(old).alias(new) for old, new in names.items()],
    ).where(F.coalesce(F.col("__start") <= F.col("__stop"), F.lit(True)))

    def refuse_overlaps(pieces: DataFrame, keys: list[str]) -> None:
        if check and not overlapping_validity(pieces, keys, "__start", "__stop").isEmpty():
            raise ValueError("validity ranges overlap for at least one key")

    day = F.col(fact_date).try_cast("date")
    helpers = ["__key", "__start", "__stop"]
    if is_small(slim, broadcast_bytes):
        refuse_overlaps(slim, ["__key"])
        match = (facts[fact_key] == slim["__key"]) & in_range(
            facts[fact_date].try_cast("date"), slim["__start"], slim["__stop"]
        )
        return facts.join(F.broadcast(slim), match, "left").drop(*helpers)

    shares = [i / slots for i in range(1, slots)]
    begun = slim.where("__start IS NOT NULL").agg(F.percentile_approx(F.unix_date("__start"), shares, 10_000)).first()[0]
    cuts = sorted({*(begun or [])})

    def slot(date: Column) -> Column:
        # Never decreasing in the date, so a date in a range has a slot in the range's.
        return F.when(date.isNotNull(), step_number(F.unix_date(date), cuts))

    last = len(cuts)
    touched = F.sequence(
        F.coalesce(slot(F.col("__start")), F.lit(0)),
        F.coalesce(slot(F.col("__stop")), F.lit(last)),
    )
    pieces = slim.withColumn("__slot", F.explode(touched))
    # Two ranges that overlap share the slot in which the later one begins.
    refuse_overlaps(pieces, ["__key", "__slot"])
    pieces = pieces.withColumnRenamed("__key", fact_key)
    placed = facts.withColumn("__day", day).withColumn("__slot", slot(F.col("__day")))
    match = in_range(F.col("__day"), F.col("__start"), F.col("__stop"))
    joined = salted_join(placed, pieces, [fact_key, "__slot"], "left", match, hot_rows=hot_rows)
    return joined.drop("__day", "__slot", *helpers)

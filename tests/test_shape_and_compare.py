import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators import shape
from tallyfold.operators.compare import assert_same_frames, frame_diff, same_rows, schema_difference, unlike_buckets

def test_drop_and_rename_ignore_absent_names(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    assert shape.drop_columns(frame, ["b", "_c44"]).columns == ["a"]
    assert shape.rename_columns(frame, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_lowercase_names(spark):
    assert shape.lowercase_names(spark.createDataFrame([(1, 2)], "A int, Bc int")).columns == ["a", "bc"]
    with pytest.raises(ValueError, match="case only"):
        shape.lowercase_names(spark.range(1).select(F.lit(1).alias("a"), F.lit(2).alias("A")))


def test_steps_run_in_order(spark):
    done = shape.run_steps(
        spark.range(1), lambda f: f.withColumn("a", F.col("id") + 1), lambda f: f.withColumn("b", F.col("a") * 2))
    assert tuple(done.first()) == (0, 1, 2)


def test_cast_columns(spark):
    frame = spark.createDataFrame([("173.00", "x", "2020-01-02")], "a string, b string, c string")
    typed = shape.cast_columns(frame, {T.ShortType(): ["a", "b"], T.DateType(): ["c"]})
    assert [f.dataType for f in typed.schema] == [T.ShortType(), T.ShortType(), T.DateType()]
    assert typed.first()["a"] == 173 and typed.first()["b"] is None


def test_null_rules(spark):
    frame = spark.createDataFrame([(None, None, 1), (None, 2, 3), (1, 2, 3)], "a int, b int, c int")
    assert shape.keep_rows_with_fewer_nulls(frame, 2).count() == 2
    assert shape.keep_rows_with_fewer_nulls(frame, 1, ["b"]).count() == 2
    assert shape.drop_rows_with_nulls(frame).count() == 1
    assert shape.fill_nulls(frame, {"a": 9}).where("a = 9").count() == 2
    flags = spark.createDataFrame([(None,), (True,)], "f boolean")
    assert sorted(r[0] for r in shape.fill_false(flags, "f").collect()) == [False, True]


def test_query_as(spark):
    frame = spark.createDataFrame([("x", "y")], "a string, b string")
    assert shape.query_as(frame, "frame", "SELECT a, b, concat(a, b) AS c FROM FRAME").first()["c"] == "xy"


def generated(seed, rows):
    rng = random.Random(seed)
    return [(rng.choice("pqr"), rng.choice([None, 1, 2]), rng.choice([None, 0.5])) for _ in range(rows)]


@pytest.mark.parametrize("seed", range(4))
def test_diff_matches_a_multiset_count(spark, seed):
    left, right = generated(seed, 40), generated(seed + 100, 45)
    schema = "a string, b int, c double"
    a, b = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    counts = {row: (left.count(row), right.count(row)) for row in {*left, *right}}
    expected = {(*row, n, m) for row, (n, m) in counts.items() if n != m}
    for ways in ({}, {"buckets": 3}, {"by_digest": False}):
        assert {tuple(r) for r in frame_diff(a, b, **ways).collect()} == expected
    with pytest.raises(AssertionError, match="rows differ"):
        assert_same_frames(a, b)


@pytest.mark.parametrize("seed", range(3))
def test_shuffled_rows_and_columns_are_no_difference(spark, seed):
    rows = generated(seed, 30)
    a = spark.createDataFrame(rows, "a string, b int, c double")
    b = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "a string, b int, c double").select("c", "a", "b")
    assert_same_frames(a, b)
    assert same_rows(a, b) and same_rows(a.limit(0), b.limit(0))
    assert not same_rows(a, b.limit(29))


def test_schema_is_compared_first(spark):
    a = spark.createDataFrame([(1,)], T.StructType([T.StructField("v", T.IntegerType(), False)]))
    b = spark.createDataFrame([(1,)], "v int")
    with pytest.raises(AssertionError, match="schemas"):
        assert_same_frames(a, b)
    assert_same_frames(a, b, check_nullability=False)
    assert schema_difference(a, b.withColumn("w", F.lit(1)), False) == {("w", "int")}


def test_equal_tables_group_no_rows(spark, plan_of):
    """Sums of buckets shuffle first; rows of unlike buckets alone come to the second aggregation."""
    left = spark.range(20_000).withColumn("text", F.concat(F.lit("row "), F.col("id")))
    right = left.repartition(3).select("text", "id")
    assert unlike_buckets(left, right).isEmpty() and frame_diff(left, right).isEmpty()
    changed = right.withColumn("text", F.when(F.col("id") == 7, "other").otherwise(F.col("text")))
    assert 1 <= unlike_buckets(left, changed).count() <= 2
    assert sorted((r.id, r.text, r.left_rows, r.right_rows) for r in frame_diff(left, changed).collect()) == [
        (7, "other", 0, 1), (7, "row 7", 1, 0)]
    plan = plan_of(frame_diff(left, right))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_swapped_nulls_and_cells_differ(spark):
    a = spark.createDataFrame([(None, 1), (2, 3)], "x int, y int")
    b = spark.createDataFrame([(1, None), (3, 2)], "x int, y int")
    assert frame_diff(a, b).count() == 4
    maps = spark.sql("SELECT variant_get(parse_json('1'), '$', 'int') AS v, 1 AS w")
    assert frame_diff(maps, maps).isEmpty()


def test_diff_combines_copies_before_the_shuffle(spark, plan_of):
    plan = plan_of(frame_diff(spark.range(10), spark.range(9), by_digest=False))
    assert plan.index("Exchange") < plan.rindex("HashAggregate")

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators import aggregates
from tallyfold.operators.quantiles import exact_medians


def test_group_sum_reads_text(spark):
    frame = spark.createDataFrame([("a", "1.5"), ("a", "2.7"), ("a", "n/a"), ("b", "x"), ("b", None)], "p string, n string")
    rows = aggregates.group_sum(frame, ["p"], "n", "total").collect()
    assert {r["p"]: r["total"] for r in rows} == {"a": pytest.approx(4.2), "b": None}
    exact = aggregates.group_sum(frame, ["p"], "n", "total", T.DecimalType(20, 2)).where("p = 'a'").first()
    assert str(exact["total"]) == "4.20"


def test_group_count(spark):
    frame = spark.createDataFrame([("a",), ("a",), (None,)], "p string")
    assert {r["p"]: r["count"] for r in aggregates.group_count(frame, ["p"]).collect()} == {"a": 2, None: 1}


def test_most_frequent_breaks_ties_by_value(spark, plan_of):
    frame = spark.createDataFrame([(v,) for v in ["c", "b", "b", "a", None, None, None]], "v string")
    top = aggregates.most_frequent(frame, "v", 2)
    assert [tuple(r) for r in top.collect()] == [("b", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_modes(spark):
    frame = spark.createDataFrame([("x", "2"), ("x", "1"), ("y", "2"), ("y", "1"), (None, None)], "a string, b string")
    rows = {r["column"]: (r["value"], r["count"]) for r in aggregates.modes(frame, ["a", "b"]).collect()}
    assert rows == {"a": ("x", 2), "b": ("1", 2)}
    numbers = spark.createDataFrame([(10,), (9,), (None,)], "n int")
    assert aggregates.modes(numbers, ["n"]).first()["value"] == "9"


def test_one_row_per_key(spark, plan_of):
    frame = spark.createDataFrame([("A", "z"), ("A", "m"), ("B", None), ("B", "q"), (None, "n")], "k string, v string")
    kept = aggregates.one_row_per_key(frame, ["k"])
    plan = plan_of(kept)
    assert {tuple(r) for r in kept.collect()} == {("A", "m"), ("B", None), (None, "n")}
    # The group limit runs before the shuffle as well.
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    latest = aggregates.one_row_per_key(frame, ["k"], [F.desc_nulls_last("v")])
    assert {tuple(r) for r in latest.collect()} == {("A", "z"), ("B", "q"), (None, "n")}
    assert aggregates.one_row_per_key(frame.select("k"), ["k"]).count() == 3


def test_describe(spark):
    frame = spark.createDataFrame([(1.0, "a"), (3.0, None)], "n double, t string")
    rows = {r["summary"]: (r["n"], r["t"]) for r in aggregates.describe_columns(frame, ["n", "t"]).collect()}
    assert rows["count"] == ("2", "1") and rows["mean"] == ("2.0", None) and rows["max"] == ("3.0", "a")
    assert float(rows["stddev"][0]) == pytest.approx(2**0.5)


def test_column_profile(spark):
    frame = spark.createDataFrame([("1", "n/a"), ("x", None), (None, "b")], "`my n` string, t string")
    rows = aggregates.column_profile(frame, {"my n": T.ShortType()}, {"t": ["n/a"]}).collect()
    assert [tuple(r) for r in rows] == [("my n", 3, 1, 1, 0), ("t", 3, 1, 0, 1)]
    assert [tuple(r)[1:4] for r in aggregates.column_profile(frame.where("false")).collect()] == [(0, 0, 0)] * 2


def test_schema_profile(spark):
    frame = spark.range(1).withColumn("t", F.lit(None).cast("string"))
    assert [tuple(r) for r in aggregates.schema_profile(frame).collect()] == [
        (0, "id", "bigint", False), (1, "t", "string", True)]


def shapes(rng):
    yield "even", [float(rng.randrange(1000)) for _ in range(4000)]
    yield "odd", [rng.gauss(0, 1) for _ in range(4001)]
    yield "a third is one value", [0.5] * 1500 + [rng.random() for _ in range(3000)]
    yield "middle inside a run", [1.0] * 1000 + [2.0] * 2500 + [3.0] * 1000
    yield "middle between two runs", [1.0] * 2000 + [2.0] * 2000
    yield "many magnitudes", [10.0 ** rng.randrange(-300, 300) for _ in range(3000)]
    yield "two", [1.0, 2.0]
    yield "one", [4.0]


def test_exact_median_by_narrowing(spark):
    rng = random.Random(1)
    columns = dict(shapes(rng))
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(3)
    frame = frame.toDF(*[f"c{i}" for i in range(len(columns))])
    expected = {f"c{i}": statistics.median(v) for i, v in enumerate(columns.values())}
    assert exact_medians(frame, frame.columns, gather_rows=10) == expected
    assert exact_medians(frame, frame.columns) == expected


def test_exact_median_of_nothing_and_of_nan(spark):
    frame = spark.createDataFrame([(None, float("nan")), (None, 2.0), (None, 4.0)], "a double, b double")
    assert exact_medians(frame, ["a", "b"]) == {"a": None, "b": 3.0}


def skewed(spark, rows=40_000):
    """Value i < 30 occurs about 1/(i + 2)^2 of the time, all other values once."""
    rank = F.floor(1 / F.sqrt((F.pmod(F.xxhash64("id"), F.lit(100_003)) + 1) / 100_003.0)).cast("int")
    return spark.range(rows).select(
        F.when(rank < 30, F.concat(F.lit("v"), rank)).otherwise(F.concat(F.lit("rare"), "id")).alias("v"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("n"), "id")


def test_frequent_values_are_proved_by_a_sketch(spark):
    frame = skewed(spark)
    for k in (1, 5, 10):
        found = aggregates.frequent_candidates(frame, {"v": k, "n": k, "id": k})
        exact = [r["v"] for r in aggregates.most_frequent(frame, "v", k, sketch=False).collect()]
        assert set(exact) <= set(found["v"]) and len(found["v"]) < 40
        # Where all values occur once, none can be proved to be frequent.
        assert "id" not in found and len(found.get("n", [None] * 6)) == 6
        plain, proved = (aggregates.most_frequent(frame, "v", k, sketch=s) for s in (False, True))
        assert [tuple(r) for r in proved.collect()] == [tuple(r) for r in plain.collect()]
        # The other values do not reach the shuffle.
        sent = proved._jdf.queryExecution().optimizedPlan().toString()
        assert "Filter" in sent and all(v in sent for v in found["v"][:3])
    top = aggregates.most_frequent(frame, "id", 3)
    assert [tuple(r) for r in top.collect()] == [(0, 1), (1, 1), (2, 1)]


def test_a_sketch_without_room_proves_nothing_wrong(spark):
    frame = skewed(spark, 5_000)
    exact = [r["v"] for r in aggregates.most_frequent(frame, "v", 8, sketch=False).collect()]
    for tracked in (12, 24, 96, 384, 3_072):
        found = aggregates.frequent_candidates(frame, {"v": 8}, tracked).get("v")
        assert found is None or set(exact) <= set(found)


def test_frequent_values_of_odd_columns(spark):
    empty = spark.createDataFrame([], "v string, d double, a array<int>")
    assert aggregates.most_frequent(empty, "v", 3).collect() == []
    nulls = spark.createDataFrame([(None, 1.0, [1])] * 3, empty.schema)
    assert aggregates.most_frequent(nulls, "v", 3).collect() == []
    assert [tuple(r) for r in aggregates.most_frequent(nulls, "d", 3).collect()] == [(1.0, 3)]
    assert [tuple(r) for r in aggregates.most_frequent(nulls, "a", 3).collect()] == [([1], 3)]
    assert aggregates.frequent_candidates(nulls, {"d": 1, "a": 1}) == {}
    named = spark.createDataFrame([("x",), ("x",), ("y",)], "`odd.name` string").withColumnRenamed("odd.name", "s0")
    assert [tuple(r) for r in aggregates.most_frequent(named, "s0", 1).collect()] == [("x", 2)]

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.ranges import step_number
from tallyfold.operators.compare import assert_same_frames
from tallyfold.operators.joins import (
    attach_dimension,
    estimated_bytes,
    hot_keys,
    is_small,
    keyed_join,
    overlapping_validity,
    salted_join,
    valid_at_join,
)

# Key 1 holds a third of the rows and key 2 a third as exact copies; NULL keys occur.
LEFT = [(1, i) for i in range(60)] + [(2, 7)] * 60 + [(k, k) for k in range(3, 60)] + [(None, 1), (None, 2)]
RIGHT = [(1, "a"), (1, "b"), (2, "c"), (5, "d"), (99, "e"), (None, "n")]


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame(LEFT, "k int, v int").repartition(4)
    return left, spark.createDataFrame(RIGHT, "k int, w string")


def brute(how, null_safe):
    def same(a, b):
        return (a == b) if a is not None and b is not None else (null_safe and a is b)

    out = []
    for k, v in LEFT:
        hits = [w for q, w in RIGHT if same(k, q)]
        if how == "left_semi" and hits or how == "left_anti" and not hits:
            out.append((k, v))
        elif how in ("inner", "left"):
            out += [(k, v, w) for w in hits]
            if how == "left" and not hits:
                out.append((k, v, None))
    return out


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("null_safe, hot_rows", [(False, 10), (True, 10), (True, 10_000)])
def test_salted_join_is_exact(spark, sides, how, null_safe, hot_rows):
    left, right = sides
    schema = "k int, v int" + (", w string" if how in ("inner", "left") else "")
    expected = spark.createDataFrame(brute(how, null_safe), schema)
    actual = salted_join(left, right, ["k"], how, null_safe=null_safe, hot_rows=hot_rows)
    assert actual.columns == expected.columns
    assert_same_frames(actual, expected, check_nullability=False)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("broadcast_bytes", [0, 2**62])
def test_keyed_join_gives_the_same_either_way(spark, sides, how, null_safe, broadcast_bytes):
    left, right = sides
    expected = spark.createDataFrame(brute(how, null_safe), "k int, v int, w string")
    right = spark.sql("SELECT * FROM VALUES (1,'a'),(1,'b'),(2,'c'),(5,'d'),(99,'e'),(null,'n') AS t(k, w)")
    actual = keyed_join(left, right, ["k"], how, null_safe, broadcast_bytes, hot_rows=10)
    assert_same_frames(actual, expected, check_nullability=False)


def test_hot_keys_are_spread(spark, sides):
    left, _ = sides
    found = {row["k"]: row["__parts"] for row in hot_keys(left, ["k"], 20).collect()}
    assert found == {1: 3, 2: 3}
    # No key has more parts than a shuffle has tasks.
    assert {row["__parts"] for row in hot_keys(left, ["k"], 1).where("k = 1").collect()} == {4}


def test_clustered_rows_of_a_hot_key_are_spread(spark):
    clustered = spark.range(0, 8000, 1, 1).select(F.lit(1).alias("k"), "id")
    once = spark.createDataFrame([(1, "x")], "k int, w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(clustered, once, ["k"], hot_rows=1000)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and len(sizes) > 1 and max(sizes) < 5000


@pytest.mark.parametrize("null_safe", [False, True])
def test_left_join_with_keys_hot_on_the_right(spark, null_safe):
    left = [(1, 0), (2, 1), (None, 2), (3, 3), (1, 4)]
    right = [(1, i) for i in range(60)] + [(None, i) for i in range(40)] + [(2, 7)]
    expected = [(k, v, w) for k, v in left for q, w in right if k == q and (null_safe or k is not None)]
    expected += [(k, v, None) for k, v in left if not any(k == q and (null_safe or k is not None) for q, _ in right)]
    actual = salted_join(spark.createDataFrame(left, "k int, v int"), spark.createDataFrame(right, "k int, w int").repartition(5),
                         ["k"], "left", null_safe=null_safe, hot_rows=10)
    assert_same_frames(actual, spark.createDataFrame(expected, "k int, v int, w int"), check_nullability=False)


def test_chained_joins_read_the_facts_once(spark, data_dir, plan_of):
    lines, parts = (spark.read.parquet(f"{data_dir}/{t}.parquet") for t in ("lineitem", "part"))
    for i in range(3):
        names = {"p_name": f"name{i}"}
        lines = attach_dimension(lines, parts, "l_partkey", "p_partkey", names, broadcast_bytes=0)
    scans = [line for line in plan_of(lines).splitlines() if "FileScan" in line and "l_partkey" in line]
    assert len(scans) == 1


def test_a_dimension_with_a_key_twice_is_refused(spark):
    facts = spark.createDataFrame([("A",)], "code string")
    names = spark.sql("SELECT * FROM VALUES ('A', 'Alpha'), ('A', 'Beta'), (NULL, 'x'), (NULL, 'y') AS t(c, name)")
    with pytest.raises(ValueError, match="same 'c'"):
        attach_dimension(facts, names, "code", "c", {"name": "n"})
    assert attach_dimension(facts, names.where("name <> 'Beta'"), "code", "c", {"name": "n"}).first()["n"] == "Alpha"


def test_copies_of_one_row_are_spread_and_stay_complete(spark):
    copies = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"))
    once = spark.createDataFrame([(1, "x")], "k int, w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(copies, once, ["k"], hot_rows=1000)
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        plain = salted_join(copies, once, ["k"], hot_rows=None)
        assert plain.select(F.spark_partition_id()).distinct().count() == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 8000 and len(sizes) > 1


@pytest.mark.parametrize("hot_rows", [5, 40])
def test_inner_join_with_keys_hot_on_both_sides(spark, hot_rows):
    rng = random.Random(2)
    keys = [1] * 40 + [2] * 30 + [None] * 20 + list(range(3, 30))
    left = [(k, i) for i, k in enumerate(rng.sample(keys, len(keys)))]
    right = [(k, i) for i, k in enumerate(rng.sample(keys[20:] + [5] * 50, len(keys) + 30))]
    expected = spark.createDataFrame(
        [(k, v, w) for k, v in left for q, w in right if k == q and k is not None], "k int, v int, w int")
    l = spark.createDataFrame(left, "k int, v int").repartition(6)
    r = spark.createDataFrame(right, "k int, w int").repartition(5)
    actual = salted_join(l, r, ["k"], hot_rows=hot_rows)
    assert_same_frames(actual, expected, check_nullability=False)
    close = salted_join(l, r, ["k"], condition=F.abs(F.col("v") - F.col("w")) < 9, hot_rows=hot_rows)
    assert_same_frames(close, expected.where("abs(v - w) < 9"), check_nullability=False)


def test_salting_reads_no_further_columns(spark, data_dir, plan_of):
    orders = spark.read.parquet(f"{data_dir}/orders.parquet").withColumnRenamed("o_custkey", "k")
    customers = spark.read.parquet(f"{data_dir}/customer.parquet").withColumnRenamed("c_custkey", "k")
    plan = plan_of(salted_join(orders, customers, ["k"]).select("o_orderkey", "c_name"))
    assert "o_totalprice" not in plan and "c_acctbal" not in plan


def test_size_check(spark, data_dir):
    orders = spark.read.parquet(f"{data_dir}/orders.parquet")
    assert is_small(orders) and not is_small(orders, 1000)
    assert estimated_bytes(orders.select("o_orderkey")) < estimated_bytes(orders)
    # A frame of unknown size is never taken for small.
    assert not is_small(spark.createDataFrame([(1,)], "a int"))


def test_small_side_is_broadcast_and_large_side_shuffled(spark, data_dir, plan_of):
    orders = spark.read.parquet(f"{data_dir}/orders.parquet").withColumnRenamed("o_custkey", "k")
    customers = spark.read.parquet(f"{data_dir}/customer.parquet").withColumnRenamed("c_custkey", "k")
    assert "BroadcastHashJoin" in plan_of(keyed_join(orders, customers, ["k"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(keyed_join(orders, customers, ["k"], broadcast_bytes=0))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan
    assert "__left_part" in plan_of(salted_join(orders, customers, ["k"], hot_rows=10))


def test_attach_twice_keeps_all_facts(spark):
    facts = spark.createDataFrame([("A", "B"), ("B", "Z"), (None, "A")], "origin string, dest string")
    names = spark.sql("SELECT * FROM VALUES ('A', 'Alpha'), ('B', 'Beta') AS t(code, name)")
    view = attach_dimension(facts, names, "origin", "code", {"name": "origin_name"})
    view = attach_dimension(view, names, "dest", "code", {"name": "dest_name"})
    assert sorted(map(tuple, view.collect()), key=str) == sorted([
        ("A", "B", "Alpha", "Beta"), ("B", "Z", "Beta", None), (None, "A", None, "Alpha"),
    ], key=str)


D = dt.date
HISTORY = [("x", D(2000, 1, 1), D(2000, 12, 31), "x1"), ("x", D(2001, 1, 1), None, "x2"),
           ("y", None, D(1999, 12, 31), "y1"), ("y", D(2000, 2, 1), D(2000, 2, 1), "y2"),
           ("z", None, None, "z1")]
DIMENSION = "code string, start date, stop date, name string"


@pytest.mark.parametrize("broadcast_bytes", [0, 2**62])
def test_valid_at(spark, broadcast_bytes):
    random.seed(5)
    days = [D(1998, 1, 1) + dt.timedelta(days=random.randrange(1800)) for _ in range(300)]
    facts = [(random.choice(["x", "x", "x", "y", "z", "q", None]), d, i) for i, d in enumerate(days)]
    facts += [("x", None, 900), ("z", None, 901), ("x", D(2000, 12, 31), 902), ("x", D(2001, 1, 1), 903)]

    def name(code, day):
        for c, start, stop, n in HISTORY:
            if c == code and day and (not start or start <= day) and (not stop or day <= stop):
                return n

    expected = spark.createDataFrame([(*f, name(f[0], f[1])) for f in facts],
                                     "code string, day date, i int, label string")
    actual = valid_at_join(
        expected.drop("label"), spark.createDataFrame(HISTORY, DIMENSION).withColumnRenamed("code", "c"),
        "code", "day", "c", "start", "stop", {"name": "label"},
        broadcast_bytes=broadcast_bytes, hot_rows=20, slots=16,
    )
    assert_same_frames(actual, expected, check_nullability=False)


def test_slots_follow_the_dates_despite_a_far_off_end(spark):
    first = D(2000, 1, 1)
    history = [("x", first + dt.timedelta(days=10 * i), first + dt.timedelta(days=10 * i + 9), f"x{i}") for i in range(500)]
    history[-1] = ("x", history[-1][1], D(9999, 12, 31), "last")
    dimension = spark.createDataFrame(history, DIMENSION)
    facts = spark.createDataFrame([("x", first + dt.timedelta(days=i), i) for i in range(5200)], "c string, day date, i int")
    joined = valid_at_join(facts, dimension, "c", "day", "code", "start", "stop", {"name": "n"}, broadcast_bytes=0)
    assert all(r["n"] == ("last" if r["i"] >= 4990 else f"x{r['i'] // 10}") for r in joined.collect())
    days = dimension.agg(F.percentile_approx(F.unix_date("start"), [i / 16 for i in range(1, 16)])).first()[0]
    slots = dimension.select(step_number(F.unix_date("start"), sorted(set(days))).alias("s")).groupBy("s").count().collect()
    assert len(slots) > 12 and max(r["count"] for r in slots) < 80


def test_unreadable_dates(spark):
    facts = spark.createDataFrame([("x", "2000-06-01"), ("x", "nope"), ("y", "2000-06-01")], "c string, day string")
    dimension = spark.createDataFrame([("x", "2000-01-01", "whenever", "open"), ("y", "2001-01-01", None, "late")],
                                      "code string, start string, stop string, name string")
    for size in (0, 2**62):
        rows = valid_at_join(facts, dimension, "c", "day", "code", "start", "stop", {"name": "n"}, broadcast_bytes=size)
        assert {(r["c"], r["day"]): r["n"] for r in rows.collect()} == {
            ("x", "2000-06-01"): "open", ("x", "nope"): None, ("y", "2000-06-01"): None}


def test_valid_at_with_empty_dimension(spark):
    facts = spark.createDataFrame([("x", D(2000, 1, 1))], "code string, day date")
    empty = spark.createDataFrame([], DIMENSION).withColumnRenamed("code", "c")
    row = valid_at_join(facts, empty, "code", "day", "c", "start", "stop", {"name": "label"}).first()
    assert row["label"] is None


@pytest.mark.parametrize("rows, overlapping", [
    (HISTORY, 0),
    ([("x", D(2000, 1, 1), D(2000, 6, 1), "a"), ("x", D(2000, 6, 1), None, "b")], 1),
    ([("x", D(2000, 1, 1), None, "a"), ("x", D(2010, 1, 1), None, "b")], 1),
    ([("x", None, D(2000, 1, 1), "a"), ("x", None, D(1999, 1, 1), "b")], 1),
    ([("x", D(2000, 1, 1), D(2009, 1, 1), "a"), ("x", D(2001, 1, 1), D(2001, 2, 1), "b"),
      ("x", D(2005, 1, 1), D(2005, 2, 1), "c"), ("y", D(2005, 1, 1), D(2005, 2, 1), "d")], 2),
])
def test_overlapping_validity_is_found(spark, rows, overlapping):
    dimension = spark.createDataFrame(rows, DIMENSION)
    assert overlapping_validity(dimension, ["code"], "start", "stop").count() == overlapping
    if overlapping:
        facts = spark.createDataFrame([("x", D(2000, 1, 1))], "c string, day date")
        for size in (0, 2**63):
            with pytest.raises(ValueError, match="overlap"):
                valid_at_join(facts, dimension, "c", "day", "code", "start", "stop", {"name": "n"},
                              broadcast_bytes=size)

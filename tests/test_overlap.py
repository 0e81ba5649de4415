import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.compare import assert_same_frames
from tallyfold.operators.overlap import (
    _cover,
    _cuts,
    _nodes_above,
    _with_leaf,
    overlap_join,
)
from tallyfold.plans.offices import offices_with_reigns


def brute(left, right, how):
    out = []
    for l in left:
        hits = [r for r in right
                if not (l[1] is not None and r[2] is not None and l[1] > r[2])
                and not (l[2] is not None and r[1] is not None and l[2] < r[1])]
        out += [(*l, *r) for r in hits]
        if how == "left" and not hits:
            out.append((*l, None, None, None))
    return out


def random_ranges(rng, n, top, longest, inverted=0.1):
    rows = []
    for i in range(n):
        start = rng.randrange(top)
        stop = start + rng.randrange(longest)
        if rng.random() < inverted:
            start, stop = stop, start
        rows.append((i, None if rng.random() < 0.1 else start, None if rng.random() < 0.1 else stop))
    return rows


def frames(spark, left, right, kind="int"):
    return (spark.createDataFrame(left, f"i int, a {kind}, b {kind}"),
            spark.createDataFrame(right, f"j int, c {kind}, d {kind}"))


@pytest.mark.parametrize("how, depth, seed, longest", [
    ("inner", 1, 1, 3), ("inner", 5, 2, 60), ("inner", 14, 3, 1500),
    ("left", 1, 4, 1500), ("left", 5, 5, 3), ("left", 14, 6, 60),
])
def test_shuffled_tree_equals_comparing_all_pairs(spark, how, depth, seed, longest):
    rng = random.Random(seed)
    left, right = random_ranges(rng, 120, 1000, longest), random_ranges(rng, 60, 1000, longest)
    l, r = frames(spark, left, right)
    expected = spark.createDataFrame(brute(left, right, how), "i int, a int, b int, j int, c int, d int")
    actual = overlap_join(l, r, ("a", "b"), ("c", "d"), how, "tree", depth, hot_rows=50)
    assert_same_frames(actual, expected, check_nullability=False)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("strategy", ["tree", "compare", "auto"])
def test_broadcast_strategies(spark, tmp_path, how, strategy):
    rng = random.Random(7)
    left, right = random_ranges(rng, 200, 500, 40), random_ranges(rng, 50, 500, 40)
    # From a file the size of the right side is known.
    l, r = frames(spark, left, right)
    r.write.parquet(str(tmp_path / "right"))
    r = spark.read.parquet(str(tmp_path / "right"))
    expected = spark.createDataFrame(brute(left, right, how), "i int, a int, b int, j int, c int, d int")
    actual = overlap_join(l, r, ("a", "b"), ("c", "d"), how, strategy)
    assert_same_frames(actual, expected, check_nullability=False)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "bigint"])
def test_types_of_bounds(spark, kind):
    rng = random.Random(11)
    left, right = random_ranges(rng, 60, 400, 20), random_ranges(rng, 40, 400, 20)

    def convert(v):
        if v is None:
            return None
        if kind == "date":
            return dt.date(2000, 1, 1) + dt.timedelta(days=v)
        if kind.startswith("timestamp"):
            return dt.datetime(1969, 12, 31, 23) + dt.timedelta(minutes=7 * v, microseconds=v)
        return v / 3 if kind == "double" else v * 10**12

    left = [(i, convert(a), convert(b)) for i, a, b in left]
    right = [(i, convert(a), convert(b)) for i, a, b in right]
    l, r = frames(spark, left, right, kind)
    expected = spark.createDataFrame(
        brute(left, right, "left"), f"i int, a {kind}, b {kind}, j int, c {kind}, d {kind}")
    assert_same_frames(overlap_join(l, r, ("a", "b"), ("c", "d"), "left", "tree"), expected, False)


def test_one_range_holds_a_third_of_the_rows_and_one_bound_is_far_out(spark):
    left = [(i, 5, 6) for i in range(100)] + random_ranges(random.Random(3), 200, 1000, 10)
    right = random_ranges(random.Random(4), 30, 1000, 10) + [(77, 10**9, 2 * 10**9), (78, -10**9, 5)]
    l, r = frames(spark, left, right)
    expected = spark.createDataFrame(brute(left, right, "left"), "i int, a int, b int, j int, c int, d int")
    assert_same_frames(overlap_join(l, r, ("a", "b"), ("c", "d"), "left", "tree", hot_rows=20), expected, False)


def test_crowded_stretches_get_narrow_leaves(spark):
    # A third of all ranges lies within one hour of ten years, some bounds far outside.
    year = 365 * 86400
    ticks = [5 * year + i for i in range(3600)] + [i * year // 720 for i in range(7200)] + [-10**9, 10**10]
    frame = spark.createDataFrame([(t,) for t in ticks], "a bigint").withColumn("b", F.col("a"))
    cuts, rows = _cuts([(frame, ("a", "b")), (frame, ("a", "b"))])
    assert rows == len(ticks)
    placed = _with_leaf(frame, "a", "leaf", 0, cuts, 1 << 12)
    top = placed.groupBy("leaf").count().agg(F.max("count")).first()[0]
    # Only where a crowded stretch begins or ends within a piece do many share a leaf.
    assert top <= len(ticks) / 64 + 1
    # Never decreasing.
    leaves = [r["leaf"] for r in placed.orderBy("a").collect()]
    assert leaves == sorted(leaves) and leaves[0] >= 0 and leaves[-1] < 1 << 12


@pytest.mark.parametrize("broadcast_bytes", [0, 2**62])
def test_bounds_that_are_not_finite(spark, tmp_path, broadcast_bytes):
    inf, rng = float("inf"), random.Random(9)
    ends = [-inf, inf, None, 0.0, 1.0, 2.5, 40.0]
    left = [(i, rng.choice(ends), rng.choice(ends)) for i in range(60)]
    right = [(i, rng.choice(ends), rng.choice(ends)) for i in range(40)]
    l, r = frames(spark, left, right, "double")
    r.write.parquet(str(tmp_path / "right"))
    expected = spark.createDataFrame(brute(left, right, "left"), "i int, a double, b double, j int, c double, d double")
    actual = overlap_join(l, spark.read.parquet(str(tmp_path / "right")), ("a", "b"), ("c", "d"), "left", "tree",
                          broadcast_bytes=broadcast_bytes)
    assert_same_frames(actual, expected, False)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("broadcast_bytes", [0, 2**62])
def test_equality_keys_beside_the_ranges(spark, tmp_path, how, broadcast_bytes):
    rng = random.Random(12)
    left, right = random_ranges(rng, 150, 300, 40), random_ranges(rng, 60, 300, 40)
    l, r = (f.withColumn(k, F.when(F.col(i) % 7 != 0, F.col(i) % 4)) for f, k, i in zip(frames(spark, left, right), "kq", "ij"))
    r.write.parquet(str(tmp_path / "right"))
    same = [(*x, *y) for x in [(*t, t[0] % 4 if t[0] % 7 else None) for t in left]
            for y in [(*t, t[0] % 4 if t[0] % 7 else None) for t in right]
            if x[3] is not None and x[3] == y[3] and brute([x[:3]], [y[:3]], "inner")]
    if how == "left":
        met = {x[0] for x in same}
        same += [(*t, t[0] % 4 if t[0] % 7 else None, None, None, None, None) for t in left if t[0] not in met]
    expected = spark.createDataFrame(same, "i int, a int, b int, k int, j int, c int, d int, q int")
    actual = overlap_join(l, spark.read.parquet(str(tmp_path / "right")), ("a", "b"), ("c", "d"), how, "tree", by=[("k", "q")],
                          broadcast_bytes=broadcast_bytes)
    assert_same_frames(actual, expected, False)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("per_key, deepest", [(1, 0), (3, 2), (64, 6)])
def test_keys_of_few_rows_need_few_levels(spark, plan_of, how, per_key, deepest):
    rng = random.Random(per_key)
    left = [(i, None if i % 9 == 0 else i % 5, *r[1:]) for i, r in enumerate(random_ranges(rng, 150, 1000, 60))]
    # Keys 3 and 4 have no row, and a NULL key has more rows than any other but meets nothing.
    keys = [k for k in range(3) for _ in range(per_key - (k == 1))] + [None] * 200
    right = [(j, k, *r[1:]) for j, (k, r) in enumerate(zip(keys, random_ranges(rng, len(keys), 1000, 60)))]
    l, r = spark.createDataFrame(left, "i int, k int, a int, b int"), spark.createDataFrame(right, "j int, m int, c int, d int")
    expected = []
    for x in left:
        hits = brute([(x[0], x[2], x[3])], [(y[0], y[2], y[3]) for y in right if y[1] is not None and y[1] == x[1]], "inner")
        expected += [(*x, h[3], x[1], h[4], h[5]) for h in hits]
        if how == "left" and not hits:
            expected.append((*x, None, None, None, None))
    actual = overlap_join(l, r, ("a", "b"), ("c", "d"), how, "tree", by=[("k", "m")])
    assert_same_frames(actual, spark.createDataFrame(expected, "i int, k int, a int, b int, j int, m int, c int, d int"),
                       check_nullability=False)
    levels = re.findall(r"shiftright\(.*?, (\d+)\)", plan_of(actual))
    assert max(map(int, levels), default=0) <= deepest


def test_empty_sides(spark):
    l, r = frames(spark, [(1, 1, 2)], [(1, 1, 2)])
    none = r.where("j > 5")
    assert overlap_join(l, none, ("a", "b"), ("c", "d"), "inner", "tree").count() == 0
    assert overlap_join(l, none, ("a", "b"), ("c", "d"), "left", "tree").count() == 1
    assert overlap_join(l.where("i > 5"), r, ("a", "b"), ("c", "d"), "left", "tree").count() == 0


def test_misuse_is_refused(spark):
    l, r = frames(spark, [(1, 1, 2)], [(1, 1, 2)])
    with pytest.raises(ValueError, match="both sides"):
        overlap_join(l, l, ("a", "b"), ("a", "b"))
    with pytest.raises(ValueError, match="known small size"):
        overlap_join(l, r, ("a", "b"), ("c", "d"), strategy="compare")
    with pytest.raises(TypeError, match="string"):
        overlap_join(l, r.withColumn("c", F.col("c").cast("string")), ("a", "b"), ("c", "d"), strategy="tree")


def test_shuffled_tree_compares_no_pairs_blindly(spark, plan_of):
    l, r = frames(spark, [(1, 1, 2)], [(1, 1, 2)])
    plan = plan_of(overlap_join(l, r, ("a", "b"), ("c", "d"), "inner", "tree"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Python" not in plan


def test_point_and_cover_share_one_node_exactly_inside(spark):
    depth = 4
    pairs = [(p, s, e) for p in range(16) for s in range(16) for e in range(16)]
    frame = spark.createDataFrame(pairs, "p int, s int, e int").select(
        "p", "s", "e",
        F.size(F.array_intersect(
            _nodes_above(F.col("p"), list(range(depth + 1)), depth), _cover("s", "e", depth)
        )).alias("shared"),
    )
    assert frame.where("shared <> int(p BETWEEN s AND e)").count() == 0


def test_offices_and_reigns(spark):
    offices = spark.createDataFrame([
        ("Winston Churchill", "1951-10-26", "1955-04-05"), ("Anthony Eden", "1955-04-06", "1957-01-09"),
        ("Theresa May", "2016-07-13", "2019-07-24"), ("Boris Johnson", "2019-07-24", None),
        ("Nobody", "1900-01-01", "1910-01-01"),
    ], "name string, entered_office_on string, left_office_on string")
    reigns = spark.sql("""SELECT * FROM VALUES ('Elizabeth II', 1952, null), ('George VI', 1936, 1952),
        ('Edward VIII', 1936, 1936) AS r(monarch, `reign start`, `reign stop`)""")
    expected = [("Nobody", None), ("Winston Churchill", "George VI"), ("Winston Churchill", "Elizabeth II"),
                ("Anthony Eden", "Elizabeth II"), ("Theresa May", "Elizabeth II"),
                ("Boris Johnson", "Elizabeth II")]
    for options in ({}, {"strategy": "tree", "broadcast_bytes": 0}):
        rows = offices_with_reigns(offices, reigns, **options).collect()
        assert [(r["name"], r["monarch"]) for r in rows] == expected

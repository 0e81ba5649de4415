import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.casting import safe_cast
from tallyfold.functions.numeric import bins, round_half_even, square, typed_square_udf
from tallyfold.functions.ranges import in_range, ranges_overlap
from tallyfold.functions.text import instant_of, split_coordinates, title_case
from tallyfold.functions.truth import kleene, to_bool, to_bool_normalised


def column(spark, values, kind, make):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in frame.orderBy("i").select(make(F.col("c"))).collect()]


@pytest.mark.parametrize("data_type, cells, expected", [
    (T.ShortType(), ["173.00", "-3", "40000", "x", "", None, " 7 "], [173, -3, None, None, None, None, 7]),
    (T.ByteType(), ["1.0", "127", "128"], [1, 127, None]),
    (T.IntegerType(), ["1.9", "-1.9", "2147483647", "2147483648"], [1, -1, 2147483647, None]),
    (T.LongType(), ["9223372036854775807", "9223372036854775807.0", "9223372036854775808", "n"],
     [9223372036854775807, 9223372036854775807, None, None]),
    (T.DateType(), ["2020-02-29", "2021-02-29", "nope"], [dt.date(2020, 2, 29), None, None]),
    (T.DoubleType(), ["1.5", "abc"], [1.5, None]),
])
def test_safe_cast(spark, data_type, cells, expected):
    assert column(spark, cells, "string", lambda c: safe_cast(c, data_type)) == expected


def test_to_bool(spark):
    assert column(spark, ["1.0", "0.0", "1", "yes", None], "string",
                  lambda c: to_bool(c, {"1.0"}, {"0.0"})) == [True, False, None, None, None]


def test_to_bool_normalised(spark):
    assert column(spark, [" yes", "TRUE ", "No", "false", "oui", None], "string", to_bool_normalised) == [
        True, True, False, False, None, None]
    assert column(spark, ["Oui ", "non", "yes"], "string",
                  lambda c: to_bool_normalised(c, [" oui"], ["NON "])) == [True, False, None]


def test_three_valued_logic_on_all_pairs(spark):
    pairs = list(itertools.product((True, False, None), repeat=2))
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a boolean, b boolean")
    rows = frame.withColumns(kleene(F.col("a"), F.col("b"))).orderBy("i").collect()
    # A result is known exactly if all ways to fill the unknowns agree on it.
    def known(operation, *cells):
        found = {operation(*filled) for filled in itertools.product(*[[c] if c is not None else [True, False] for c in cells])}
        return found.pop() if len(found) == 1 else None

    for row, (a, b) in zip(rows, pairs):
        assert row["a or b"] == known(lambda x, y: x or y, a, b)
        assert row["a and b"] == known(lambda x, y: x and y, a, b)
        assert row["not a"] == known(lambda x: not x, a)


def test_overlap_on_a_grid_of_ranges(spark):
    bounds = [None, 0, 1, 2]
    grid = list(itertools.product(bounds, repeat=4))
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(grid)], "i int, a int, b int, c int, d int")
    overlap = ranges_overlap(*[F.col(x) for x in "abcd"])
    rows = frame.select("i", overlap.alias("x")).orderBy("i").collect()
    for row, (a, b, c, d) in zip(rows, grid):
        apart = (a is not None and d is not None and a > d) or (b is not None and c is not None and b < c)
        assert row["x"] == (not apart)


def test_in_range(spark):
    rows = spark.createDataFrame([(3, 1, 3), (4, 1, 3), (4, 1, None), (None, 1, 3), (0, None, 3)],
                                 "p int, a int, b int")
    found = rows.select(in_range(F.col("p"), F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in found] == [True, False, True, False, True]


def test_coordinates(spark):
    frame = spark.createDataFrame(
        [(1, "50.85,4.35"), (2, "50.85"), (3, "x,4.35"), (4, None), (5, " 1 , 2 ,3")], "i int, p string")
    rows = split_coordinates(frame, "p").orderBy("i").collect()
    assert [c for c in rows[0].asDict()] == ["i", "latitude", "longitude"]
    got = [(r["latitude"], r["longitude"]) for r in rows]
    assert got == [(pytest.approx(50.85), pytest.approx(4.35)), (pytest.approx(50.85), None),
                   (None, pytest.approx(4.35)), (None, None), (1.0, 2.0)]


@pytest.mark.parametrize("separator", ["|", ".", "*", "; "])
def test_coordinate_separator_is_literal(spark, separator):
    frame = spark.createDataFrame([(f"4{separator}50",)], "p string")
    row = split_coordinates(frame, "p", separator, 1, 0).first()
    assert (row["latitude"], row["longitude"]) == (50.0, 4.0)


def test_instant(spark):
    assert column(spark, ["2024-03-01T10:00:07+02:00", "yesterday", None], "string", instant_of) == [
        dt.datetime(2024, 3, 1, 8, 0, 7), None, None]


def test_title_case(spark):
    assert column(spark, ["rainBOWS are", "o'neil-smith x", None], "string", title_case) == [
        "Rainbows Are", "O'Neil-Smith X", None]


def test_bins(spark):
    got = column(spark, [5.0, 5.1, 6.0, 7.0, 10.0, 0.0, 10.5, None, 0.1], "double",
                 lambda c: bins(c, (0, 5, 6, 7, 10), ("0-5", "5-6", "6-7", "7-10")))
    assert got == ["0-5", "5-6", "5-6", "6-7", "7-10", None, None, None, "0-5"]


def test_round_half_even(spark):
    assert column(spark, [2.5, 3.5, -2.5, 2.51], "double", round_half_even) == [2.0, 4.0, -2.0, 3.0]


def test_square_keeps_the_type(spark):
    frame = spark.createDataFrame([(3, 4.9)], "a bigint, b double")
    squared = frame.select(square(F.col("a")).alias("a"), square(F.col("b")).alias("b"))
    assert dict(squared.dtypes) == {"a": "bigint", "b": "double"}


@pytest.mark.parametrize("values, kind", [([5, -4, None], "bigint"), ([0.5, None, -3.25], "double"), ([7, None], "int")])
def test_typed_udf_is_null_for_the_other_kind_of_number(spark, values, kind):
    squares = [None if v is None else v * v for v in values]
    nothing = [None] * len(values)
    whole = kind != "double"
    assert column(spark, values, kind, typed_square_udf(T.IntegerType())) == (squares if whole else nothing)
    assert column(spark, values, kind, typed_square_udf(T.FloatType())) == (nothing if whole else squares)

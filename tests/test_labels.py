import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.functions.holidays import holiday_dates, is_belgian_holiday, with_easter
from tallyfold.operators.compare import assert_same_frames
from tallyfold.operators.labels import (
    holiday_calendar,
    holiday_calendar_of,
    label_holidays,
    label_weekend,
)

D = dt.date


def test_weekend(spark):
    expected = spark.createDataFrame(
        [(D(2018, 5, 12), "a", True), (D(2019, 5, 13), "b", False), (D(2018, 5, 13), "c", True),
         (D(2018, 5, 14), "d", False), (None, "e", None)],
        "date date, foo string, is_weekend boolean",
    )
    assert_same_frames(label_weekend(expected.select("date", "foo")), expected)


def test_one_date():
    assert is_belgian_holiday(D(2020, 7, 21))
    assert not is_belgian_holiday(D(2020, 7, 22))


@pytest.mark.parametrize("method", ["formula", "list", "join"])
def test_known_holidays(spark, method):
    expected = spark.createDataFrame(
        [(D(2000, 1, 1), True), (D(2018, 7, 21), True), (D(2019, 12, 6), False),
         (D(2019, 4, 22), True), (D(2019, 5, 30), True), (D(2019, 6, 10), True)],
        "date date, is_belgian_holiday boolean",
    )
    actual = label_holidays(expected.select("date"), method=method)
    assert_same_frames(actual, expected, check_nullability=False)


def test_year_outside_the_list(spark):
    frame = spark.createDataFrame([(D(2020, 7, 21),), (D(1999, 12, 25),)], "date date")

    def labels(**options):
        return {row[1] for row in label_holidays(frame, **options).collect()}

    assert labels() == {True}
    assert labels(method="join") == {True}
    assert labels(method="list") == {False}
    assert labels(method="list", years=[1999, 2020]) == {True}
    assert labels(method="join", years=range(2000, 2020)) == {False}


@pytest.mark.parametrize("method", ["formula", "list", "join"])
@pytest.mark.parametrize("null_as", [None, False, True])
def test_null_date(spark, method, null_as):
    frame = spark.createDataFrame([(None, 1), (D(2001, 5, 2), 2)], "date date, n int")
    rows = label_holidays(frame, method=method, null_as=null_as).orderBy("n").collect()
    assert [row["is_belgian_holiday"] for row in rows] == [null_as, False]
    assert list(rows[0].asDict()) == ["date", "n", "is_belgian_holiday"]


def test_methods_agree_on_every_day_of_the_listed_years(spark):
    days = spark.range(7305).select(F.date_add(F.lit("2000-01-01").cast("date"),
                                               F.col("id").cast("int")).alias("date"))
    by_formula = label_holidays(days)
    for method in ("list", "join"):
        assert_same_frames(label_holidays(days, method=method), by_formula, False)
    assert by_formula.where("is_belgian_holiday").count() == len(holiday_dates(range(2000, 2020)))


def test_timestamps_are_labelled_by_their_day(spark):
    frame = spark.createDataFrame([(dt.datetime(2018, 7, 21, 15, 30),)], "date timestamp")
    for method in ("formula", "list", "join"):
        assert label_holidays(frame, method=method).first()["is_belgian_holiday"] is True


def test_ascension_on_labour_day_is_listed_once(spark):
    calendar = holiday_calendar(spark, [2008])
    assert calendar.where(F.col("date") == D(2008, 5, 1)).count() == 1
    assert calendar.count() == 11
    frame = spark.createDataFrame([(D(2008, 5, 1),)], "date date")
    assert label_holidays(frame, method="join").count() == 1


def test_known_easters(spark):
    easters = {1943: D(1943, 4, 25), 1961: D(1961, 4, 2), 2000: D(2000, 4, 23), 2008: D(2008, 3, 23),
               2024: D(2024, 3, 31), 2285: D(2285, 3, 22), 1818: D(1818, 3, 22)}
    frame = spark.createDataFrame([(y,) for y in easters], "year int")
    rows = with_easter(frame, F.col("year"), "easter").collect()
    assert {row["year"]: row["easter"] for row in rows} == easters


def test_calendar_has_the_years_of_the_data_only(spark):
    frame = spark.createDataFrame([(D(2001, 3, 1),), (D(2005, 3, 1),), (D(2005, 4, 1),), (None,)], "d date")
    years = {row["d"].year for row in holiday_calendar_of(frame, "d").collect()}
    assert years == {2001, 2005}
    assert holiday_calendar(spark, [2001, 2005]).count() == len(holiday_dates([2001, 2005]))
    assert holiday_calendar(spark, []).count() == 0


def test_labelling_needs_no_python_and_the_formula_no_shuffle(spark, plan_of):
    frame = spark.range(10).select(
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("id").cast("int")).alias("date")
    )
    assert "Exchange" not in plan_of(label_holidays(frame))
    assert "BroadcastHashJoin" in plan_of(label_holidays(frame, method="join"))
    for method in ("formula", "list", "join"):
        assert "Python" not in plan_of(label_holidays(frame, method=method))


@pytest.mark.parametrize("options", [{}, {"method": "list"}, {"method": "join"}, {"method": "join", "years": [2018]}])
def test_text_dates_that_cannot_be_read_have_no_label(spark, options):
    frame = spark.createDataFrame([("2018-07-21",), ("2018-07-22",), ("nope",), (None,)], "date string")
    found = label_holidays(frame, **options).collect()
    assert {r["date"]: r["is_belgian_holiday"] for r in found} == {
        "2018-07-21": True, "2018-07-22": False, "nope": None, None: None}
    assert {r["is_weekend"] for r in label_weekend(frame.where("date = 'nope'")).collect()} == {None}

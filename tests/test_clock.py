import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.functions import clock

DAY = dt.date(2020, 12, 31)


def at(hour, minute, day=31, month=12, year=2020):
    return dt.datetime(year, month, day, hour, minute)


def next_day(hour, minute):
    return dt.datetime(2021, 1, 1, hour, minute)


def outcome(spark, make, cells, day=DAY):
    frame = spark.createDataFrame([(i, day, c) for i, c in enumerate(cells)], "i int, day "
                                  + ("string" if isinstance(day, str) else "date") + ", cell string")
    rows = frame.select("i", make(F.col("day"), F.col("cell")).alias("at")).orderBy("i").collect()
    return [row["at"] for row in rows]


@pytest.mark.parametrize("day", [DAY, "2020-12-31"])
def test_strict_times(spark, day):
    cells = ["340", "1340", "2400", "2410", "3", "0000", "1260", "12345", "ab", "-5", "", " 12", None]
    expected = [at(3, 40), at(13, 40), None, None, at(0, 3), at(0, 0)] + [None] * 7
    assert outcome(spark, clock.at_clock_time, cells, day) == expected


def test_overflowing_times(spark):
    cells = ["3", "340", "1340", "2400", "2410", "3610", "12345", "ab", None]
    expected = [at(0, 3), at(3, 40), at(13, 40), next_day(0, 0), next_day(0, 10), next_day(12, 10),
                None, None, None]
    assert outcome(spark, clock.after_day_start, cells) == expected


def test_only_2400_is_next_midnight(spark):
    def make(day, cell):
        return clock.at_clock_number_or_midnight(day, cell.try_cast("short"))

    cells = ["2400", "2410", "2359", "0", "-1", "12345", None]
    assert outcome(spark, make, cells) == [
        next_day(0, 0), None, at(23, 59), at(0, 0), None, None, None
    ]


def test_unreadable_day_gives_null(spark):
    for make in (clock.at_clock_time, clock.after_day_start):
        assert outcome(spark, make, ["340", "2400"], "someday") == [None, None]


def test_several_columns_at_once(spark):
    frame = spark.createDataFrame([(DAY, 340, 2400)], "day date, a short, b short")
    row = clock.put_clock_times(frame, "day", ["a", "b"]).first()
    assert (row["a"], row["b"]) == (at(3, 40), next_day(0, 0))


@pytest.mark.parametrize("minutes, expected", [
    (-16, (-16, 0, False, -2)), (-15, (-15, 0, False, -1)), (-1, (-1, 0, False, -1)),
    (0, (0, 0, False, 0)), (14, (14, 14, False, 0)), (15, (15, 15, True, 1)),
    (179, (179, 179, True, 11)), (180, (180, 180, True, 12)), (500, (500, 500, True, 12)),
    (None, (None, None, None, None)),
])
def test_delay_columns(spark, minutes, expected):
    planned = at(12, 0)
    actual = None if minutes is None else planned + dt.timedelta(minutes=minutes)
    frame = spark.createDataFrame([(actual, planned)], "actual timestamp, planned timestamp")
    row = clock.with_delay_columns(frame, "actual", "planned", "arr").first()
    assert tuple(row)[2:] == expected

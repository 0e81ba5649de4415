"""Belgian public holidays as arithmetic on the date, for any year.

Easter follows the published anonymous Gregorian computus (Meeus, Jones, Butcher).
The same formula serves Python integers and Spark columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month * 100 + day of the holidays with a fixed date (New Year,
# Labour Day, National Day, Assumption, All Saints, Armistice, Christmas), and days
# after Easter Sunday of the others (Easter Sunday and Monday, Ascension, Whit
# Sunday and Monday).
FIXED_DAYS = (101, 501, 721, 815, 1101, 1111, 1225)
DAYS_AFTER_EASTER = (0, 1, 39, 49, 50)


# The computus in three steps, for ints and columns alike; `div` is whole-number division.
def _epact(year, div):
    century = div(year, 100)
    skipped = div(century - div(century + 8, 25) + 1, 3)
    return (19 * (year % 19) + century - div(century, 4) - skipped + 15) % 30


def _weekday(year, epact, div):
    return (32 + 2 * (div(year, 100) % 4) + 2 * div(year % 100, 4) - epact - year % 4) % 7


def _days_after_march_1(year, epact, weekday, div):
    shift = div(year % 19 + 11 * epact + 22 * weekday, 451)
    return epact + weekday - 7 * shift + 21


def _column_div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b))


def with_easter(frame: DataFrame, year: Column, name: str) -> DataFrame:
    """Add the date of Easter Sunday of a year (1 to 9999).

    Step by step, each result a column of its own: as one expression the steps would
    be written out again wherever they are used, too long for one generated method.
    """
    year_c, epact, weekday = "__year", "__epact", "__weekday"
    steps = frame.withColumn(year_c, year.cast("int"))
    steps = steps.withColumn(epact, _epact(F.col(year_c), _column_div))
    steps = steps.withColumn(weekday, _weekday(F.col(year_c), F.col(epact), _column_div))
    days = _days_after_march_1(F.col(year_c), F.col(epact), F.col(weekday), _column_div)
    march = F.make_date(F.col(year_c), F.lit(3), F.lit(1))
    return steps.withColumn(name, F.date_add(march, days.cast("int"))).drop(year_c, epact, weekday)


def holidays_of_year(year: Column, easter: Column) -> Column:
    """The year's holidays as an array of distinct dates.

    Two of them can fall on the same day: Ascension was on 1 May in 2008.
    """
    fixed = [F.make_date(year.cast("int"), F.lit(md // 100), F.lit(md % 100)) for md in FIXED_DAYS]
    moving = [F.date_add(easter, days) for days in DAYS_AFTER_EASTER]
    return F.array_distinct(F.array(*fixed, *moving))


def is_holiday(day: Column, easter: Column) -> Column:
    """Whether a date is a holiday, given Easter of its year; NULL for NULL."""
    on_fixed_day = (F.month(day) * 100 + F.dayofmonth(day)).isin(*FIXED_DAYS)
    return on_fixed_day | F.datediff(day, easter).isin(*DAYS_AFTER_EASTER)


def holiday_dates(years: Iterable[int]) -> list[dt.date]:
    """Holidays of some years as Python dates, in order."""
    dates = set()
    for year in years:
        epact = _epact(year, int.__floordiv__)
        weekday = _weekday(year, epact, int.__floordiv__)
        easter = dt.date(year, 3, 1) + dt.timedelta(
            days=_days_after_march_1(year, epact, weekday, int.__floordiv__)
        )
        dates.update(easter + dt.timedelta(days=n) for n in DAYS_AFTER_EASTER)
        dates.update(dt.date(year, md // 100, md % 100) for md in FIXED_DAYS)
    return sorted(dates)


def is_belgian_holiday(day: dt.date) -> bool:
    """Whether one Python date is a holiday."""
    return day in holiday_dates([day.year])

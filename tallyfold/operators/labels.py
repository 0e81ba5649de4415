"""Calendar labels: weekends and Belgian public holidays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.functions.holidays import (
    holiday_dates,
    holidays_of_year,
    is_holiday,
    with_easter,
)
from tallyfold.operators.shape import fill_false

# Fixed value: the years a listed calendar covers unless told otherwise.
LISTED_YEARS = range(2000, 2020)


def label_weekend(
    frame: DataFrame, colname: str = "date", new_colname: str = "is_weekend"
) -> DataFrame:
    """Add whether a date is a Saturday or Sunday."""
    # Counted from Monday as 0.
    return frame.withColumn(new_colname, F.weekday(F.col(colname).try_cast("date")) >= 5)


def _calendar(years: DataFrame, colname: str) -> DataFrame:
    years = with_easter(years, F.col("year"), "easter")
    dates = holidays_of_year(F.col("year"), F.col("easter"))
    return years.select(F.explode(dates).alias(colname))


def holiday_calendar(spark: SparkSession, years: Iterable[int], colname: str = "date") -> DataFrame:
    """Holidays of the given years, one row per date."""
    years = sorted(set(years))
    if not years:
        return spark.range(0).select(F.current_date().alias(colname))
    span = spark.range(years[0], years[-1] + 1)
    if len(years) <= years[-1] - years[0]:
        span = span.where(F.col("id").isin(*years))
    return _calendar(span.withColumnRenamed("id", "year"), colname)


def holiday_calendar_of(frame: DataFrame, colname: str = "date") -> DataFrame:
    """Holidays of the years that occur in a date column, one row per date.

    The years are combined on the map side, so one value per year and task shuffles.
    """
    years = frame.select(F.year(F.col(colname).try_cast("date")).alias("year")).where("year between 1 and 9999").distinct()
    return _calendar(years, colname)


def label_holidays(
    frame: DataFrame,
    colname: str = "date",
    new_colname: str = "is_belgian_holiday",
    method: str = "formula",
    years: Iterable[int] | None = None,
    null_as: bool | None = None,
) -> DataFrame:
    """Add whether a date is a Belgian public holiday.

    - `formula`: arithmetic on the date itself. Any year, no table, no shuffle.
    - `list`: membership in the listed dates of `years` (2000 to 2019 by default);
      a date of another year is false.
    - `join`: left join to a calendar table of `years`, or of the years in the data
      if none are given. The calendar has 12 dates a year, 9,999 years at most, so
      it is always broadcast.

    A NULL date, or text that is none, has a NULL label, or `null_as`.
    """
    if method == "formula":
        if years is not None:
            raise ValueError("the formula knows all years; leave `years` out")
        day = F.col(colname).try_cast("date")
        labelled = with_easter(frame, F.year(day), "__easter")
        labelled = labelled.withColumn(new_colname, is_holiday(day, F.col("__easter")))
        labelled = labelled.drop("__easter")
    elif method == "list":
        listed = holiday_dates(LISTED_YEARS if years is None else years)
        labelled = frame.withColumn(new_colname, F.col(colname).try_cast("date").isin(*listed))
    elif method == "join":
        if years is None:
            calendar = holiday_calendar_of(frame, colname)
        else:
            calendar = holiday_calendar(frame.sparkSession, years, colname)
        calendar = calendar.select(
            F.col(colname).alias("__holiday"), F.lit(True).alias(new_colname)
        )
        labelled = frame.join(
            F.broadcast(calendar), F.col(colname).try_cast("date") == F.col("__holiday"), "left"
        ).drop("__holiday")
        labelled = labelled.withColumn(
            new_colname,
            F.when(F.col(colname).try_cast("date").isNotNull(), F.coalesce(new_colname, F.lit(False))),
        )
    else:
        raise ValueError(f"unknown method {method!r}")
    if null_as is None:
        return labelled
    if null_as is False:
        return fill_false(labelled, new_colname)
    return labelled.withColumn(new_colname, F.coalesce(F.col(new_colname), F.lit(null_as)))

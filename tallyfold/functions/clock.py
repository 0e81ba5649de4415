"""Clock times kept as HHMM numbers next to a date, and delays between timestamps.

Times are local to the session zone. All of it is arithmetic inside generated
code: no text is parsed per row except the digits of the clock cell itself.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The delay flag starts at 15 minutes; the groups are 15-minute
# steps, from -2 (more than 15 early) to 12 (180 or more late).
LATE_AFTER_MINUTES = 15
GROUP_MINUTES = 15
FIRST_GROUP, LAST_GROUP = -2, 12

ONE_MINUTE = dt.timedelta(minutes=1)


def clock_number(text: Column) -> Column:
    """HHMM text of one to four digits as a number; NULL for anything else."""
    text = text.cast("string")
    return F.when(text.rlike("^[0-9]{1,4}$"), text.try_cast("int"))


def _minutes(number: Column) -> Column:
    """HHMM number as minutes: 1405 is 845, as each hour counts 100 where it has 60."""
    return number - F.call_function("div", number, F.lit(100)) * 40


def _is_clock(number: Column) -> Column:
    return number.between(0, 2359) & (number % 100 < 60)


def _wall_clock(day: Column, minutes: Column) -> Column:
    # Added without a zone and put into the session's zone at the end, so that 14:05 is
    # 14:05 on days with a clock change too. Much cheaper than building a timestamp from
    # its six parts.
    without_zone = day.try_cast("date").cast("timestamp_ntz") + F.lit(ONE_MINUTE) * minutes
    return without_zone.cast("timestamp")


def at_clock_number(day: Column, number: Column) -> Column:
    """Date and HHMM number to timestamp; NULL unless 0000 to 2359 with minutes below 60."""
    return F.when(_is_clock(number), _wall_clock(day, _minutes(number)))


def at_clock_time(day: Column, text: Column) -> Column:
    """As `at_clock_number` on a text cell: "1405" is 14:05:00."""
    return at_clock_number(day, clock_number(text))


def at_clock_number_or_midnight(day: Column, number: Column) -> Column:
    """As `at_clock_number`, with exactly 2400 as midnight of the next day."""
    return F.when(_is_clock(number) | (number == 2400), _wall_clock(day, _minutes(number)))


def after_day_start(day: Column, text: Column) -> Column:
    """HHMM text as time elapsed since the day began, past midnight if need be.

    2400 is the next midnight and 3610 is 12:10 the day after.
    """
    start = day.try_cast("date").cast("timestamp")
    return start + F.lit(ONE_MINUTE) * _minutes(clock_number(text))


def put_clock_times(frame: DataFrame, day: str, columns: list[str]) -> DataFrame:
    """Turn several HHMM number columns of the same day into timestamps, in one projection."""
    return frame.withColumns(
        {c: at_clock_number_or_midnight(F.col(day), F.col(c)) for c in columns}
    )


def with_delay_columns(frame: DataFrame, actual: str, scheduled: str, prefix: str) -> DataFrame:
    """Delay in minutes and the three values derived from it.

    `<prefix>_delay` is actual minus scheduled, `_delay_new` the same without early
    arrivals, `_del15` whether it reaches 15 minutes, `_delay_group` its step.
    """
    delay = F.timestamp_diff("MINUTE", F.col(scheduled), F.col(actual)).cast("int")
    late = F.greatest(delay, F.lit(0))
    step = F.floor(delay / GROUP_MINUTES)
    return frame.withColumns({
        f"{prefix}_delay": delay,
        # greatest() skips NULLs, so an unknown delay has to be kept unknown here.
        f"{prefix}_delay_new": F.when(delay.isNotNull(), late),
        f"{prefix}_del15": delay >= LATE_AFTER_MINUTES,
        f"{prefix}_delay_group": F.when(
            delay.isNotNull(), F.least(F.greatest(step, F.lit(FIRST_GROUP)), F.lit(LAST_GROUP))
        ).cast("int"),
    })

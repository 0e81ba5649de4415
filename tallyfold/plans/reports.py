"""The complete flights view and the reports on it.

Periods are date ranges, not `year(date) = ...`, so that they reach the Parquet scan
as filters on the row groups.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.joins import attach_dimension, valid_at_join
from tallyfold.plans.flights import CLEAN_NAMES, DELAY_CAUSES

CAUSE_COLUMNS = tuple(CLEAN_NAMES[cause] for cause in DELAY_CAUSES)


def with_carriers(
    flights: DataFrame, carriers: DataFrame, code: str = "CARRIER", name: str = "CARRIER_NAME",
    **options,
) -> DataFrame:
    """Flights with the name their carrier had on the flight date."""
    return valid_at_join(
        flights, carriers, "unique_carrier", "flight_date", code,
        "START_DATE_SOURCE", "THRU_DATE_SOURCE", {name: "carrier_name"}, **options,
    )


def master_flights(
    flights: DataFrame, carriers: DataFrame, airports: DataFrame,
    code: str = "CARRIER", name: str = "CARRIER_NAME", airport_name: str = "DISPLAY_AIRPORT_NAME",
    **options,
) -> DataFrame:
    """Flights with carrier name and the names of both airports; no flight is lost or doubled.

    Dimensions with a key twice are refused; the airports are looked at once for both ends.
    """
    view = with_carriers(flights, carriers, code, name, **options)
    for end in ("origin", "dest"):
        view = attach_dimension(
            view, airports, end, "AIRPORT", {airport_name: f"{end}_airport_name"},
            check=end == "origin", **options,
        )
    return view


def in_year(column: str, year: int) -> Column:
    day = F.col(column)
    first, after = (F.lit(f"{y:04d}-01-01").cast("date") for y in (year, year + 1))
    return (day >= first) & (day < after)


def flights_operated_by(view: DataFrame, carrier_name: str, year: int) -> DataFrame:
    """Number of flights of one carrier in a year."""
    chosen = view.where(in_year("flight_date", year) & (F.col("carrier_name") == carrier_name))
    return chosen.agg(F.count(F.lit(1)).alias("flights"))


def flights_on_time(
    view: DataFrame, carrier_name: str, year: int, minutes: int = 10
) -> DataFrame:
    """Number of those flights that arrived at most `minutes` late.

    A flight without arrival delay (cancelled, diverted) did not arrive on time.
    """
    chosen = view.where(
        in_year("flight_date", year)
        & (F.col("carrier_name") == carrier_name)
        & (F.col("arr_delay") <= minutes)
    )
    return chosen.agg(F.count(F.lit(1)).alias("flights"))


def delayed_share_by_weekday(
    flights: DataFrame, date: str = "flight_date", delay: str = "dep_delay"
) -> DataFrame:
    """Share of departures with a delay per day of the week (Sunday is 1).

    Flights with unknown delay are left out. `is_highest` marks the day or days with
    the highest share.
    """
    shares = (
        flights.where(F.col(delay).isNotNull() & F.col(date).isNotNull())
        .groupBy(F.dayofweek(date).alias("weekday"))
        .agg(
            F.count(F.lit(1)).alias("departures"),
            F.count(F.when(F.col(delay) > 0, 1)).alias("delayed"),
        )
        .withColumn("share", F.col("delayed") / F.col("departures"))
    )
    # Seven rows at most come this far.
    everything = Window.partitionBy(F.lit(0))
    return shares.withColumn("is_highest", F.col("share") == F.max("share").over(everything))


def is_delayed_most_on(shares: DataFrame, weekday: int = 6) -> bool:
    """Whether one weekday (Friday is 6) has the single highest share."""
    top = shares.where("is_highest").limit(2).collect()
    return [row["weekday"] for row in top] == [weekday]


def delay_causes(
    flights: DataFrame, year: int, causes: Mapping[str, str] | None = None,
    date: str = "flight_date",
) -> DataFrame:
    """Per cause of delay: flights it delayed in a year and the minutes it cost.

    One aggregated row for all causes, turned into rows afterwards.
    """
    causes = causes or {column: column for column in CAUSE_COLUMNS}
    figures = [
        F.struct(
            F.lit(label).alias("cause"),
            F.count(F.when(F.col(column) > 0, 1)).alias("flights"),
            F.coalesce(F.sum(F.when(F.col(column) > 0, F.col(column).cast("long"))), F.lit(0))
            .alias("minutes"),
        )
        for column, label in causes.items()
    ]
    totals = flights.where(in_year(date, year)).agg(F.array(*figures).alias("figures"))
    return totals.select(F.explode("figures").alias("f")).select("f.*")


def top_delay_cause(flights: DataFrame, year: int, **options) -> DataFrame:
    """The cause that delayed most flights in a year; ties go to the lower name."""
    return delay_causes(flights, year, **options).orderBy(F.desc("flights"), "cause").limit(1)

"""Who reigned while whom governed: a join of two tables of periods, by year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.ranges import ranges_overlap
from tallyfold.operators.overlap import overlap_join

OFFICE = ("entered_office_on", "left_office_on")
REIGN = ("reign start", "reign stop")


def year_of(date_text: Column) -> Column:
    """Year of a date given as text; NULL if it is none."""
    return F.year(date_text.try_cast("date"))


def reign_overlaps_office(reigns: DataFrame, offices: DataFrame) -> Column:
    """Whether a reign and an office share a year; an open end reaches on."""
    years = [year_of(offices[bound]) for bound in OFFICE]
    return ranges_overlap(reigns[REIGN[0]], reigns[REIGN[1]], *years)


def offices_with_reigns(offices: DataFrame, reigns: DataFrame, **options) -> DataFrame:
    """Every office with each reign it shares a year with, in order of both starts."""
    dated = offices.withColumns(
        {f"__{bound}": year_of(F.col(bound)) for bound in OFFICE}
    )
    years = tuple(f"__{bound}" for bound in OFFICE)
    joined = overlap_join(dated, reigns, years, REIGN, "left", **options)
    return joined.drop(*years).orderBy(OFFICE[0], REIGN[0])

"""Collects queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyfold.session import adopt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables as frames, and frames derived from them by SQL text."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._folder}/{name}.parquet")

    def derive(self, text: str, *names: str) -> DataFrame:
        """Run SQL that refers to tables as {name}."""
        return self.spark.sql(text, **{name: getattr(self, name) for name in names})


def query(name: str, sql: str | None = None):
    """Register a function of `Tables` as a query; without SQL only its rows are counted."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists")
        QUERIES[name] = lambda spark, folder: build(Tables(adopt(spark), folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def local(column: Column | str) -> Column:
    """A timestamp as local date and time without a zone, as the SQL side has it."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def utc(column: Column | str) -> Column:
    """A timestamp as its UTC date and time, whatever the session zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local(column))

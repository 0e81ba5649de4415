"""Raw text taken in with an account of every line, and of every cell, in the pass that writes.

`read_checked` puts lines that do not fit the header aside instead of padding or cutting them in
silence. `Quality` counts missing, unreadable and unknown cells by metrics that the writing tasks
collect, so the raw data is read once.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.casting import safe_cast
from tallyfold.session import materialise

# The column in which the reader leaves a line that does not have the header's number of cells.
MISFIT = "__misfit"
QUALITY = "column string, rows bigint, missing bigint, uncastable bigint, unknown bigint"


class Intake(NamedTuple):
    """Rows that fit the header, and the lines that do not as (line, reason)."""

    rows: DataFrame
    quarantine: DataFrame


def header_of(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """The column names of delimited text, without reading more than its first lines."""
    return spark.read.options(header="true", sep=separator, inferSchema="false").csv(path).columns


def read_checked(
    spark: SparkSession, path: str, separator: str = ",", quote: str = '"', null_token: str | None = None,
    columns: Sequence[str] | None = None,
) -> Intake:
    """Delimited text with a header line, every cell as text, misfits apart.

    Reasons are `cells` for a line with fewer or more cells than the header, and `quote` for one
    whose quotes do not pair up, however many cells that leaves. Cells hold no line ends. Blank lines are no
    rows, and a line like the first is a header, as every file has one. Lines are read and parsed once and written
    to the shared folder with their reason, so both frames come from one reading.
    """
    header = spark.read.text(path).first()
    names = list(columns or (header_of(spark, path, separator) if header else []))
    if not names:
        raise ValueError("a file without a header needs columns=")
    options = {"sep": separator, "quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MISFIT}
    if null_token is not None:
        options["nullValue"] = null_token
    schema = ", ".join(f"`{n}` string" for n in [*names, MISFIT])
    lines = spark.read.text(path).select(F.regexp_replace("value", r"^\uFEFF|\r$", "").alias("line"))
    lines = lines.where(F.trim("line") != "")
    if header:
        lines = lines.where(F.col("line") != F.lit(header[0].removeprefix("\ufeff").rstrip("\r")))
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    parsed = lines.select("line", F.from_csv("line", schema, options).alias("cells"), (quotes % 2 == 1).alias("open"))
    reason = F.when(F.col("open"), "quote").when(F.col(f"cells.{MISFIT}").isNotNull(), "cells")
    marked = materialise(parsed.select("cells", reason.alias("reason"), F.when(reason.isNotNull(), F.col("line")).alias("line")), "intake")
    good = marked.where("reason IS NULL").select(*[F.col("cells").getField(n).alias(n) for n in names])
    return Intake(good, marked.where("reason IS NOT NULL").select("line", "reason"))


def quality_metrics(
    names: Sequence[str], expected: Mapping[str, T.DataType] | None = None,
    unknown: Mapping[str, Collection[str]] | None = None,
) -> list[Column]:
    """One counter for all rows and up to three for each column, named by its place."""
    expected, unknown = expected or {}, unknown or {}

    def times(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    counters = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(names):
        cell = F.col(f"`{name}`")
        counters.append(times(cell.isNull(), f"missing_{i}"))
        if name in expected:
            counters.append(times(cell.isNotNull() & safe_cast(cell, expected[name]).isNull(), f"uncastable_{i}"))
        if unknown.get(name):
            counters.append(times(cell.isin(*unknown[name]), f"unknown_{i}"))
    return counters


class Quality:
    """Counts the cells of a frame while another action runs over it.

    `watch` gives the frame to go on with; after the action over what was made of it,
    `table` has a row per column. Counts are of the rows that pass the watched place, once each,
    also where a task runs again.
    """

    def __init__(self, expected: Mapping[str, T.DataType] | None = None, unknown: Mapping[str, Collection[str]] | None = None):
        self._expected, self._unknown = expected, unknown
        self._seen = Observation()
        self._names: list[str] = []

    def watch(self, frame: DataFrame) -> DataFrame:
        self._names = frame.columns
        return frame.observe(self._seen, *quality_metrics(self._names, self._expected, self._unknown))

    def table(self, spark: SparkSession) -> DataFrame:
        """Rows (column, rows, missing, uncastable, unknown); the counts are a few numbers, no job runs for them."""
        found = self._seen.get
        rows = [(name, found["rows"], *[found.get(f"{kind}_{i}", 0) for kind in ("missing", "uncastable", "unknown")])
                for i, name in enumerate(self._names)]
        return spark.createDataFrame(rows, QUALITY)

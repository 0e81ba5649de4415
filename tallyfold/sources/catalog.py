"""A registry of named datasets, so that jobs name data and not its whereabouts."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyfold.session import whole_number_timestamps

# House rule for delimited text: every column arrives as a string and is cast later.
TEXT_OPTIONS = {"header": "true", "inferSchema": "false"}


# Bytes of stored data that a bucket should hold.
BUCKET_BYTES = 128 * 1024 * 1024


class Buckets(NamedTuple):
    """Rows dealt by the hash of key columns over a fixed number of files, each sorted by these."""

    number: int
    by: tuple[str, ...]


class DataLink(NamedTuple):
    """Format, location (any Hadoop path: file, hdfs, s3a, ...), reader options, and buckets if it has any."""

    format: str
    path: str
    options: Mapping[str, str] = {}
    buckets: Buckets | None = None


def buckets_for(stored_bytes: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Number of buckets for a table of some size, a power of two, so that tables of other sizes fit to it."""
    return 2 ** max(0, math.ceil(math.log2(max(1, stored_bytes) / bucket_bytes)))


class Catalog:
    """Datasets by name."""

    def __init__(self, spark: SparkSession, links: Mapping[str, DataLink]):
        self._spark = spark
        self._links = dict(links)

    def __contains__(self, name: str) -> bool:
        return name in self._links

    def link(self, name: str) -> DataLink:
        if name not in self._links:
            raise KeyError(f"no dataset {name!r}; known: {sorted(self._links)}")
        return self._links[name]

    def load(self, name: str) -> DataFrame:
        link = self.link(name)
        if link.buckets:
            return self._spark.table(self._table(name))
        return self._spark.read.format(link.format).options(**link.options).load(str(link.path))

    def save(self, frame: DataFrame, name: str, mode: str = "overwrite", **options) -> None:
        """Write a dataset. One with buckets is dealt by their keys once, one file per bucket.

        Bucketed datasets that have the same number of buckets join on their keys without a shuffle. All rows
        of a key are in one bucket, so keys should be of no hot column.
        """
        with whole_number_timestamps(self._spark):
            self._write(frame, name, mode, **options)

    def _write(self, frame: DataFrame, name: str, mode: str, **options) -> None:
        link = self.link(name)
        if not link.buckets:
            writer = frame.write.format(link.format).mode(mode)
            writer.options(**{**link.options, **options}).save(str(link.path))
            return
        number, keys = link.buckets
        # The exchange deals by the hash that buckets go by, so that each task writes one bucket.
        writer = frame.repartition(number, *keys).write.format(link.format).mode(mode).options(**{**link.options, **options})
        writer.bucketBy(number, *keys).sortBy(*keys).option("path", str(link.path)).saveAsTable(self._table_name(name))

    def _table_name(self, name: str) -> str:
        return f"{name}_{hashlib.sha256(str(self.link(name).path).encode()).hexdigest()[:16]}"

    def _table(self, name: str) -> str:
        """The table over a bucketed dataset. A session that has none, such as a later one, gets it from the files."""
        link, table = self.link(name), self._table_name(name)
        if not self._spark.catalog.tableExists(table):
            columns = self._spark.read.format(link.format).options(**link.options).load(str(link.path)).schema
            keys = ", ".join(f"`{k}`" for k in link.buckets.by)
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            path = str(link.path).replace("'", "\\'")
            self._spark.sql(f"CREATE TABLE {table} ({fields}) USING {link.format} CLUSTERED BY ({keys}) "
                            f"SORTED BY ({keys}) INTO {link.buckets.number} BUCKETS LOCATION '{path}'")
        return table


def flight_catalog(source_dir: str, target_dir: str) -> dict[str, DataLink]:
    """The datasets of the flights jobs: raw text in one folder, clean tables in another."""
    raw = {name: DataLink("csv", f"{source_dir}/{path}", TEXT_OPTIONS) for name, path in (
        ("raw_flights", "flights"),
        ("raw_airports", "airports.csv"),
        ("raw_carriers", "carriers.csv"),
    )}
    raw["raw_flights"] = raw["raw_flights"]._replace(options={**TEXT_OPTIONS, "nullValue": "null"})
    clean = {name: DataLink("parquet", f"{target_dir}/{path}") for name, path in (
        ("clean_flights", "cleaned_flights"),
        ("clean_airports", "clean_airports"),
        ("clean_carriers", "clean_carriers"),
        ("master_flights", "master_flights"),
    )}
    return raw | clean


def quality_catalog(target_dir: str) -> dict[str, DataLink]:
    """Where the flights job saves the quality of the raw cells; joined to its catalog by those who want it."""
    return {"flight_quality": DataLink("parquet", f"{target_dir}/flight_quality")}


def movie_catalog(source_dir: str, target_dir: str) -> dict[str, DataLink]:
    """The datasets of the movies job."""
    return {
        "movies_before": DataLink("csv", f"{source_dir}/movies_before", TEXT_OPTIONS),
        "movies_after": DataLink("csv", f"{source_dir}/movies_after", TEXT_OPTIONS),
        "movie_scores": DataLink("json", f"{target_dir}/movie_scores"),
    }


def read_text_table(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    infer_types: bool = False,
    null_token: str | None = None,
) -> DataFrame:
    """Delimited text with a header line.

    Types are inferred only on request, as that reads the whole file once more.
    `null_token` is text that means NULL, next to the empty cell.
    """
    options = {"header": "true", "sep": separator, "inferSchema": str(infer_types).lower()}
    if null_token is not None:
        options["nullValue"] = null_token
    return spark.read.options(**options).csv(path)


def write_parquet(
    frame: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    files: int | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Write Parquet with a chosen codec.

    `files` fixes the number of output files with one round-robin shuffle; leave it
    out for large tables, where each task writes its own file. `sort_by` orders rows
    inside each file, which helps run-length encoding and later row-group skipping.
    """
    if files is not None:
        frame = frame.repartition(files)
    if sort_by:
        frame = frame.sortWithinPartitions(*sort_by)
    frame.write.parquet(path, mode=mode, compression=compression)


def write_json_lines(frame: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per row; numbers stay numbers, NULL cells are left out."""
    frame.write.json(path, mode=mode)

"""Session settings the toolkit is written for."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even when a later operator then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles a method beyond 8,000 bytes. A wide projection past that size
    # is better split into many methods than fused into one that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# What Spark has by itself: the longest method that Java allows.
SPARKS_METHOD_LIMIT = "65535"


def build_session(app_name: str = "tallyfold", master: str | None = None, **extra) -> SparkSession:
    """A session with the settings above; `extra` holds further settings (dots as `__`)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def adopt(spark: SparkSession) -> SparkSession:
    """A session made elsewhere, with the method limit above where it still has Spark's own.

    The limit changes no result, but without it wide projections run interpreted, which takes four times as long. A limit
    that somebody chose stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit) == SPARKS_METHOD_LIMIT:
        spark.conf.set(limit, SETTINGS[limit])
    return spark


@contextmanager
def whole_number_timestamps(spark: SparkSession) -> Iterator[None]:
    """Parquet written inside holds timestamps as 64-bit microseconds, not as Spark's old 96 bits, unless another type was chosen.

    The values are the same, but they are written and read faster, and have statistics.
    """
    kind = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(kind)
    if before == "INT96":
        spark.conf.set(kind, "TIMESTAMP_MICROS")
    try:
        yield
    finally:
        spark.conf.set(kind, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables, on storage that all executors share.

    The cluster names it in `spark.checkpoint.dir`. Where that is unset and all runs on one machine, as in
    tests, a folder beside the session's warehouse tables is used; on a cluster that may be a disk that
    other machines do not see, so there the setting must be made.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch").rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; what is written there goes when the session ends."""
    name = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return name


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder once and go on from the written table.

    For results of joins that several passes read: each pass then scans the columns it
    needs instead of joining again, and an executor that is lost takes nothing along.
    """
    path = scratch_path(frame.sparkSession, label)
    with whole_number_timestamps(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)

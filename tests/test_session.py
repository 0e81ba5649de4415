import datetime as dt

import pyarrow.parquet as pq
import pytest

from tallyfold.session import SETTINGS, SPARKS_METHOD_LIMIT, adopt, materialise
from tallyfold.sources.catalog import Catalog, DataLink
from tallyfold.workload import QUERIES

LIMIT = "spark.sql.codegen.hugeMethodLimit"


@pytest.fixture
def other(spark):
    """A session made elsewhere, without the settings of the library."""
    session = spark.newSession()
    session.conf.set(LIMIT, SPARKS_METHOD_LIMIT)
    return session


def test_a_query_compiles_wide_projections_in_a_session_made_elsewhere(other, data_dir):
    QUERIES["clean_flights"](other, data_dir)
    assert other.conf.get(LIMIT) == SETTINGS[LIMIT]


def test_a_limit_that_somebody_chose_stays(other):
    other.conf.set(LIMIT, "4000")
    assert adopt(other) is other
    assert other.conf.get(LIMIT) == "4000"


TIMES = "spark.sql.parquet.outputTimestampType"


def _physical(folder):
    return {pq.ParquetFile(f).schema.column(0).physical_type for f in folder.glob("*.parquet")}


def test_timestamps_are_written_as_whole_numbers(spark, tmp_path):
    at = [dt.datetime(1895, 3, 4, 5, 6, 7, 89), dt.datetime(2024, 3, 31, 2, 30), None]
    frame = spark.createDataFrame([(a,) for a in at], "at timestamp")
    before = spark.conf.get(TIMES)
    catalog = Catalog(spark, {"times": DataLink("parquet", str(tmp_path / "times"))})
    catalog.save(frame, "times")
    assert _physical(tmp_path / "times") == {"INT64"}
    held = materialise(frame, "times")
    for read in (catalog.load("times"), held):
        assert sorted(map(str, read.collect())) == sorted(map(str, frame.collect()))
    assert spark.conf.get(TIMES) == before == "INT96"


def test_a_chosen_timestamp_type_stays(spark, tmp_path):
    spark.conf.set(TIMES, "TIMESTAMP_MILLIS")
    try:
        catalog = Catalog(spark, {"times": DataLink("parquet", str(tmp_path / "times"))})
        catalog.save(spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS at"), "times")
        assert spark.conf.get(TIMES) == "TIMESTAMP_MILLIS"
    finally:
        spark.conf.unset(TIMES)

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.compare import assert_same_frames
from tallyfold.session import scratch_path, shared_folder
from tallyfold.operators.joins import attach_dimension
from tallyfold.sources.catalog import (
    TEXT_OPTIONS,
    Buckets,
    Catalog,
    DataLink,
    buckets_for,
    flight_catalog,
    read_text_table,
    write_json_lines,
    write_parquet,
)

TEXT = "name;n;left_on\nWilson;2;1970-06-19\nnull;1;\n;3;\"\"\n"


@pytest.fixture
def text_file(tmp_path):
    path = tmp_path / "table.csv"
    path.write_text(TEXT)
    return str(path)


def test_text_stays_text(spark, text_file):
    frame = read_text_table(spark, text_file, ";")
    assert set(dict(frame.dtypes).values()) == {"string"}
    assert [r["name"] for r in frame.collect()] == ["Wilson", "null", None]


def test_types_on_request(spark, text_file):
    kinds = dict(read_text_table(spark, text_file, ";", infer_types=True).dtypes)
    assert kinds == {"name": "string", "n": "int", "left_on": "date"}


def test_null_token(spark, text_file):
    frame = read_text_table(spark, text_file, ";", null_token="null")
    assert [r["name"] for r in frame.collect()] == ["Wilson", None, None]


def test_catalog(spark, tmp_path, text_file):
    links = {"raw": DataLink("csv", text_file, {**TEXT_OPTIONS, "sep": ";"}),
             "clean": DataLink("parquet", str(tmp_path / "clean"))}
    catalog = Catalog(spark, links)
    catalog.save(catalog.load("raw"), "clean")
    catalog.save(catalog.load("raw"), "clean")
    assert_same_frames(catalog.load("clean"), catalog.load("raw"))
    assert "raw" in catalog and "other" not in catalog
    with pytest.raises(KeyError, match="other"):
        catalog.load("other")


def test_flight_catalog_works_on_any_file_system():
    links = flight_catalog("s3a://bucket/in", "s3a://bucket/out")
    assert links["raw_flights"].path == "s3a://bucket/in/flights"
    assert links["raw_flights"].options["nullValue"] == "null"
    assert links["master_flights"] == DataLink("parquet", "s3a://bucket/out/master_flights", {})
    assert len(links) == 7


@pytest.mark.parametrize("codec", ["snappy", "gzip", "uncompressed"])
def test_parquet_codec_and_file_count(spark, tmp_path, codec):
    path = tmp_path / codec
    frame = spark.range(1000).withColumn("x", F.col("id") % 7)
    write_parquet(frame, str(path), compression=codec, files=3, sort_by=["x"])
    files = list(path.glob("*.parquet"))
    assert len(files) == 3
    assert all({"snappy": "snappy", "gzip": "gz", "uncompressed": ""}[codec] in f.name for f in files)
    assert_same_frames(spark.read.parquet(str(path)), frame, check_nullability=False)


def test_sorted_files_are_smaller(spark, tmp_path):
    frame = spark.range(20000).withColumn("x", F.xxhash64("id") % 50).select("x")

    def size(name, **options):
        write_parquet(frame, str(tmp_path / name), compression="uncompressed", files=1, **options)
        return sum(f.stat().st_size for f in Path(tmp_path / name).glob("*.parquet"))

    assert size("sorted", sort_by=["x"]) < size("unsorted")


def test_json_numbers_stay_numbers(spark, tmp_path):
    frame = spark.createDataFrame([(1.5, 2, "a"), (None, 3, None)], "f double, n bigint, s string")
    write_json_lines(frame, str(tmp_path / "json"))
    lines = sorted(line for f in (tmp_path / "json").glob("*.json") for line in f.read_text().splitlines())
    assert lines == ['{"f":1.5,"n":2,"s":"a"}', '{"n":3}']
    assert_same_frames(spark.read.schema(frame.schema).json(str(tmp_path / "json")), frame)


def test_scratch_path_is_in_the_shared_folder(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert a.startswith(shared)


@pytest.fixture
def bucketed(spark, tmp_path):
    catalog = Catalog(spark, {
        "facts": DataLink("parquet", f"file://{tmp_path}/facts", {}, Buckets(8, ("k",))),
        "sides": DataLink("parquet", f"file://{tmp_path}/sides", {}, Buckets(8, ("key",))),
    })
    catalog.save(spark.range(2000).select((F.col("id") % 300).alias("k"), "id"), "facts")
    catalog.save(spark.range(0, 600, 2).select(F.col("id").alias("key"), F.concat(F.lit("s"), "id").alias("name")), "sides")
    return catalog


def test_bucketed_datasets_join_where_they_lie(spark, bucketed, tmp_path, plan_of, monkeypatch):
    files = list((tmp_path / "facts").glob("*.parquet"))
    assert 0 < len(files) <= 8
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts, sides = bucketed.load("facts"), bucketed.load("sides")
        view = attach_dimension(facts, sides, "k", "key", {"name": "name"}, broadcast_bytes=0, check=False)
        plan = plan_of(view)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert sorted(map(tuple, view.collect()), key=lambda r: r[1]) == [
            (i % 300, i, f"s{i % 300}" if i % 2 == 0 else None) for i in range(2000)]
        # A total by the key needs no shuffle either.
        assert "Exchange" not in plan_of(facts.groupBy("k").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_session_without_the_table_reads_the_files(spark, bucketed, plan_of):
    rows = sorted(map(tuple, bucketed.load("sides").collect()))
    spark.sql(f"DROP TABLE {bucketed._table_name('sides')}")
    again = bucketed.load("sides")
    assert sorted(map(tuple, again.collect())) == rows and "Bucketed" in plan_of(again)
    assert "Exchange" not in plan_of(again.groupBy("key").count())
    # Saving goes on as before, with the table and without it.
    for drop in (False, True):
        if drop:
            spark.sql(f"DROP TABLE {bucketed._table_name('sides')}")
        bucketed.save(spark.range(5).select(F.col("id").alias("key"), F.lit("x").alias("name")), "sides")
        assert bucketed.load("sides").count() == 5


def test_number_of_buckets():
    assert [buckets_for(n, 100) for n in (0, 1, 100, 101, 250, 401)] == [1, 1, 1, 2, 4, 8]


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = {name.replace("__", "."): value for name, value in conf.items()}

    assert shared_folder(Session(spark__master="yarn", spark__checkpoint__dir="hdfs://x/y/")) == "hdfs://x/y"
    assert shared_folder(Session(spark__master="local[2]", spark__sql__warehouse__dir="file:/w")) == "file:/w/scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(spark__master="yarn", spark__sql__warehouse__dir="file:/w"))

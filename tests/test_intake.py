import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators import features
from tallyfold.operators.aggregates import column_profile
from tallyfold.sources.intake import Quality, read_checked


@pytest.fixture
def path(tmp_path):
    lines = ["a,b,c", "1,2,3", "4,5", "6,7,8,9", '"x, y",2,"say ""hi"""', '1,"open,3', "", "null,,z", "1,2,3"]
    file = tmp_path / "rows.csv"
    file.write_text("\n".join(lines) + "\n")
    return str(file)


def test_lines_that_do_not_fit_are_set_aside(spark, path):
    good, bad = read_checked(spark, path, null_token="null")
    assert good.columns == ["a", "b", "c"] and set(dict(good.dtypes).values()) == {"string"}
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [("1", "2", "3"), ("1", "2", "3"), ("x, y", "2", 'say "hi"'), (None, None, "z")], key=str)
    found = {(r["line"], r["reason"]) for r in bad.collect()}
    assert ("4,5", "cells") in found and ("6,7,8,9", "cells") in found
    assert {reason for line, reason in found if "open" in line} == {"quote"}
    # Every line but the header and the blank one is on one side.
    assert good.count() + bad.count() == 7


def test_a_file_of_only_a_header(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("a,b\n")
    good, bad = read_checked(spark, str(tmp_path / "empty.csv"))
    assert good.columns == ["a", "b"] and good.isEmpty() and bad.isEmpty()


def test_quality_is_counted_in_the_pass_that_writes(spark, tmp_path, plan_of):
    rows = [("1", "x", None), ("two", "?", "b"), (None, None, "c"), ("4", "?", "d")] * 5
    frame = spark.createDataFrame(rows, "n string, `odd name` string, t string")
    frame.write.parquet(str(tmp_path / "raw"))
    frame = spark.read.parquet(str(tmp_path / "raw"))
    expected, unknown = {"n": T.IntegerType()}, {"odd name": ("?",)}
    quality = Quality(expected, unknown)
    watched = quality.watch(frame).select("n")
    plan = plan_of(watched)
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    watched.write.parquet(str(tmp_path / "clean"))
    found = {tuple(r) for r in quality.table(spark).collect()}
    assert found == {tuple(r) for r in column_profile(frame, expected, unknown).collect()}
    assert ("odd name", 20, 5, 0, 10) in found


def test_indicators_of_more_values_than_columns(spark):
    many = spark.range(6_000).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("v"))
    wide = features.one_hot_columns(many, ["v"], key=["id"])
    assert wide.columns == ["id", "v_vector"]
    found = wide.where("id IN (0, 1, 5999)").select("id", "v_vector.size", "v_vector.indices").collect()
    assert {(r["id"], r["size"], tuple(r["indices"])) for r in found} == {(0, 5999, ()), (1, 5999, (0,)), (5999, 5999, (5998,))}
    lists = many.withColumn("v", F.concat_ws("|", "v", F.lit("v0000")))
    labels = features.label_indicators(lists, "v", key=["id"])
    row = labels.where("id = 7").select("v_vector.size", "v_vector.indices").first()
    assert (row["size"], list(row["indices"])) == (6000, [0, 7])
    few = features.label_indicators(lists.limit(3), "v", key=["id"], without=("v0001",))
    assert few.columns == ["id", "v", "v0000", "v0002"]
    narrow = features.one_hot_columns(many.limit(3).withColumn("w", F.lit("same")), ["v", "w"], key=["id"])
    assert narrow.columns == ["id", "v_v0001", "v_v0002"]

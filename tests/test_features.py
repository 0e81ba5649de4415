import pytest
from pyspark.sql import functions as F

from tallyfold.operators import features


def test_recode(spark):
    frame = spark.createDataFrame([("UK",), ("USA",), ("Japan",), (None,)], "c string")
    groups = {"Europe": ["UK", "France"], "USA": ["USA"]}
    got = [r[0] for r in frame.select(features.recode(F.col("c"), groups, "other")).collect()]
    assert got == ["Europe", "USA", "other", "other"]


def test_keep_most_frequent(spark):
    frame = spark.createDataFrame(
        [(v, w) for v, w in zip(["a", "a", "b", "c", "c", None], "xxyyzz")], "v string, w string")
    rows = features.keep_most_frequent(frame, {"v": 2, "w": 1}).collect()
    assert sorted(r["v"] for r in rows) == ["Other", "Other", "a", "a", "c", "c"]
    # Of equally frequent values the lowest is kept.
    assert sorted(r["w"] for r in rows) == ["Other"] * 4 + ["x", "x"]


def test_label_indicators(spark):
    frame = spark.createDataFrame([("Drama|War",), ("War",), (None,), ("",)], "g string")
    vocabulary = features.label_vocabulary(frame, "g")
    assert features.listed(vocabulary) == ["Drama", "War"] and features.listed(vocabulary, widest=1) is None
    rows = features.add_label_indicators(frame, "g", features.listed(vocabulary)).collect()
    assert [(r["Drama"], r["War"]) for r in rows] == [(1, 1), (0, 1), (0, 0), (0, 0)]


def test_more_values_than_columns_become_a_sparse_vector(spark):
    rows = [(i, f"v{i:05d}|v{(i * 7) % 6000:05d}") for i in range(6000)] + [(6000, None), (6001, "v00003|v00003|unknown")]
    frame = spark.createDataFrame(rows, "id int, g string")
    vocabulary = features.label_vocabulary(frame.where("id <= 6000"), "g")
    assert features.listed(vocabulary) is None
    found = {r["id"]: r["g_vector"] for r in features.indicator_vector(frame, "g", vocabulary, ["id"], "|").collect()}
    assert len(found) == len(rows) and {v["size"] for v in found.values()} == {6000}
    assert all(found[i]["indices"] == sorted({i, i * 7 % 6000}) for i in range(6000))
    assert found[6000]["indices"] == [] and found[6001]["indices"] == [3] and found[6001]["values"] == [1.0]
    single = features.indicator_vector(frame, "id", features.category_values(frame, ["id"])["id"], ["id"])
    assert single.where("size(id_vector.indices) <> 1").isEmpty()


def test_one_hot_drops_the_first_value(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "v string")
    values = features.category_values(frame, ["v"])["v"]
    values = features.listed(values)
    assert values == ["a", "b", "c"]
    hot = features.one_hot(frame, "v", values)
    assert hot.columns == ["v_b", "v_c"]
    assert [tuple(r) for r in hot.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]
    assert features.one_hot(frame, "v", values, drop_first=False).columns == ["v_a", "v_b", "v_c"]


def test_impute(spark):
    frame = spark.createDataFrame(
        [("x", 1, 1.0), ("x", None, float("nan")), (None, 4, None), ("y", 2, 2.0)], "c string, i int, d double")
    values = features.learn_fill_values(frame, ["c"], ["i", "d"])
    assert values == {"c": "x", "i": 2.0, "d": 1.5}
    filled = features.impute(frame, values)
    assert dict(filled.dtypes) == {"c": "string", "i": "double", "d": "double"}
    assert [tuple(r) for r in filled.collect()] == [
        ("x", 1.0, 1.0), ("x", 2.0, 1.5), ("x", 4.0, 1.5), ("y", 2.0, 2.0)]


def test_standardise(spark):
    frame = spark.createDataFrame([(1.0, 5, None), (3.0, 5, None)], "a double, b int, c double")
    scale = features.learn_scale(frame, ["a", "b", "c"])
    rows = features.standardise(frame, scale).collect()
    assert [tuple(r) for r in rows] == [(-1.0, 0.0, None), (1.0, 0.0, None)]


def test_split_is_stable_complete_and_close_to_its_share(spark):
    frame = spark.range(5000).withColumn("x", F.lit(1))
    train, validation = features.split_by_key(frame, ["id"], 0.7, 123)
    again, _ = features.split_by_key(frame.repartition(7), ["id"], 0.7, 123)
    other, _ = features.split_by_key(frame, ["id"], 0.7, 124)
    ids = {r["id"] for r in train.collect()}
    assert ids == {r["id"] for r in again.collect()} != {r["id"] for r in other.collect()}
    assert len(ids) + validation.count() == 5000
    assert 0.67 < len(ids) / 5000 < 0.73

"""Every registered query against its SQL, as the driver does."""

import gzip
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import compare  # noqa: E402
from tallyfold.workload import ORACLES, QUERIES, raw, reports  # noqa: E402
from tallyfold.workload.registry import Tables  # noqa: E402



@pytest.fixture(scope="module")
def db(data_dir):
    connection = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


# Forests draw other numbers in every library, so what they predict has no SQL.
PREDICTIONS = {"predicted_labels", "movie_job"}


def test_all_queries_but_predictions_have_sql():
    assert set(ORACLES) == set(QUERIES) - PREDICTIONS


def test_predicted_labels_are_given_to_the_rows_of_the_sql(spark, db, data_dir):
    rows = QUERIES["predicted_labels"](spark, data_dir).collect()
    keys = db.sql(f"SELECT movie_title, imdb_score_bins FROM ({ORACLES['forest_classification']})").fetchall()
    assert sorted((r["movie_title"], r["imdb_score_bins"]) for r in rows) == sorted(keys) and rows
    assert {r[c] for r in rows for c in ("forest_label", "logistic_label")} <= {"0-5", "5-6", "6-7", "7-10"}


def test_movie_job_scores_the_rows_of_the_sql(spark, db, data_dir):
    rows = QUERIES["movie_job"](spark, data_dir).collect()
    keys = db.sql(f"SELECT movie_title, imdb_score FROM ({ORACLES['forest_regression']})").fetchall()
    assert sorted((r["movie_title"], r["imdb_score"]) for r in rows) == sorted(keys) and rows
    assert all(0 <= r["prediction"] <= 10 for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_and_stays_in_the_jvm(spark, db, data_dir, plan_of, name):
    frame = QUERIES[name](spark, data_dir)
    plan = plan_of(frame)
    assert "CartesianProduct" not in plan
    assert ("Python" in plan) == (name == "udf_typed")
    assert compare(frame, db.sql(ORACLES[name])) == ""


def test_flight_jobs_keeps_its_raw_text_compressed_and_whole(spark, tmp_path, monkeypatch):
    spark.range(3000).selectExpr(
        "id AS l_orderkey", "id % 70 AS l_partkey", "id % 30 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
        "timestamp_seconds(700000000 + id * 86400) AS l_shipdate").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(70).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "'brand' AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    spark.range(30).selectExpr("id AS s_suppkey").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(reports, "scratch_path", lambda spark, label: f"{tmp_path}/job")
    assert QUERIES["flight_jobs"](spark, str(tmp_path)).count() == 3000
    tables = Tables(spark, str(tmp_path))
    for name, stored, table in (("flights", "flights", raw.flights(tables)), ("airports", "airports.csv", raw.airports(tables))):
        stored = tmp_path / "job" / "raw" / stored
        files = [f for f in stored.iterdir() if f.name.startswith("part-")]
        assert files and all(f.name.endswith(".csv.gz") for f in files)
        text = spark.read.options(header="true", nullValue="null").csv(str(stored))
        assert sorted(map(str, text.collect())) == sorted(map(str, table.collect())), name
        if name == "flights":
            assert sum(f.stat().st_size for f in files) < sum(len(gzip.decompress(f.read_bytes())) for f in files) / 2


def test_the_contract_lists_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and "carrier_name" in frame.columns


def test_sorted_queries_are_in_order(spark, data_dir):
    def neighbours(name, key):
        rows = [key(r) for r in QUERIES[name](spark, data_dir).collect()]
        assert rows and all(a <= b for a, b in zip(rows, rows[1:]))

    neighbours("sorted_nulls_first", lambda r: (r["status"] is not None, r["status"] or "", r["o_orderkey"]))
    neighbours("sorted_by_several", lambda r: (r["o_orderpriority"], r["o_custkey"], r["o_orderkey"]))

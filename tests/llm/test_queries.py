"""Queries against their SQL, and what holds for every operator."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_queries import compare  # noqa: E402

from tallyfold.llm.queries import ORACLES, QUERIES  # noqa: E402

NATIVE = {"op1_chat_formatting", "op6_exact_dedup", "op8_sharding"}


def test_there_is_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, data_dir, name):
    db = duckdb.connect()
    for path in Path(data_dir).glob("*.parquet"):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    assert compare(QUERIES[name](spark, data_dir), db.sql(ORACLES[name])) == ""


@pytest.mark.parametrize("name", sorted(NATIVE))
def test_native_operators_stay_in_the_jvm(spark, data_dir, plan_of, name):
    plan = plan_of(QUERIES[name](spark, data_dir))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))

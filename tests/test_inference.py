import pytest
from pyspark.sql import functions as F

from tallyfold.sources import inference
from tallyfold.sources.catalog import read_text_table
from tallyfold.sources.inference import ColumnTypes, read_typed, type_of

CELLS = [
    "5", "+5", "-5", " 5", "007", "2147483647", "2147483648", "-9223372036854775808", "9223372036854775808",
    "123456789012345678901234567890", "1" * 38, "1" * 39, "1.5", "1e5", ".5", "5.", "5d", "NaN", "nan", "Inf", "-Inf", "inf",
    "Infinity", "infinity", "0x1p3", "2020", "2020-01", "2020-1-2", "2020-01-02", "2020-01-02 ", "2020-13-01",
    "2020-01-02 03:04:05", "2020-01-02T03:04:05Z", "10:00", "02/01/2020", "true", "FALSE", "t", "yes", " true", "1,5", "x", "",
]


def one_column(tmp_path, name, cells):
    path = tmp_path / f"{name}.csv"
    path.write_text("a;b\n" + "".join(f"{cell};1\n" for cell in cells))
    return str(path)


def kind(frame):
    return frame.schema["a"].dataType.simpleString()


def test_each_cell_is_of_the_type_the_reader_infers(spark, tmp_path):
    paths = [one_column(tmp_path, i, [cell]) for i, cell in enumerate(CELLS)]
    wanted = [kind(read_text_table(spark, p, ";", infer_types=True)) for p in paths]
    frame = spark.createDataFrame(list(enumerate(CELLS)), "i int, a string")
    found = frame.select("i", inference.cell_kind(F.col("a")).alias("k"), inference.whole_digits(F.col("a")).alias("d"))
    got = [type_of(r["k"], r["d"]) for r in found.orderBy("i").collect()]
    assert {c: (w, g) for c, w, g in zip(CELLS, wanted, got) if w != g} == {}


@pytest.mark.parametrize(("cells", "expected"), [
    (["1", "2147483648"], "bigint"), (["1", "", "2"], "int"), (["1", "1.5"], "double"), (["", ""], "string"),
    (["1", "9223372036854775808"], "decimal(19,0)"), (["9" * 19 + "9", "2147483648"], "decimal(20,0)"),
    (["9" * 25, "1.5"], "double"), (["2020-01-02", "2020-01-02 03:04:05"], "timestamp"), (["2020-01-02", "x"], "string"),
    (["true", "False"], "boolean"), (["true", "1"], "string"), (["1", "2020-01-02"], "string"), (["x", "1"], "string"),
])
def test_columns_take_the_narrowest_common_type(spark, tmp_path, cells, expected):
    for order, rows in enumerate((cells, cells[::-1])):
        path = one_column(tmp_path, order, rows)
        typed = read_typed(spark, path, ";")
        assert kind(typed) == expected and typed.schema["b"].dataType.simpleString() == "int"
        stated = spark.read.options(header="true", sep=";").schema(f"a {expected}, b int").csv(path)
        assert sorted(map(str, typed.collect())) == sorted(map(str, stated.collect()))


def test_types_come_from_one_reading(spark, tmp_path, plan_of):
    path = one_column(tmp_path, "rows", ["1", "2"])
    plan = plan_of(ColumnTypes().watch(read_text_table(spark, path, ";")))
    assert plan.count("FileScan") == 1 and "CollectMetrics" in plan and "Exchange" not in plan
    typed = read_typed(spark, path, ";")
    (tmp_path / "rows.csv").write_text("a;b\nother;text\n")
    # The text is not opened again, and only what is asked for is read.
    assert [r["a"] for r in typed.select("a").orderBy("a").collect()] == [1, 2]
    assert "csv" not in plan_of(typed).lower() and "ReadSchema: struct<a:string>" in plan_of(typed.select("a"))


def test_null_tokens_odd_names_and_no_rows(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("odd name,x.y\nnull,1\n7,null\n")
    assert dict(read_typed(spark, str(path), null_token="null").dtypes) == {"odd name": "int", "x.y": "int"}
    path.write_text("odd name,x.y\n")
    empty = read_typed(spark, str(path))
    assert dict(empty.dtypes) == {"odd name": "string", "x.y": "string"} and empty.isEmpty()

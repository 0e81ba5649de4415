"""Queries on reading, writing and shaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.functions.numeric import typed_square_udf, square
from tallyfold.functions.text import title_case
from tallyfold.operators import shape
from tallyfold.operators.compare import frame_diff
from tallyfold.session import scratch_path
from tallyfold.sources.catalog import (
    TEXT_OPTIONS,
    Catalog,
    DataLink,
    read_text_table,
    write_json_lines,
    write_parquet,
)
from tallyfold.sources.inference import read_typed
from tallyfold.sources.intake import read_checked
from tallyfold.workload.registry import query


def _orders_by_date(t):
    return t.orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


def _as_csv(t, frame, **options):
    path = scratch_path(t.spark, "csv")
    frame.write.options(header="true", sep=";", **options).csv(path)
    return path


@query("csv_strings", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders""")
def _(t):
    # A decimal price has one way to be written, unlike a double.
    price = F.col("o_totalprice").cast("decimal(18,2)")
    path = _as_csv(t, _orders_by_date(t).withColumn("o_totalprice", price))
    return read_text_table(t.spark, path, separator=";")


@query("csv_inferred", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
       o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders""")
def _(t):
    path = _as_csv(t, _orders_by_date(t))
    return read_text_table(t.spark, path, separator=";", infer_types=True)


@query("csv_null_token", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       NULLIF(o_orderstatus, 'F') AS o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders""")
def _(t):
    orders = _orders_by_date(t).withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("F")),
        "o_totalprice": F.col("o_totalprice").cast("decimal(18,2)")})
    path = _as_csv(t, orders, nullValue="null")
    return read_text_table(t.spark, path, separator=";", null_token="null")


@query("catalog_round_trip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""")
def _(t):
    catalog = Catalog(t.spark, {"customers": DataLink("parquet", scratch_path(t.spark, "catalog"))})
    catalog.save(t.customer, "customers", compression="gzip")
    return catalog.load("customers")


@query("catalog_text", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CAST(CAST(s_acctbal AS DECIMAL(18, 2)) AS VARCHAR) AS s_acctbal
FROM supplier""")
def _(t):
    link = DataLink("csv", scratch_path(t.spark, "catalog"), TEXT_OPTIONS)
    catalog = Catalog(t.spark, {"suppliers": link})
    catalog.save(t.supplier.withColumn("s_acctbal", F.col("s_acctbal").cast("decimal(18,2)")), "suppliers")
    return catalog.load("suppliers")


@query("parquet_file_count", "SELECT 3 AS files, count(*) AS n, count(DISTINCT o_orderkey) AS keys FROM orders")
def _(t):
    path = scratch_path(t.spark, "parquet")
    write_parquet(t.orders, path, files=3, sort_by=["o_orderdate"])
    written = t.spark.read.parquet(path).select("o_orderkey", F.input_file_name().alias("file"))
    return written.agg(
        F.countDistinct("file").cast("int").alias("files"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("o_orderkey").alias("keys"),
    )


@query("json_lines", """
SELECT o_orderkey, o_totalprice, NULLIF(o_orderstatus, 'F') AS o_orderstatus,
       CAST(o_orderdate AS DATE) AS o_orderdate
FROM orders""")
def _(t):
    path = scratch_path(t.spark, "json")
    orders = _orders_by_date(t).select(
        "o_orderkey", "o_totalprice",
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"), "o_orderdate",
    )
    write_json_lines(orders, path)
    return t.spark.read.schema(orders.schema).json(path)


@query("sql_view", """
SELECT o_orderstatus AS a, o_orderpriority AS b, o_orderstatus || o_orderpriority AS c FROM orders""")
def _(t):
    named = t.orders.select(F.col("o_orderstatus").alias("a"), F.col("o_orderpriority").alias("b"))
    return shape.query_as(named, "frame", "SELECT a, b, concat(a, b) AS c FROM frame")


@query("inline_rows", """
SELECT r.rank, r.weight, count(*) AS n
FROM orders JOIN (VALUES ('1-URGENT', 1, 1.5), ('2-HIGH', 2, 1.25), ('3-MEDIUM', 3, 1.0)) AS
     r(priority, rank, weight) ON o_orderpriority = r.priority
GROUP BY r.rank, r.weight""".replace("r.weight, count", "CAST(r.weight AS DOUBLE) AS weight, count"))
def _(t):
    explicit = T.StructType([T.StructField("o_orderpriority", T.StringType()),
                             T.StructField("rank", T.IntegerType())])
    ranks = t.spark.createDataFrame([("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3)], explicit)
    weights = t.spark.createDataFrame(
        [("1-URGENT", 1.5), ("2-HIGH", 1.25), ("3-MEDIUM", 1.0)], ["o_orderpriority", "weight"]
    )
    # Counting first leaves five rows to join.
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(ranks, "o_orderpriority").join(weights, "o_orderpriority").drop(
        "o_orderpriority"
    )


@query("id_range", """
SELECT id, id % 2 = 0 AS is_even, 'bar' AS foo
FROM (SELECT unnest(range(n)) AS id FROM (SELECT count(*) AS n FROM orders))""")
def _(t):
    ids = t.spark.range(t.orders.count())
    return ids.withColumns({"is_even": F.col("id") % 2 == 0, "foo": F.lit("bar")})


@query("select_and_add", "SELECT l_linenumber, l_linenumber + 10 AS foo FROM lineitem")
def _(t):
    return t.lineitem.select("l_linenumber").withColumn("foo", F.col("l_linenumber") + 10)


@query("keep_non_null", """
SELECT c_custkey, c_mktsegment FROM customer WHERE NULLIF(c_mktsegment, 'BUILDING') IS NOT NULL""")
def _(t):
    known = t.customer.select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment")
    )
    return known.where(F.col("c_mktsegment").isNotNull())


@query("drop_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem")
def _(t):
    return shape.drop_columns(t.lineitem, [
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        "_c44",
    ])


@query("rename_batch", """
SELECT c_custkey AS customer_id, c_name AS name, c_nationkey, c_acctbal AS balance, c_mktsegment
FROM customer""")
def _(t):
    return shape.rename_columns(t.customer, {
        "c_custkey": "customer_id", "c_name": "name", "c_acctbal": "balance", "absent": "x",
    })


@query("lowercase_names", "SELECT s_suppkey AS suppkey, s_name AS supplier_name FROM supplier")
def _(t):
    return shape.lowercase_names(t.supplier.select(
        F.col("s_suppkey").alias("SuppKey"), F.col("s_name").alias("SUPPLIER_NAME")
    ))


@query("cast_map", """
SELECT TRY_CAST(o_orderkey % 40000 * 3 AS SMALLINT) AS as_short,
       CAST(trunc(o_totalprice) AS INTEGER) AS as_int,
       o_orderkey AS as_long,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS as_date,
       CAST(o_orderkey % 100 AS TINYINT) AS as_byte,
       o_totalprice AS as_double
FROM orders""")
def _(t):
    text = t.derive("""
        SELECT CAST(o_orderkey % 40000 * 3 AS STRING) || '.00' AS as_short,
               CAST(o_totalprice AS STRING) AS as_int,
               CAST(o_orderkey AS STRING) || '.0' AS as_long,
               CASE WHEN o_orderkey % 5 = 0 THEN 'nope'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS as_date,
               CAST(o_orderkey % 100 AS STRING) AS as_byte,
               CAST(o_totalprice AS STRING) AS as_double
        FROM {orders}""", "orders")
    return shape.cast_columns(text, {
        T.ShortType(): ["as_short"], T.IntegerType(): ["as_int"], T.LongType(): ["as_long"],
        T.DateType(): ["as_date"], T.ByteType(): ["as_byte"], T.DoubleType(): ["as_double"],
    })


_GAPS = """
SELECT o_orderkey,
       NULLIF(o_orderstatus, 'F') AS status,
       NULLIF(o_orderpriority, '5-LOW') AS priority,
       CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS custkey,
       CASE WHEN o_custkey % 4 <> 0 THEN o_totalprice END AS price,
       CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey % 5 = 1 END AS chosen
FROM {orders}"""
_GAPS_SQL = _GAPS.format(orders="orders")


@query("null_count_filter", f"""
SELECT * FROM ({_GAPS_SQL})
WHERE CAST(status IS NULL AS INT) + CAST(priority IS NULL AS INT) + CAST(custkey IS NULL AS INT)
    + CAST(price IS NULL AS INT) + CAST(chosen IS NULL AS INT) < 2""")
def _(t):
    return shape.keep_rows_with_fewer_nulls(t.derive(_GAPS, "orders"), 2)


@query("fill_nulls", f"""
SELECT o_orderkey, coalesce(status, 'R') AS status, coalesce(priority, 'English') AS priority,
       custkey, coalesce(price, 653.813397) AS price, chosen
FROM ({_GAPS_SQL})""")
def _(t):
    return shape.fill_nulls(
        t.derive(_GAPS, "orders"), {"status": "R", "priority": "English", "price": 653.813397}
    )


@query("fill_false", f"SELECT o_orderkey, coalesce(chosen, false) AS chosen FROM ({_GAPS_SQL})")
def _(t):
    return shape.fill_false(t.derive(_GAPS, "orders").select("o_orderkey", "chosen"), "chosen")


@query("drop_rows_with_nulls", f"""
SELECT * FROM ({_GAPS_SQL})
WHERE status IS NOT NULL AND priority IS NOT NULL AND custkey IS NOT NULL AND price IS NOT NULL
  AND chosen IS NOT NULL""")
def _(t):
    return shape.drop_rows_with_nulls(t.derive(_GAPS, "orders"))


@query("letter_case", """
SELECT p_partkey, upper(p_name) AS upper_name,
       array_to_string(list_transform(string_split(p_name, ' '),
         lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title_name, lower(p_brand) AS lower_brand
FROM part""")
def _(t):
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("upper_name"),
        title_case(F.col("p_name")).alias("title_name"), F.lower("p_brand").alias("lower_brand"),
    )


@query("square", """
SELECT p_size, CAST(p_size AS DOUBLE) * p_size AS power, p_size * p_size AS product,
       p_retailprice * p_retailprice AS price_product
FROM part""")
def _(t):
    return t.part.select(
        "p_size", F.pow("p_size", F.lit(2)).alias("power"),
        square(F.col("p_size")).alias("product"),
        square(F.col("p_retailprice")).alias("price_product"),
    )


@query("udf_typed", """
SELECT p_size, p_size * p_size AS size_as_int, CAST(NULL AS FLOAT) AS size_as_float,
       CAST(NULL AS INTEGER) AS price_as_int,
       CAST(p_retailprice * p_retailprice AS FLOAT) AS price_as_float
FROM part""")
def _(t):
    as_int, as_float = typed_square_udf(T.IntegerType()), typed_square_udf(T.FloatType())
    return t.part.select(
        "p_size", as_int("p_size").alias("size_as_int"), as_float("p_size").alias("size_as_float"),
        as_int("p_retailprice").alias("price_as_int"),
        as_float("p_retailprice").alias("price_as_float"),
    )


@query("frame_diff", """
WITH changed AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_totalprice < 20000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
  FROM orders WHERE o_orderdate >= DATE '1995-02-01'
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 450000
), both_sides AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS l, 0 AS r FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 0, 1 FROM changed)
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(sum(l) AS BIGINT) AS left_rows,
       CAST(sum(r) AS BIGINT) AS right_rows
FROM both_sides GROUP BY ALL HAVING sum(l) <> sum(r)""")
def _(t):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    orders = t.orders.select(*columns)
    # A copy that lacks the first month, has some orders twice and another status for others.
    status = F.when(F.col("o_totalprice") < 20000, "X").otherwise(F.col("o_orderstatus"))
    kept = t.orders.where(F.col("o_orderdate") >= F.lit("1995-02-01").cast("date"))
    twice = t.orders.where("o_totalprice > 450000").select(*columns)
    changed = kept.withColumn("o_orderstatus", status).select(*columns).unionByName(twice)
    # Column order does not matter.
    return frame_diff(orders, changed.select(*reversed(columns)))


# Lines as files have them: some with a cell too few or too many, some with a quote that is never closed.
_ODD_LINES = """
SELECT c_custkey, c_name, c_mktsegment,
  CASE WHEN c_custkey % 13 = 3 THEN 'quote' WHEN c_custkey % 7 = 1 OR c_custkey % 11 = 2 THEN 'cells' END AS reason,
  CAST(c_custkey AS STRING) || ';' || c_name ||
    CASE WHEN c_custkey % 13 = 3 THEN ';"' || c_mktsegment WHEN c_custkey % 7 = 1 THEN ''
      WHEN c_custkey % 11 = 2 THEN ';' || c_mktsegment || ';more' ELSE ';' || c_mktsegment END AS line
FROM {customer}"""


@query("csv_quarantine", f"""
WITH lines AS ({_ODD_LINES.format(customer="customer")})
SELECT CASE WHEN reason IS NULL THEN CAST(c_custkey AS VARCHAR) END AS c_custkey,
       CASE WHEN reason IS NULL THEN c_name END AS c_name,
       CASE WHEN reason IS NULL THEN c_mktsegment END AS c_mktsegment,
       CASE WHEN reason IS NOT NULL THEN line END AS line, reason
FROM lines""")
def _(t):
    """Rows that fit the header, and next to them the lines that do not, with the reason."""
    path = scratch_path(t.spark, "odd-lines")
    lines = t.derive(_ODD_LINES, "customer").select(F.col("line").alias("c_custkey;c_name;c_mktsegment"))
    # One column without quotes, so each file is its header and the lines as they are.
    lines.write.options(header="true", quote="", sep="\u0001").csv(path)
    rows, quarantine = read_checked(t.spark, path, separator=";")
    return rows.unionByName(quarantine, allowMissingColumns=True)


# Columns whose cells are all of one kind, of two kinds with a wider type in common, of two without, and of none.
_MIXED_CELLS = """
SELECT o_orderkey, o_custkey * 10000000000 AS wide, o_orderkey % 2 = 0 AS even, CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderkey % 3 = 0 THEN '2.5' ELSE CAST(o_orderkey % 3 AS STRING) END AS some_fractions,
       CASE WHEN o_orderkey % 4 = 0 THEN 'none' ELSE CAST(o_orderkey AS STRING) END AS some_words,
       CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 5 AS STRING) END AS some_gaps,
       CAST(NULL AS STRING) AS gaps
FROM {orders}"""


@query("csv_types_one_pass", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS BIGINT) * 10000000000 AS wide,
       o_orderkey % 2 = 0 AS even, CAST(o_orderdate AS DATE) AS day,
       CASE WHEN o_orderkey % 3 = 0 THEN 2.5 ELSE o_orderkey % 3 END::DOUBLE AS some_fractions,
       CASE WHEN o_orderkey % 4 = 0 THEN 'none' ELSE CAST(o_orderkey AS VARCHAR) END AS some_words,
       CAST(NULLIF(o_orderkey % 5, 0) AS INTEGER) AS some_gaps, CAST(NULL AS VARCHAR) AS gaps
FROM orders""")
def _(t):
    """Types found while the text is read, instead of by a reading of their own."""
    return read_typed(t.spark, _as_csv(t, t.derive(_MIXED_CELLS, "orders")), separator=";")

"""Queries on joins: by key, by validity date, by overlapping ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.operators.joins import (
    attach_dimension,
    estimated_bytes,
    keyed_join,
    valid_at_join,
)
from tallyfold.operators.overlap import overlap_join
from tallyfold.plans.dimensions import clean_carriers
from tallyfold.plans.offices import offices_with_reigns
from tallyfold.session import scratch_path
from tallyfold.sources.catalog import Buckets, Catalog, DataLink, buckets_for
from tallyfold.workload import raw
from tallyfold.workload.cleaning import CLEAN_CARRIERS_SQL
from tallyfold.workload.registry import query

# Periods to hold orders against: closed, one day long, open at the end, and a gap.
_ERAS = """(VALUES
  ('first', DATE '1995-01-01', DATE '1996-06-30'), ('one day', DATE '1996-01-01', DATE '1996-01-01'),
  ('second', DATE '1997-03-01', DATE '1999-12-31'), ('open', DATE '2000-06-01', CAST(NULL AS DATE)))"""
_SPANS = """
SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship,
       CASE WHEN max(l_quantity) < 50 THEN CAST(max(l_shipdate) AS DATE) END AS last_ship
FROM {lineitem} GROUP BY l_orderkey"""


def _overlap(a, b, c, d):
    return f"NOT (coalesce({a} > {d}, false) OR coalesce({b} < {c}, false))"


@query("overlap_join", f"""
SELECT l_orderkey, first_ship, last_ship, era, era_start, era_stop
FROM ({_SPANS.format(lineitem="lineitem")}) LEFT JOIN {_ERAS} AS e(era, era_start, era_stop)
  ON {_overlap("first_ship", "last_ship", "era_start", "era_stop")}""")
def _(t):
    spans = t.derive(_SPANS, "lineitem")
    eras = t.spark.sql(f"SELECT * FROM {_ERAS} AS e(era, era_start, era_stop)")
    return overlap_join(spans, eras, ("first_ship", "last_ship"), ("era_start", "era_stop"), "left")


_TERMS = """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Sir' END AS title,
       CAST(DATE '1951-10-26' + CAST(c_custkey * 97 % 24000 AS INT) AS STRING) AS entered_office_on,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN
         CAST(DATE '1951-10-26' + CAST(c_custkey * 97 % 24000 + c_custkey % 3000 AS INT) AS STRING) END
         AS left_office_on
FROM {customer}"""
_REIGNS = "(VALUES ('second', 1952, NULL), ('sixth', 1936, 1952), ('eighth', 1936, 1936))"


@query("offices_with_reigns", f"""
SELECT c_custkey, title, entered_office_on, left_office_on, monarch,
       start AS "reign start", stop AS "reign stop"
FROM ({_TERMS.format(customer="customer")}) LEFT JOIN {_REIGNS} AS r(monarch, start, stop)
  ON {_overlap("year(CAST(entered_office_on AS DATE))", "year(CAST(left_office_on AS DATE))", "start", "stop")}""")
def _(t):
    reigns = t.spark.sql(f"SELECT * FROM {_REIGNS} AS r(`monarch`, `reign start`, `reign stop`)")
    return offices_with_reigns(t.derive(_TERMS, "customer"), reigns)


# Short delivery windows of orders against campaigns for one customer each, some of them open.
_WINDOWS = """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS ordered,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS due
FROM {orders}"""
_CAMPAIGNS = """
SELECT s_suppkey, CASE WHEN s_nationkey <> 7 THEN DATE '1995-01-01' + CAST(s_suppkey * 97 % 2500 AS INT) END AS began,
       CASE WHEN s_nationkey <> 3 THEN
         DATE '1995-01-01' + CAST(s_suppkey * 97 % 2500 + s_suppkey % 30 AS INT) END AS ended
FROM {supplier}"""
_CAMPAIGN_SQL = f"""
SELECT o_orderkey, o_custkey, ordered, due, s_suppkey, began, ended
FROM ({_WINDOWS.format(orders="orders")}) {{how}} JOIN ({_CAMPAIGNS.format(supplier="supplier")})
  ON o_custkey = s_suppkey AND {_overlap("ordered", "due", "began", "ended")}"""


def _campaigns(t, **options):
    return overlap_join(
        t.derive(_WINDOWS, "orders"), t.derive(_CAMPAIGNS, "supplier"),
        ("ordered", "due"), ("began", "ended"), by=[("o_custkey", "s_suppkey")], **options,
    )


@query("overlap_join_tree", _CAMPAIGN_SQL.format(how="INNER"))
def _(t):
    return _campaigns(t, strategy="tree")


@query("overlap_join_shuffled", _CAMPAIGN_SQL.format(how="LEFT"))
def _(t):
    return _campaigns(t, how="left", strategy="tree")


@query("inner_join", """
SELECT o_orderkey, o_custkey AS custkey, c_name, c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def _(t):
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("custkey"))
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), "c_name", "c_mktsegment")
    return keyed_join(orders, customers, ["custkey"])


@query("inner_join_null_safe", """
WITH o AS (SELECT o_orderkey, NULLIF(o_orderpriority, '5-LOW') AS priority FROM orders),
r AS (SELECT NULLIF(o_orderpriority, '5-LOW') AS priority, count(*) AS n FROM orders GROUP BY 1)
SELECT o_orderkey, o.priority, n FROM o JOIN r ON o.priority IS NOT DISTINCT FROM r.priority""")
def _(t):
    priority = F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority")
    orders = t.orders.select("o_orderkey", priority)
    counts = t.orders.select(priority).groupBy("priority").agg(F.count(F.lit(1)).alias("n"))
    return keyed_join(orders, counts, ["priority"], null_safe=True)


@query("left_join_hot_keys", """
SELECT l_linenumber, l_returnflag, l_quantity, n
FROM lineitem LEFT JOIN (SELECT l_returnflag AS flag, count(*) AS n FROM lineitem
  WHERE l_returnflag <> 'R' GROUP BY 1) ON l_returnflag = flag""")
def _(t):
    # Three keys for all rows.
    counts = t.lineitem.where("l_returnflag <> 'R'").groupBy("l_returnflag")
    lines = t.lineitem.select("l_linenumber", "l_returnflag", "l_quantity")
    return keyed_join(lines, counts.agg(F.count(F.lit(1)).alias("n")), ["l_returnflag"], "left")


@query("star_view", """
SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, c_name AS customer, s_name AS supplier,
       p_name AS part, n1.n_name AS origin, n2.n_name AS destination
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN nation n1 ON s_nationkey = n1.n_nationkey LEFT JOIN nation n2 ON c_nationkey = n2.n_nationkey""")
def _(t):
    # The keys of these tables are unique. Dimensions of dimensions first: what is joined to the lines is then joined once,
    # and customers meet orders, not the many lines of each order.
    customers = attach_dimension(t.customer, t.nation, "c_nationkey", "n_nationkey",
                                 {"n_name": "destination"}, check=False)
    suppliers = attach_dimension(t.supplier, t.nation, "s_nationkey", "n_nationkey",
                                 {"n_name": "origin"}, check=False)
    # Attaching keeps the number of rows, and two names about double a row's width.
    orders = attach_dimension(t.orders, customers, "o_custkey", "c_custkey",
                              {"c_name": "customer", "destination": "destination"},
                              dimension_bytes=2 * estimated_bytes(t.customer), check=False)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    view = attach_dimension(lines, orders, "l_orderkey", "o_orderkey", {
        c: c for c in ("o_orderdate", "customer", "destination")
    }, dimension_bytes=2 * estimated_bytes(t.orders), check=False)
    view = attach_dimension(view, suppliers, "l_suppkey", "s_suppkey",
                            {"s_name": "supplier", "origin": "origin"}, check=False)
    view = attach_dimension(view, t.part, "l_partkey", "p_partkey", {"p_name": "part"}, check=False)
    return view.drop("l_partkey", "l_suppkey")


@query("star_view_bucketed", """
SELECT l_orderkey, l_linenumber, l_quantity, o_orderdate, o_orderpriority, s_name AS supplier
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def _(t):
    """Lines and orders saved in buckets of the order's key, then joined where they lie."""
    buckets = max(32, buckets_for(max(estimated_bytes(t.lineitem), estimated_bytes(t.orders))))
    folder = scratch_path(t.spark, "buckets")
    catalog = Catalog(t.spark, {
        "lines": DataLink("parquet", f"{folder}/lines", {}, Buckets(buckets, ("l_orderkey",))),
        "orders": DataLink("parquet", f"{folder}/orders", {}, Buckets(buckets, ("o_orderkey",))),
    })
    catalog.save(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey"), "lines")
    catalog.save(t.orders.select("o_orderkey", "o_orderdate", "o_orderpriority"), "orders")
    view = attach_dimension(catalog.load("lines"), catalog.load("orders"), "l_orderkey", "o_orderkey",
                            {c: c for c in ("o_orderdate", "o_orderpriority")}, broadcast_bytes=0, check=False)
    return attach_dimension(view, t.supplier, "l_suppkey", "s_suppkey", {"s_name": "supplier"}, check=False).drop("l_suppkey")


_VALID_AT_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, ship_code, CAST(l_shipdate AS DATE) AS day, CARRIER_NAME AS carrier_name
FROM (SELECT *, 'C' || CAST(l_suppkey % 21 AS STRING) AS ship_code FROM lineitem)
LEFT JOIN ({CLEAN_CARRIERS_SQL}) ON ship_code = CARRIER AND l_shipdate >= START_DATE_SOURCE
  AND (THRU_DATE_SOURCE IS NULL OR l_shipdate <= THRU_DATE_SOURCE)"""


def _valid_at(t):
    code = F.concat(F.lit("C"), (F.col("l_suppkey") % 21).cast("string"))
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", code.alias("ship_code"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    return valid_at_join(
        lines, clean_carriers(raw.carriers(t)), "ship_code", "day", "CARRIER",
        "START_DATE_SOURCE", "THRU_DATE_SOURCE", {"CARRIER_NAME": "carrier_name"},
    )


@query("valid_at_join", _VALID_AT_SQL)
def _(t):
    return _valid_at(t)


# Two prices for each part; the later one is valid to the usual far-off date.
_PART_HISTORY = """
SELECT p_partkey, CAST(NULL AS DATE) AS valid_from, DATE '1998-01-01' + CAST(p_partkey % 900 AS INT) AS valid_to,
       p_retailprice AS price FROM {part}
UNION ALL SELECT p_partkey, DATE '1998-01-02' + CAST(p_partkey % 900 AS INT), DATE '9999-12-31', p_retailprice * 2 FROM {part}"""


@query("valid_at_join_shuffled", f"""
SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS day, price
FROM lineitem LEFT JOIN ({_PART_HISTORY.format(part="part")}) ON l_partkey = p_partkey
  AND (valid_from IS NULL OR CAST(l_shipdate AS DATE) >= valid_from) AND CAST(l_shipdate AS DATE) <= valid_to""")
def _(t):
    # The parts as a dimension with a history each, joined on part and ship date.
    history = t.derive(_PART_HISTORY, "part")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    return valid_at_join(lines, history, "l_partkey", "day", "p_partkey", "valid_from", "valid_to", {"price": "price"})

"""Queries on totals, frequencies, profiles, and the reports on the flights view."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyfold.operators import aggregates
from tallyfold.plans import jobs, reports
from tallyfold.plans.dimensions import clean_airports, clean_carriers
from tallyfold.plans.flights import CLEAN_NAMES, CLOCK_COLUMNS, clean_flights
from tallyfold.session import scratch_path
from tallyfold.sources.catalog import Catalog, flight_catalog, quality_catalog
from tallyfold.workload import raw
from tallyfold.workload.cleaning import (
    CLEAN_AIRPORTS_SQL,
    CLEAN_CARRIERS_SQL,
    CLEAN_FLIGHTS_SQL,
)
from tallyfold.workload.registry import local, query


@query("group_sum", """
SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderkey % 10 <> 3 THEN o_custkey + 0.25 END) AS DOUBLE) AS total
FROM orders GROUP BY 1""")
def _(t):
    # The summed column is text, as it would be in a file read without types: fractions,
    # blanks around numbers, and cells that are none.
    text = t.orders.selectExpr("o_orderpriority", """
        CASE o_orderkey % 10 WHEN 3 THEN 'unknown' WHEN 4 THEN concat(' ', o_custkey, '.25 ')
        ELSE concat(o_custkey, '.25') END AS terms""")
    return aggregates.group_sum(text, ["o_orderpriority"], "terms", "total")


@query("group_count", "SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def _(t):
    return aggregates.group_count(t.events, ["event_type"])


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def _(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query("describe", """
WITH p AS (SELECT count(o_totalprice) AS n, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s,
  min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_orderpriority) AS plo, max(o_orderpriority) AS phi
  FROM orders)
SELECT 'count' AS summary, CAST(n AS DOUBLE) AS o_totalprice, CAST(n AS VARCHAR) AS o_orderpriority FROM p
UNION ALL SELECT 'mean', round(m, 4), NULL FROM p UNION ALL SELECT 'stddev', round(s, 4), NULL FROM p
UNION ALL SELECT 'min', lo, plo FROM p UNION ALL SELECT 'max', hi, phi FROM p""")
def _(t):
    described = aggregates.describe_columns(t.orders, ["o_totalprice", "o_orderpriority"])
    return described.withColumn("o_totalprice", F.round(F.col("o_totalprice").cast("double"), 4))


@query("distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


@query("one_row_per_key", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity) AS r
  FROM lineitem) WHERE r = 1""")
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return aggregates.one_row_per_key(lines, ["l_orderkey"])


@query("most_frequent", """
SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def _(t):
    return aggregates.most_frequent(t.orders, "o_custkey", 20)


@query("sorted_nulls_first", "SELECT o_orderkey, NULLIF(o_orderstatus, 'F') AS status FROM orders")
def _(t):
    orders = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).alias("status"))
    # The key behind it spreads the few statuses over all tasks.
    return orders.orderBy(F.col("status").asc_nulls_first(), "o_orderkey")


@query("sorted_by_several", "SELECT o_orderpriority, o_custkey, o_orderkey FROM orders")
def _(t):
    return t.orders.select("o_orderpriority", "o_custkey", "o_orderkey").orderBy(
        "o_orderpriority", "o_custkey", "o_orderkey"
    )


_CELLS = """
SELECT CAST(o_orderkey AS STRING) AS key,
       CASE WHEN o_orderstatus = 'F' THEN NULL WHEN o_orderpriority = '5-LOW' THEN 'n/a'
         ELSE CAST(o_custkey AS STRING) END AS customer,
       CASE WHEN o_orderstatus = 'P' THEN 'someday' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day
FROM {orders}"""


@query("column_profile", f"""
WITH c AS ({_CELLS.format(orders="orders")})
SELECT 'key' AS "column", count(*) AS rows, count(*) - count(key) AS missing, CAST(0 AS BIGINT) AS uncastable,
       CAST(0 AS BIGINT) AS unknown FROM c
UNION ALL SELECT 'customer', count(*), count(*) - count(customer),
  count(*) FILTER (customer IS NOT NULL AND TRY_CAST(customer AS INTEGER) IS NULL),
  count(*) FILTER (customer = 'n/a') FROM c
UNION ALL SELECT 'day', count(*), count(*) - count(day),
  count(*) FILTER (day IS NOT NULL AND TRY_CAST(day AS DATE) IS NULL), 0 FROM c""")
def _(t):
    return aggregates.column_profile(
        t.derive(_CELLS, "orders"),
        {"key": T.LongType(), "customer": T.IntegerType(), "day": T.DateType()},
        {"customer": ["n/a", "?"]},
    )


@query("schema_profile", " UNION ALL ".join(f"""
SELECT {i} AS position, '{name}' AS "column", '{kind}' AS type, true AS nullable, count(*) AS rows,
       count(*) - count({name}) AS missing FROM customer"""
    for i, (name, kind) in enumerate([
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
        ("c_acctbal", "double"), ("c_mktsegment", "string"),
    ])))
def _(t):
    figures = aggregates.column_profile(t.customer).select("column", "rows", "missing")
    return aggregates.schema_profile(t.customer).join(figures, "column")


# ---------------------------------------------------------------- reports on flights

_WITH_CARRIERS_SQL = f"""
SELECT f.*, c.CARRIER_NAME AS carrier_name
FROM ({CLEAN_FLIGHTS_SQL}) f LEFT JOIN ({CLEAN_CARRIERS_SQL}) c
  ON unique_carrier = CARRIER AND flight_date >= START_DATE_SOURCE
  AND (THRU_DATE_SOURCE IS NULL OR flight_date <= THRU_DATE_SOURCE)"""
_CARRIER, _YEAR = "Carrier 7 late", 1999


def _cleaned(t):
    return clean_flights(raw.flights(t))


def _with_carriers(t):
    # The airports add nothing to a count per carrier, so they are not joined for it.
    return reports.with_carriers(_cleaned(t), clean_carriers(raw.carriers(t)))


def master(t):
    return reports.master_flights(
        _cleaned(t), clean_carriers(raw.carriers(t)), clean_airports(raw.airports(t))
    )


_MASTER_SQL = f"""
SELECT w.*, o.DISPLAY_AIRPORT_NAME AS origin_airport_name, d.DISPLAY_AIRPORT_NAME AS dest_airport_name
FROM ({_WITH_CARRIERS_SQL}) w LEFT JOIN ({CLEAN_AIRPORTS_SQL}) o ON origin = o.AIRPORT
LEFT JOIN ({CLEAN_AIRPORTS_SQL}) d ON dest = d.AIRPORT"""


def _shown(view):
    return view.withColumns({c: local(c) for c in (CLEAN_NAMES[raw] for raw in CLOCK_COLUMNS)})


@query("master_flights", _MASTER_SQL)
def _(t):
    return _shown(master(t))


# The raw text is by far the largest table of the job. Compressed text cannot be split, so its files are kept small.
_TEXT = {"compression": "gzip", "zlib.compress.level": "THREE", "maxRecordsPerFile": 1_000_000}


@query("flight_jobs", _MASTER_SQL)
def _(t):
    # From text files to the saved view, as a user would run it.
    folder = scratch_path(t.spark, "flight-jobs")
    catalog = Catalog(t.spark, flight_catalog(f"{folder}/raw", f"{folder}/clean") | quality_catalog(f"{folder}/clean"))
    for name, table in (("flights", raw.flights(t)), ("airports", raw.airports(t)), ("carriers", raw.carriers(t))):
        catalog.save(table, f"raw_{name}", **_TEXT)
    jobs.clean_flight_tables(catalog)
    jobs.build_master_flights(catalog)
    return _shown(catalog.load("master_flights"))


_CHOSEN = f"carrier_name = '{_CARRIER}' AND year(flight_date) = {_YEAR}"


@query("report_volume", f"SELECT count(*) AS flights FROM ({_WITH_CARRIERS_SQL}) WHERE {_CHOSEN}")
def _(t):
    return reports.flights_operated_by(_with_carriers(t), _CARRIER, _YEAR)


@query("report_on_time", f"""
SELECT count(*) AS flights FROM ({_WITH_CARRIERS_SQL}) WHERE {_CHOSEN} AND arr_delay <= 10""")
def _(t):
    return reports.flights_on_time(_with_carriers(t), _CARRIER, _YEAR, 10)


@query("report_weekday_share", f"""
WITH s AS (SELECT CAST(dayofweek(flight_date) + 1 AS INTEGER) AS weekday, count(*) AS departures,
  count(*) FILTER (dep_delay > 0) AS delayed FROM ({CLEAN_FLIGHTS_SQL})
  WHERE dep_delay IS NOT NULL AND flight_date IS NOT NULL GROUP BY 1)
SELECT weekday, departures, delayed, delayed / departures AS share,
       delayed / departures = max(delayed / departures) OVER () AS is_highest FROM s""")
def _(t):
    return reports.delayed_share_by_weekday(_cleaned(t))


@query("report_delay_causes", f"WITH f AS (SELECT * FROM ({CLEAN_FLIGHTS_SQL}) WHERE year(flight_date) = {_YEAR})"
       + " UNION ALL ".join(f"""
SELECT '{c}' AS cause, count(*) FILTER ({c} > 0) AS flights,
       CAST(coalesce(sum({c}) FILTER ({c} > 0), 0) AS BIGINT) AS minutes FROM f"""
                            for c in reports.CAUSE_COLUMNS))
def _(t):
    return reports.delay_causes(_cleaned(t), _YEAR)


@query("report_top_cause", f"WITH f AS (SELECT * FROM ({CLEAN_FLIGHTS_SQL}) WHERE year(flight_date) = {_YEAR}), c AS ("
       + " UNION ALL ".join(f"""
SELECT '{c}' AS cause, count(*) FILTER ({c} > 0) AS flights,
       CAST(coalesce(sum({c}) FILTER ({c} > 0), 0) AS BIGINT) AS minutes FROM f"""
                            for c in reports.CAUSE_COLUMNS)
       + ") SELECT * FROM c ORDER BY flights DESC, cause LIMIT 1")
def _(t):
    return reports.top_delay_cause(_cleaned(t), _YEAR)

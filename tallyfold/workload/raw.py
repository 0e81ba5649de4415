"""All-text raw tables, made from the driver's tables by SQL that both engines read alike.

They have what raw files have: padded and unpadded clock times, 2400, decimal text for
whole numbers, cells that are missing or make no sense, and exact copies of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyfold.workload.registry import Tables

_T = "CAST(NULL AS STRING)"


def _minutes(number: str, present: str) -> str:
    return f"CASE WHEN {present} THEN CAST({number} AS STRING) || '.00' END"


_FLOWN = "k % 40 <> 0"
_LATE = "k % 40 <> 0 AND k * 19 % 240 - 40 >= 15"

FLIGHTS = f"""
SELECT
  CAST(year(d) AS STRING) AS YEAR,
  CAST(month(d) AS STRING) AS MONTH,
  CAST(dayofmonth(d) AS STRING) AS DAY_OF_MONTH,
  '1' AS DAY_OF_WEEK,
  CASE WHEN k % 211 = 0 THEN 'unknown' ELSE CAST(d AS STRING) END AS FL_DATE,
  'C' || CAST(l_suppkey % 21 AS STRING) AS UNIQUE_CARRIER,
  CASE WHEN k % 31 <> 0 THEN 'N' || CAST(l_partkey AS STRING) END AS TAIL_NUM,
  CAST(k % 8880 + 1 AS STRING) AS FL_NUM,
  CAST(10135 + l_partkey % 6000 AS STRING) AS ORIGIN_AIRPORT_ID,
  'A' || CAST(l_partkey % 50 AS STRING) AS ORIGIN,
  'S' || CAST(l_partkey % 9 AS STRING) AS ORIGIN_STATE_ABR,
  CAST(10135 + k % 6000 AS STRING) AS DEST_AIRPORT_ID,
  'A' || CAST(k % 52 AS STRING) AS DEST,
  'S' || CAST(k % 9 AS STRING) AS DEST_STATE_ABR,
  lpad(CAST(k * 37 % 24 * 100 + k * 11 % 60 AS STRING), 4, '0') AS CRS_DEP_TIME,
  CASE WHEN {_FLOWN} THEN CAST(k * 53 % 2500 AS STRING) END AS DEP_TIME,
  {_minutes("k * 13 % 200 - 30", _FLOWN)} AS DEP_DELAY,
  {_minutes("k * 13 % 200", _FLOWN)} AS DEP_DELAY_NEW,
  {_minutes("k % 2", _FLOWN)} AS DEP_DEL15,
  {_minutes("k % 14 - 2", _FLOWN)} AS DEP_DELAY_GROUP,
  {_minutes("k % 173 + 1", _FLOWN)} AS TAXI_OUT,
  CASE WHEN {_FLOWN} THEN lpad(CAST(k * 59 % 2401 AS STRING), 4, '0') END AS WHEELS_OFF,
  CASE WHEN {_FLOWN} THEN lpad(CAST(k * 61 % 2401 AS STRING), 4, '0') END AS WHEELS_ON,
  {_minutes("k % 161 + 1", _FLOWN)} AS TAXI_IN,
  CASE WHEN k % 50 = 1 THEN '2400' ELSE CAST(k * 17 % 24 * 100 + k * 29 % 60 AS STRING) END
    AS CRS_ARR_TIME,
  CASE WHEN {_FLOWN} THEN CAST(k * 67 % 2500 AS STRING) END AS ARR_TIME,
  {_minutes("k * 19 % 240 - 40", _FLOWN)} AS ARR_DELAY,
  {_minutes("k * 19 % 240", _FLOWN)} AS ARR_DELAY_NEW,
  {_minutes("k % 2", _FLOWN)} AS ARR_DEL15,
  {_minutes("k % 14 - 2", _FLOWN)} AS ARR_DELAY_GROUP,
  CASE WHEN k % 40 = 0 THEN '1.0' WHEN k % 97 = 1 THEN 'n/a' ELSE '0.0' END AS CANCELLED,
  CASE WHEN k % 40 = 0 THEN 'B' END AS CANCELLATION_CODE,
  CASE WHEN k % 60 = 1 THEN '1.0' ELSE '0.0' END AS DIVERTED,
  {_minutes("k % 300 + 40", "true")} AS CRS_ELAPSED_TIME,
  {_minutes("k % 310 + 40", _FLOWN)} AS ACTUAL_ELAPSED_TIME,
  {_minutes("k % 280 + 20", _FLOWN)} AS AIR_TIME,
  '1.00' AS FLIGHTS,
  CASE WHEN k % 101 = 0 THEN '99999.00' WHEN k % 103 = 0 THEN 'far'
    ELSE CAST(k * 7 % 3000 AS STRING) || '.00' END AS DISTANCE,
  CAST(k % 11 + 1 AS STRING) AS DISTANCE_GROUP,
  {_minutes("k * 5 % 60", _LATE)} AS CARRIER_DELAY,
  {_minutes("k % 4 * 10", _LATE)} AS WEATHER_DELAY,
  {_minutes("k % 3 * 7", _LATE)} AS NAS_DELAY,
  {_minutes("k % 2 * 5", _LATE)} AS SECURITY_DELAY,
  {_minutes("k % 9 * 12", _LATE)} AS LATE_AIRCRAFT_DELAY,
  {_T} AS _c44
FROM (
  SELECT CAST(l_shipdate AS DATE) AS d, l_suppkey, l_partkey,
         l_orderkey * 7 + l_linenumber * 3 + l_partkey AS k
  FROM {{lineitem}}
)
"""

AIRPORTS = f"""
SELECT 'A' || CAST(p_partkey % 50 AS STRING) AS AIRPORT,
       p_name || ' ' || p_brand AS DISPLAY_AIRPORT_NAME,
       {_T} AS _c2
FROM {{part}}
"""


def _carriers(era: str, start: str, thru: str) -> str:
    return f"""
SELECT 'C' || CAST(s_suppkey % 20 AS STRING) AS CARRIER,
       'Carrier ' || CAST(s_suppkey % 20 AS STRING) || ' {era}' AS CARRIER_NAME,
       {start} AS START_DATE_SOURCE, {thru} AS THRU_DATE_SOURCE, {_T} AS _c4
FROM {{supplier}}
"""


# Carrier 9 has a gap between its two names; flights also name a carrier 20, not in the table.
CARRIERS = (
    _carriers("early", "'1990-01-01'", "'1998-06-30'")
    + "UNION ALL"
    + _carriers(
        "late",
        "CASE WHEN s_suppkey % 20 = 9 THEN '1999-01-01' ELSE '1998-07-01' END",
        _T,
    )
)

STATIONS = """
SELECT
  CAST(c_custkey AS STRING) AS number,
  CAST(c_custkey % 40 AS STRING) AS stands,
  CAST(c_custkey % 17 AS STRING) AS free_stands,
  CASE WHEN c_custkey % 19 = 0 THEN 'none' ELSE CAST(c_custkey % 23 AS STRING) END AS bikes,
  CASE WHEN c_custkey % 3 = 0 THEN 'True' WHEN c_custkey % 3 = 1 THEN ' false' ELSE 'maybe' END
    AS banking,
  CASE WHEN c_custkey % 5 = 0 THEN 'TRUE ' WHEN c_custkey % 5 < 4 THEN 'False' END AS bonus,
  CASE WHEN c_custkey % 7 = 0 THEN 'CLOSED' ELSE 'open' END AS status,
  CASE WHEN c_custkey % 29 = 0 THEN 'yesterday' ELSE
    '2024-03-' || lpad(CAST(c_custkey % 28 + 1 AS STRING), 2, '0')
    || 'T' || lpad(CAST(c_custkey % 24 AS STRING), 2, '0')
    || ':' || lpad(CAST(c_custkey % 60 AS STRING), 2, '0') || ':07+02:00' END AS updated,
  CASE WHEN c_custkey % 37 = 0 THEN '50.85' WHEN c_custkey % 41 = 0 THEN 'here,4.35' ELSE
    '50.' || lpad(CAST(c_custkey * 7919 % 10000 AS STRING), 4, '0')
    || ',4.' || lpad(CAST(c_custkey * 104729 % 10000 AS STRING), 4, '0') END AS position
FROM {customer}
"""
STATION_NAMES = {
    "stands": "Bike Stands",
    "free_stands": "Available Bike Stands",
    "bikes": "Available Bikes",
    "updated": "Last Update",
}

_MOVIE = """
SELECT
  p_name || ' ' || CAST(p_partkey AS STRING) AS movie_title,
  CASE WHEN p_partkey % 12 < 5 THEN 'R' WHEN p_partkey % 12 < 8 THEN 'PG-13'
    WHEN p_partkey % 12 < 10 THEN 'PG' WHEN p_partkey % 12 = 10 THEN 'G' END AS content_rating,
  CASE WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN 'French' ELSE 'English' END
    AS language,
  CASE WHEN p_partkey % 9 < 4 THEN 'USA' WHEN p_partkey % 9 < 6 THEN 'UK'
    WHEN p_partkey % 9 = 6 THEN 'Germany' WHEN p_partkey % 9 = 7 THEN 'Japan' END AS country,
  CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE p_type
    || CASE WHEN p_size % 2 = 0 THEN '|Drama' ELSE '' END
    || CASE WHEN p_size % 5 = 0 THEN '|Western' ELSE '' END END AS genres,
  CASE WHEN p_partkey % 14 <> 3 THEN CAST(p_size + 70 AS STRING) END AS duration,
  CASE WHEN p_partkey % 15 <> 4 THEN CAST(p_partkey * 31 % 5000 AS STRING) || '.5' END AS budget,
  'D' || CAST(p_partkey % 90 AS STRING) AS director_name,
  'X' || CAST(p_partkey % 80 AS STRING) AS actor_1_name,
  'Y' || CAST(p_partkey % 70 AS STRING) AS actor_2_name,
  CASE WHEN p_partkey % 16 <> 0 THEN 'Z' || CAST(p_partkey % 60 AS STRING) END AS actor_3_name,
  CASE WHEN p_partkey % 21 <> 0 THEN CAST(p_partkey * 17 % 900 AS STRING) END
    AS director_facebook_likes,
  CASE WHEN p_partkey % 22 <> 0 THEN CAST(p_partkey * 19 % 1000 AS STRING) END
    AS actor_1_facebook_likes,
  CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_partkey * 23 % 800 AS STRING) END
    AS actor_2_facebook_likes,
  CASE WHEN p_partkey % 24 <> 0 THEN CAST(p_partkey * 29 % 700 AS STRING) END
    AS actor_3_facebook_likes,
  CASE WHEN p_partkey % 26 <> 0 THEN CAST(p_partkey * 41 % 2500 AS STRING) END
    AS cast_total_facebook_likes
FROM {part}
"""
# Some movies occur twice, some have no row after release.
MOVIES_BEFORE = f"{_MOVIE} UNION ALL {_MOVIE} WHERE p_size = 25"
MOVIES_AFTER = """
SELECT
  p_name || ' ' || CAST(p_partkey AS STRING) AS movie_title,
  CAST((p_size * 3 + p_partkey % 9) % 9 + 1 AS STRING) || '.' || CAST(p_partkey * 7 % 10 AS STRING)
    AS imdb_score,
  CAST(p_partkey % 300 AS STRING) AS num_critic_for_reviews,
  CASE WHEN p_partkey % 6 <> 0 THEN CAST(p_partkey * 997 % 100000 AS STRING) END AS gross,
  CAST(p_partkey * 7 % 40000 AS STRING) AS num_voted_users,
  CAST(p_partkey % 450 AS STRING) AS num_user_for_reviews,
  CAST(p_partkey % 1000 AS STRING) AS movie_facebook_likes
FROM {part}
WHERE p_size <> 9
"""

# Clock cells next to an event: valid, 2400, past it, too long, not a number, missing.
CLOCKS = """
SELECT event_id, CAST(ts AS DATE) AS day,
  CASE WHEN event_id % 97 = 0 THEN 'ab' WHEN event_id % 89 = 0 THEN NULL
    WHEN event_id % 83 = 0 THEN '12345' WHEN event_id % 13 = 0 THEN '2400'
    WHEN event_id % 79 = 0 THEN '3610'
    ELSE CAST(event_id * 37 % 2460 AS STRING) END AS hhmm,
  CAST(event_id * 11 % 24 * 100 + event_id * 7 % 60 AS STRING) AS planned
FROM {events}
"""


def flights(t: Tables) -> DataFrame:
    return t.derive(FLIGHTS, "lineitem")


def airports(t: Tables) -> DataFrame:
    return t.derive(AIRPORTS, "part")


def carriers(t: Tables) -> DataFrame:
    return t.derive(CARRIERS, "supplier")


def stations(t: Tables) -> DataFrame:
    return t.derive(STATIONS, "customer").withColumnsRenamed(STATION_NAMES)


def movies(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.derive(MOVIES_BEFORE, "part"), t.derive(MOVIES_AFTER, "part")


def clocks(t: Tables) -> DataFrame:
    return t.derive(CLOCKS, "events")


def plain(text: str) -> str:
    """The SQL text with table names filled in, for the SQL side."""
    names = ("lineitem", "part", "supplier", "customer", "events", "orders")
    return text.format(**{name: name for name in names})

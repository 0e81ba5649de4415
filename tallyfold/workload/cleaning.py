"""Queries on text, clock times, calendar labels and the cleaning jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import clock
from tallyfold.functions.ranges import ranges_overlap
from tallyfold.functions.text import instant_of, split_coordinates
from tallyfold.functions.truth import kleene, to_bool, to_bool_normalised
from tallyfold.operators.labels import (
    holiday_calendar_of,
    label_holidays,
    label_weekend,
)
from tallyfold.plans.dimensions import clean_airports, clean_carriers
from tallyfold.plans.flights import (
    CLOCK_COLUMNS,
    CLEAN_NAMES,
    LONGHAND_OVERFLOWING_TIMES,
    LONGHAND_STRICT_TIMES,
    clean_flights,
    clean_flights_longhand,
)
from tallyfold.plans.stations import clean_stations
from tallyfold.plans import flights as flight_plans
from tallyfold.session import materialise
from tallyfold.sources.intake import Quality
from tallyfold.workload import raw
from tallyfold.workload.registry import local, query, utc

# ---------------------------------------------------------------- SQL building blocks


def sql_int(column: str, width: str = "SMALLINT") -> str:
    return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS {width})"


def sql_number(text: str) -> str:
    return f"CASE WHEN regexp_full_match({text}, '[0-9]{{1,4}}') THEN CAST({text} AS INTEGER) END"


def sql_clock(day: str, number: str) -> str:
    return (f"CASE WHEN {number} BETWEEN 0 AND 2359 AND {number} % 100 < 60 THEN "
            f"CAST({day} AS TIMESTAMP) + ({number} // 100 * 60 + {number} % 100) * INTERVAL 1 MINUTE END")


def sql_clock_2400(day: str, number: str) -> str:
    return (f"CASE WHEN {number} = 2400 THEN CAST({day} AS TIMESTAMP) + INTERVAL 1 DAY "
            f"ELSE {sql_clock(day, number)} END")


def sql_elapsed(day: str, number: str) -> str:
    return (f"CAST({day} AS TIMESTAMP) + ({number} // 100 * 60 + {number} % 100) * INTERVAL 1 MINUTE")


def sql_flag(column: str) -> str:
    return f"CASE WHEN {column} = '1.0' THEN true WHEN {column} = '0.0' THEN false END"


def sql_calendar(years: str) -> str:
    """CTEs that end in `holidays(day)`, for a query giving `year`."""
    return f"""
years AS ({years}),
e1 AS (SELECT year, year % 19 AS a, year // 100 AS b, year % 100 AS c FROM years),
e2 AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114 AS n FROM e3),
easter AS (SELECT year, make_date(year, n // 31, n % 31 + 1) AS sunday FROM e4),
holidays AS (
  SELECT sunday + CAST(unnest([0, 1, 39, 49, 50]) AS INTEGER) AS day FROM easter
  UNION
  SELECT make_date(year, md // 100, md % 100)
  FROM (SELECT year, unnest([101, 501, 721, 815, 1101, 1111, 1225]) AS md FROM easter)
)"""


_ORDER_YEARS = "SELECT DISTINCT year(o_orderdate) AS year FROM orders"
_CLOCKS = raw.plain(raw.CLOCKS)

# ---------------------------------------------------------------- dates and calendar


@query("date_and_year", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS d,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(year(o_orderdate) AS INTEGER) END AS y
FROM orders""")
def _(t):
    text = t.derive("""
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'nope'
          ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS d
        FROM {orders}""", "orders")
    date = F.col("d").try_cast("date")
    return text.select("o_orderkey", date.alias("d"), F.year(date).alias("y"))


@query("label_weekend", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, dayofweek(o_orderdate) IN (0, 6) AS is_weekend
FROM orders""")
def _(t):
    return label_weekend(t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("date")))


@query("weekend_totals", """
SELECT dayofweek(o_orderdate) IN (0, 6) AS is_weekend, count(*) AS orders,
       round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1""")
def _(t):
    labelled = label_weekend(t.orders, "o_orderdate")
    return labelled.groupBy("is_weekend").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("calendar", f"WITH {sql_calendar(_ORDER_YEARS)} SELECT day AS date FROM holidays")
def _(t):
    return holiday_calendar_of(t.orders, "o_orderdate").withColumnRenamed("o_orderdate", "date")


def _dated(t):
    day = F.when(F.col("o_orderstatus") != "F", F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", day.alias("date"))


_DATED = "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderdate AS DATE) END AS date FROM orders"


@query("label_holiday", f"""
WITH {sql_calendar(_ORDER_YEARS)}
SELECT o_orderkey, date, CASE WHEN date IS NOT NULL THEN day IS NOT NULL END AS is_belgian_holiday
FROM ({_DATED}) LEFT JOIN holidays ON date = day""")
def _(t):
    return label_holidays(_dated(t))


@query("label_holiday_list", f"""
WITH {sql_calendar("SELECT unnest(range(2000, 2020)) AS year")}
SELECT o_orderkey, date, CASE WHEN date IS NOT NULL THEN day IS NOT NULL END AS is_belgian_holiday
FROM ({_DATED}) LEFT JOIN holidays ON date = day""")
def _(t):
    return label_holidays(_dated(t), method="list")


@query("label_holiday_join", f"""
WITH {sql_calendar("SELECT unnest(range(2000, 2020)) AS year")}
SELECT o_orderkey, date, day IS NOT NULL AS is_belgian_holiday
FROM ({_DATED}) LEFT JOIN holidays ON date = day""")
def _(t):
    return label_holidays(_dated(t), method="join", years=range(2000, 2020), null_as=False)


@query("label_holiday_join_data_years", f"""
WITH {sql_calendar(_ORDER_YEARS)}
SELECT o_orderkey, date, CASE WHEN date IS NOT NULL THEN day IS NOT NULL END AS is_belgian_holiday
FROM ({_DATED}) LEFT JOIN holidays ON date = day""")
def _(t):
    return label_holidays(_dated(t), method="join")


# ---------------------------------------------------------------- clock times


@query("hhmm_strict", f"""
WITH c AS (SELECT event_id, day, {sql_number("hhmm")} AS n FROM ({_CLOCKS}))
SELECT event_id, {sql_clock("day", "n")} AS at FROM c""")
def _(t):
    at = clock.at_clock_time(F.col("day"), F.col("hhmm"))
    return raw.clocks(t).select("event_id", local(at).alias("at"))


@query("hhmm_2400", f"""
WITH c AS (SELECT event_id, day, {sql_number("hhmm")} AS n FROM ({_CLOCKS}))
SELECT event_id, {sql_clock_2400("day", "n")} AS at FROM c""")
def _(t):
    numbers = raw.clocks(t).withColumn("at", clock.clock_number(F.col("hhmm")))
    return clock.put_clock_times(numbers, "day", ["at"]).select("event_id", local("at").alias("at"))


@query("hhmm_overflow", f"""
WITH c AS (SELECT event_id, day, {sql_number("hhmm")} AS n FROM ({_CLOCKS}))
SELECT event_id, {sql_elapsed("day", "n")} AS at FROM c""")
def _(t):
    at = clock.after_day_start(F.col("day"), F.col("hhmm"))
    return raw.clocks(t).select("event_id", local(at).alias("at"))


@query("delay_columns", f"""
WITH c AS (SELECT event_id, day, {sql_number("hhmm")} AS n, {sql_number("planned")} AS p
           FROM ({_CLOCKS})),
d AS (SELECT event_id, CAST(date_diff('minute', {sql_clock("day", "p")}, {sql_clock("day", "n")})
             AS INTEGER) AS arr_delay FROM c)
SELECT event_id, arr_delay, CASE WHEN arr_delay < 0 THEN 0 ELSE arr_delay END AS arr_delay_new,
       arr_delay >= 15 AS arr_del15,
       CAST(CASE WHEN arr_delay < -15 THEN -2 WHEN arr_delay < 0 THEN -1 WHEN arr_delay >= 180 THEN 12
            ELSE arr_delay // 15 END AS INTEGER) AS arr_delay_group
FROM d""")
def _(t):
    times = raw.clocks(t).select("event_id", *[
        clock.at_clock_time(F.col("day"), F.col(c)).alias(c) for c in ("hhmm", "planned")
    ])
    return clock.with_delay_columns(times, "hhmm", "planned", "arr").drop("hhmm", "planned")


# ---------------------------------------------------------------- booleans and text


@query("to_bool", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN true WHEN o_orderstatus = 'O' THEN false END
       AS is_filled FROM orders""")
def _(t):
    return t.orders.select("o_orderkey", to_bool(F.col("o_orderstatus"), ["F"], ["O"]).alias("is_filled"))


_WORDS = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN ' yes ' WHEN l_returnflag = 'N'
  THEN 'No' WHEN l_linestatus = 'O' THEN 'perhaps' END AS word FROM {lineitem}"""


@query("to_bool_normalised", """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN true WHEN l_returnflag = 'N' THEN false END AS answer
FROM lineitem""")
def _(t):
    words = t.derive(_WORDS, "lineitem")
    return words.select("l_orderkey", "l_linenumber", to_bool_normalised(F.col("word")).alias("answer"))


@query("ternary_logic", """
WITH f AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS a,
  CASE WHEN o_orderpriority < '3' THEN true WHEN o_orderpriority < '5' THEN false END AS b FROM orders)
SELECT o_orderkey, a OR b AS "a or b", a AND b AS "a and b", NOT a AS "not a" FROM f""")
def _(t):
    priority = F.col("o_orderpriority")
    a = to_bool(F.col("o_orderstatus"), ["F"], ["O"])
    b = F.when(priority < "3", True).when(priority < "5", False)
    return t.orders.select("o_orderkey", *[c.alias(name) for name, c in kleene(a, b).items()])


@query("overlap_predicate", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_suppkey AS a,
  CASE WHEN l_returnflag <> 'A' THEN l_suppkey + l_linenumber END AS b, l_partkey % 100 AS c,
  CASE WHEN l_linestatus = 'O' THEN l_partkey % 100 + 5 END AS d FROM lineitem)
SELECT l_orderkey, l_linenumber, NOT (coalesce(a > d, false) OR coalesce(b < c, false)) AS overlaps
FROM r""")
def _(t):
    line, part = F.col("l_linenumber"), F.col("l_partkey") % 100
    return t.lineitem.select("l_orderkey", "l_linenumber", ranges_overlap(
        F.col("l_suppkey"), F.when(F.col("l_returnflag") != "A", F.col("l_suppkey") + line),
        part, F.when(F.col("l_linestatus") == "O", part + 5),
    ).alias("overlaps"))


_PLACES = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'nowhere' WHEN event_type = 'signup' THEN '50.85'
  ELSE '4.' || lpad(CAST(event_id * 7919 % 10000 AS STRING), 4, '0')
    || '|50.' || lpad(CAST(event_id * 104729 % 10000 AS STRING), 4, '0') END AS place
FROM {events}"""


@query("split_coordinates", f"""
SELECT event_id, TRY_CAST(split_part(place, '|', 1) AS FLOAT) AS longitude,
       CASE WHEN contains(place, '|') THEN TRY_CAST(split_part(place, '|', 2) AS FLOAT) END AS latitude
FROM ({_PLACES.format(events="events")})""")
def _(t):
    return split_coordinates(t.derive(_PLACES, "events"), "place", "|", 1, 0)


_ISO = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'yesterday' ELSE
  CAST(CAST(ts AS DATE) AS STRING) || 'T' || lpad(CAST(hour(ts) AS STRING), 2, '0') || ':'
  || lpad(CAST(minute(ts) AS STRING), 2, '0') || ':00+02:00' END AS text
FROM {events}"""


@query("iso_offset_timestamp", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('minute', ts) - INTERVAL 2 HOUR END AS at
FROM events""")
def _(t):
    return t.derive(_ISO, "events").select("event_id", utc(instant_of(F.col("text"))).alias("at"))


# ---------------------------------------------------------------- cleaning jobs

_RAW_FLIGHTS = raw.plain(raw.FLIGHTS)
_SHORTS = {
    "flight_number": "FL_NUM", "origin_airport_id": "ORIGIN_AIRPORT_ID",
    "dest_airport_id": "DEST_AIRPORT_ID", "dep_delay": "DEP_DELAY", "taxi_out": "TAXI_OUT",
    "taxi_in": "TAXI_IN", "arr_delay": "ARR_DELAY",
    "planned_duration_in_minutes": "CRS_ELAPSED_TIME",
    "actual_duration_in_minutes": "ACTUAL_ELAPSED_TIME",
    "in_air_duration_in_minutes": "AIR_TIME",
    "distance_between_airports_in_miles": "DISTANCE",
    "carrier_delay_in_minutes": "CARRIER_DELAY", "weather_delay_in_minutes": "WEATHER_DELAY",
    "nas_delay_in_minutes": "NAS_DELAY", "security_delay_in_minutes": "SECURITY_DELAY",
    "late_aircraft_delay_in_minutes": "LATE_AIRCRAFT_DELAY",
}
_CLOCK_NAMES = {CLEAN_NAMES.get(c, c).lower(): c for c in CLOCK_COLUMNS}
_DAY = "TRY_CAST(FL_DATE AS DATE)"


def _sql_list(columns: dict[str, str], form) -> str:
    return ", ".join(f"{form(source)} AS {name}" for name, source in columns.items())


CLEAN_FLIGHTS_SQL = f"""
SELECT {_DAY} AS flight_date, UNIQUE_CARRIER AS unique_carrier, TAIL_NUM AS tail_code,
       ORIGIN AS origin, ORIGIN_STATE_ABR AS origin_state_abr, DEST AS dest,
       DEST_STATE_ABR AS dest_state_abr, CANCELLATION_CODE AS cancellation_code,
       {sql_flag("CANCELLED")} AS is_cancelled, {sql_flag("DIVERTED")} AS is_diverted,
       {_sql_list(_SHORTS, sql_int)},
       {_sql_list(_CLOCK_NAMES, lambda c: sql_clock_2400(_DAY, sql_int(c)))}
FROM ({_RAW_FLIGHTS})"""


@query("clean_flights", CLEAN_FLIGHTS_SQL)
def _(t):
    return clean_flights(raw.flights(t)).withColumns({c: local(c) for c in _CLOCK_NAMES})


# The numbers of the other clean table.
_LONGHAND_SHORTS = [
    "FL_NUM", "ORIGIN_AIRPORT_ID", "TAXI_OUT", "TAXI_IN", "ARR_DELAY", "ARR_DELAY_NEW",
    "ARR_DEL15", "ARR_DELAY_GROUP", "CRS_ELAPSED_TIME", "CARRIER_DELAY", "WEATHER_DELAY",
    "NAS_DELAY", "SECURITY_DELAY", "LATE_AIRCRAFT_DELAY",
]


def _same_names(names):
    return {name: name for name in names}


@query("clean_flights_longhand", f"""
SELECT {_DAY} AS FL_DATE, UNIQUE_CARRIER, TAIL_NUM, ORIGIN, ORIGIN_STATE_ABR, DEST, DEST_STATE_ABR,
       CANCELLATION_CODE, DISTANCE,
       {sql_int("DEST_AIRPORT_ID", "INTEGER")} AS DEST_AIRPORT_ID,
       {sql_int("DISTANCE", "INTEGER")} AS DISTANCE_IN_MILES,
       {sql_int("FLIGHTS", "TINYINT")} AS FLIGHTS,
       {sql_int("DISTANCE_GROUP", "TINYINT")} AS DISTANCE_GROUP,
       TRY_CAST(CANCELLED AS DOUBLE) <> 0 AS IS_CANCELLED, TRY_CAST(DIVERTED AS DOUBLE) <> 0 AS IS_DIVERTED,
       {_sql_list(_same_names(_LONGHAND_SHORTS), sql_int)},
       {_sql_list(_same_names(LONGHAND_STRICT_TIMES), lambda c: sql_clock(_DAY, f"({sql_number(c)})"))},
       {_sql_list(_same_names(LONGHAND_OVERFLOWING_TIMES), lambda c: sql_elapsed(_DAY, f"({sql_number(c)})"))}
FROM ({_RAW_FLIGHTS})""")
def _(t):
    times = (*LONGHAND_STRICT_TIMES, *LONGHAND_OVERFLOWING_TIMES)
    return clean_flights_longhand(raw.flights(t)).withColumns({c: local(c) for c in times})


CLEAN_AIRPORTS_SQL = f"""
SELECT AIRPORT, min(DISPLAY_AIRPORT_NAME) AS DISPLAY_AIRPORT_NAME
FROM ({raw.plain(raw.AIRPORTS)}) GROUP BY AIRPORT"""
CLEAN_CARRIERS_SQL = f"""
SELECT DISTINCT CARRIER, CARRIER_NAME, CAST(START_DATE_SOURCE AS DATE) AS START_DATE_SOURCE,
       CAST(THRU_DATE_SOURCE AS DATE) AS THRU_DATE_SOURCE
FROM ({raw.plain(raw.CARRIERS)})"""


@query("clean_airports", CLEAN_AIRPORTS_SQL)
def _(t):
    return clean_airports(raw.airports(t))


@query("clean_carriers", CLEAN_CARRIERS_SQL)
def _(t):
    return clean_carriers(raw.carriers(t))


def _sql_word_flag(column: str) -> str:
    word = f"upper(trim({column}))"
    return f"CASE WHEN {word} IN ('TRUE', 'CLOSED') THEN true WHEN {word} IN ('FALSE', 'OPEN') THEN false END"


@query("clean_stations", f"""
SELECT {sql_int("number")} AS number, {sql_int("stands")} AS "Bike Stands",
       {sql_int("free_stands")} AS "Available Bike Stands", {sql_int("bikes")} AS "Available Bikes",
       {_sql_word_flag("banking")} AS has_banking, {_sql_word_flag("bonus")} AS has_bonus,
       {_sql_word_flag("status")} AS is_closed,
       TRY_CAST(updated[:19] AS TIMESTAMP) - INTERVAL 2 HOUR AS "Last Update",
       TRY_CAST(split_part(position, ',', 1) AS FLOAT) AS latitude,
       CASE WHEN contains(position, ',') THEN TRY_CAST(split_part(position, ',', 2) AS FLOAT) END AS longitude
FROM ({raw.plain(raw.STATIONS)})""")
def _(t):
    return clean_stations(raw.stations(t)).withColumn("Last Update", utc("Last Update"))


_EXPECTED_SQL = {"date": "TRY_CAST({0} AS DATE)", "smallint": "TRY_CAST(TRY_CAST({0} AS DOUBLE) AS SMALLINT)"}


def _sql_quality(column: str) -> str:
    kind = flight_plans.EXPECTED.get(column)
    bad = f"count(*) FILTER ({column} IS NOT NULL AND {_EXPECTED_SQL[kind.simpleString()].format(column)} IS NULL)" if kind else "0"
    return (f"SELECT '{column}' AS \"column\", count(*) AS rows, count(*) - count({column}) AS missing, "
            f"CAST({bad} AS BIGINT) AS uncastable, CAST(0 AS BIGINT) AS unknown FROM raw_flights")


@query("flight_quality", f"""
WITH raw_flights AS ({raw.plain(raw.FLIGHTS)})
{" UNION ALL ".join(_sql_quality(c) for c, _, _ in flight_plans.CLEAN_COLUMNS)}""")
def _(t):
    """The cells of the raw flights, counted in the pass that writes the clean ones."""
    quality = Quality(flight_plans.EXPECTED)
    materialise(flight_plans.clean_flights(quality.watch(raw.flights(t))), "clean-flights")
    return quality.table(t.spark)

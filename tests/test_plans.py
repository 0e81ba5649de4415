import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyfold.operators.compare import assert_same_frames
from tallyfold.plans import reports
from tallyfold.plans.dimensions import clean_airports, clean_carriers
from tallyfold.plans.flights import (
    clean_flights,
    clean_flights_longhand,
    read_flights,
)
from tallyfold.plans.stations import clean_stations
from tallyfold.sources.catalog import Catalog, flight_catalog
from tallyfold.workload import raw
from tallyfold.workload.registry import Tables

HEADER = (
    "YEAR,MONTH,DAY_OF_MONTH,DAY_OF_WEEK,FL_DATE,UNIQUE_CARRIER,TAIL_NUM,FL_NUM,ORIGIN_AIRPORT_ID,ORIGIN,"
    "ORIGIN_STATE_ABR,DEST_AIRPORT_ID,DEST,DEST_STATE_ABR,CRS_DEP_TIME,DEP_TIME,DEP_DELAY,DEP_DELAY_NEW,"
    "DEP_DEL15,DEP_DELAY_GROUP,TAXI_OUT,WHEELS_OFF,WHEELS_ON,TAXI_IN,CRS_ARR_TIME,ARR_TIME,ARR_DELAY,"
    "ARR_DELAY_NEW,ARR_DEL15,ARR_DELAY_GROUP,CANCELLED,CANCELLATION_CODE,DIVERTED,CRS_ELAPSED_TIME,"
    "ACTUAL_ELAPSED_TIME,AIR_TIME,FLIGHTS,DISTANCE,DISTANCE_GROUP,CARRIER_DELAY,WEATHER_DELAY,NAS_DELAY,"
    "SECURITY_DELAY,LATE_AIRCRAFT_DELAY,"
)
LINES = [
    "2011,1,7,5,2011-01-07,AA,N123,42,12892,LAX,CA,12478,JFK,NY,0905,0912,7.00,7.00,0.00,0,173.00,0925,1655,"
    "12.00,1710,1707,-3.00,0.00,0.00,-1,0.0,,0.0,305.00,295.00,270.00,1.00,2475.00,10,null,,,,,",
    "2011,1,8,6,2011-01-08,AA,null,43,12892,LAX,CA,12478,JFK,NY,2355,2400,5.00,5.00,0.00,0,9.00,0010,0755,"
    "5.00,2400,2410,25.00,25.00,1.00,1,0.0,,0.0,305.00,295.00,270.00,1.00,2475.00,10,0.00,25.00,0.00,0.00,0.00,",
    "2011,1,9,7,2011-01-09,UA,N9,44,12892,LAX,CA,12478,JFK,NY,0800,,,,,,,,,,1600,,,,,,1.0,B,0.0,305.00,,,1.00,"
    "far,10,,,,,,",
]


@pytest.fixture(scope="module")
def flights(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "flights.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return read_flights(spark, str(path))


def test_raw_flights(flights):
    assert len(flights.columns) == 45 and flights.columns[-1] == "_c44"
    assert set(dict(flights.dtypes).values()) == {"string"}
    assert flights.where("TAIL_NUM IS NULL").count() == 1


def test_clean_flights(flights, plan_of):
    clean = clean_flights(flights)
    assert len(clean.columns) == 32
    assert all(c == c.lower() for c in clean.columns)
    kinds = dict(clean.dtypes)
    assert kinds["flight_date"] == "date" and kinds["wheels_off"] == "timestamp"
    assert kinds["flight_number"] == "smallint" and kinds["is_cancelled"] == "boolean"
    on_time, late, cancelled = clean.orderBy("flight_number").collect()
    day = dt.datetime(2011, 1, 7)
    assert on_time["scheduled_departure_time"] == day.replace(hour=9, minute=5)
    assert on_time["taxi_out"] == 173 and on_time["arr_delay"] == -3
    assert on_time["carrier_delay_in_minutes"] is None and on_time["is_cancelled"] is False
    assert late["dep_time"] == dt.datetime(2011, 1, 9) and late["arr_time"] is None
    assert late["scheduled_arrival_time"] == dt.datetime(2011, 1, 9)
    assert late["wheels_off"] == dt.datetime(2011, 1, 8, 0, 10) and late["tail_code"] is None
    assert cancelled["is_cancelled"] is True and cancelled["dep_time"] is None
    assert cancelled["distance_between_airports_in_miles"] is None
    plan = plan_of(clean)
    assert "Exchange" not in plan and "Python" not in plan


def test_clean_flights_longhand(flights):
    clean = clean_flights_longhand(flights)
    dropped = {"YEAR", "MONTH", "DAY_OF_MONTH", "DAY_OF_WEEK", "_c44", "CANCELLED", "DIVERTED", "DEP_DELAY",
               "DEP_DELAY_NEW", "DEP_DEL15", "DEP_DELAY_GROUP", "ACTUAL_ELAPSED_TIME", "AIR_TIME"}
    added = {"IS_CANCELLED", "IS_DIVERTED", "DISTANCE_IN_MILES"}
    assert set(clean.columns) == (set(flights.columns) - dropped) | added
    _, late, cancelled = clean.orderBy("FL_NUM").collect()
    assert late["DEP_TIME"] is None
    assert late["CRS_ARR_TIME"] == dt.datetime(2011, 1, 9)
    assert late["TAXI_OUT"] == 9 and late["DISTANCE"] == "2475.00" and late["DISTANCE_IN_MILES"] == 2475
    assert cancelled["IS_CANCELLED"] is True and cancelled["IS_DIVERTED"] is False


def test_both_cleaners_agree_where_they_should(spark, data_dir):
    source = raw.flights(Tables(spark, data_dir))
    short = clean_flights(source).select("flight_date", "unique_carrier", "origin", "dest", "taxi_out", "arr_delay")
    long = clean_flights_longhand(source)
    long = long.select("FL_DATE", "UNIQUE_CARRIER", "ORIGIN", "DEST", "TAXI_OUT", "ARR_DELAY").toDF(*short.columns)
    assert_same_frames(short, long, check_nullability=False)


def test_dimensions(spark):
    airports = spark.createDataFrame(
        [("LAX", "Los Angeles", None), ("LAX", "LA", None), ("JFK", "Kennedy", None)],
        "AIRPORT string, DISPLAY_AIRPORT_NAME string, _c2 string")
    assert {tuple(r) for r in clean_airports(airports).collect()} == {("LAX", "LA"), ("JFK", "Kennedy")}
    carriers = spark.createDataFrame(
        [("AA", "American", "1960-01-01", None, None)] * 2 + [("UA", "United", "soon", "2000-01-01", None)],
        "CARRIER string, CARRIER_NAME string, START_DATE_SOURCE string, THRU_DATE_SOURCE string, _c4 string")
    rows = {tuple(r) for r in clean_carriers(carriers).collect()}
    assert rows == {("AA", "American", dt.date(1960, 1, 1), None), ("UA", "United", None, dt.date(2000, 1, 1))}


def test_stations(spark):
    frame = spark.createDataFrame(
        [("7", "20", "5.0", "x", "True", "False", "CLOSED", "2024-03-01T10:00:07+02:00", "50.85, 4.35"),
         ("70000", None, None, None, "ja", None, "open", "?", "50.85")],
        "number string, `Bike Stands` string, `Available Bike Stands` string, `Available Bikes` string,"
        "banking string, bonus string, status string, `Last Update` string, position string")
    first, second = clean_stations(frame).orderBy(F.desc("is_closed")).collect()
    assert first["number"] == 7 and first["Available Bike Stands"] == 5 and first["Available Bikes"] is None
    assert (first["has_banking"], first["has_bonus"], first["is_closed"]) == (True, False, True)
    assert first["Last Update"] == dt.datetime(2024, 3, 1, 8, 0, 7)
    assert second["number"] is None and second["longitude"] is None and second["has_banking"] is None
    assert second["is_closed"] is False


@pytest.fixture(scope="module")
def view(spark, flights):
    carriers = spark.sql("""SELECT * FROM VALUES
        ('AA', 'American Airlines', DATE '1960-01-01', CAST(NULL AS DATE)),
        ('UA', 'United (old)', DATE '1960-01-01', DATE '2011-01-08'),
        ('UA', 'United', DATE '2011-01-09', NULL)
        AS t(CARRIER, CARRIER_NAME, START_DATE_SOURCE, THRU_DATE_SOURCE)""")
    airports = spark.sql("SELECT * FROM VALUES ('LAX', 'Los Angeles') AS t(AIRPORT, DISPLAY_AIRPORT_NAME)")
    return reports.master_flights(clean_flights(flights), carriers, airports)


def test_master_view(view, flights):
    rows = view.orderBy("flight_number").collect()
    assert len(rows) == flights.count()
    assert [r["carrier_name"] for r in rows] == ["American Airlines"] * 2 + ["United"]
    assert {r["origin_airport_name"] for r in rows} == {"Los Angeles"}
    assert {r["dest_airport_name"] for r in rows} == {None}


def test_reports(view):
    assert reports.flights_operated_by(view, "American Airlines", 2011).first()["flights"] == 2
    assert reports.flights_operated_by(view, "American Airlines", 2012).first()["flights"] == 0
    assert reports.flights_on_time(view, "American Airlines", 2011).first()["flights"] == 1
    assert reports.flights_on_time(view, "American Airlines", 2011, 25).first()["flights"] == 2
    assert reports.flights_on_time(view, "United", 2011).first()["flights"] == 0
    top = reports.top_delay_cause(view, 2011).first()
    assert tuple(top) == ("weather_delay_in_minutes", 1, 25)
    assert reports.delay_causes(view, 2012).count() == 5


def test_friday_claim(spark):
    monday, friday = dt.date(2011, 1, 3), dt.date(2011, 1, 7)
    rows = [(monday, 5), (monday, 0), (monday, 1), (friday, 2), (friday, 3), (friday, None), (None, 4)]
    flights = spark.createDataFrame(rows, "flight_date date, dep_delay int")
    shares = reports.delayed_share_by_weekday(flights)
    assert {r["weekday"]: (r["departures"], r["delayed"]) for r in shares.collect()} == {2: (3, 2), 6: (2, 2)}
    assert reports.is_delayed_most_on(shares, 6)
    assert not reports.is_delayed_most_on(shares, 2)
    tie = flights.where("dep_delay > 0")
    assert not reports.is_delayed_most_on(reports.delayed_share_by_weekday(tie), 6)


def test_report_reads_few_columns_and_pushes_the_period(spark, tmp_path, flights, plan_of):
    catalog = Catalog(spark, flight_catalog("unused", str(tmp_path)))
    catalog.save(clean_flights(flights), "clean_flights", compression="snappy")
    stored = catalog.load("clean_flights")
    plan = plan_of(reports.delay_causes(stored, 2011))
    assert "GreaterThanOrEqual(flight_date,2011-01-01)" in plan and "LessThan(flight_date,2012-01-01)" in plan
    schema = plan.split("ReadSchema: ")[1]
    assert "origin" not in schema and "tail_code" not in schema

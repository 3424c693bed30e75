from __future__ import annotations

import csv
import shutil
from datetime import datetime, timedelta

import pytest

from curbside.plans.ingest import ingest_all, integrate_tables
from curbside.session import get_spark

TRIP_SCHEMA = (
    "VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "passenger_count bigint, trip_distance double, RatecodeID bigint, PULocationID int, DOLocationID int, "
    "fare_amount double, total_amount double, Airport_fee double"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path) -> str:
    return str(tmp_path / "tables")


def at(text: str) -> datetime:
    return datetime.strptime(text, "%Y-%m-%d %H:%M")


def trip(pickup: str, minutes: int = 10, pu=1, do=2, fare=10.0, vendor=1, passengers=1, distance=2.0, rate=1, fee=0.0):
    start = at(pickup)
    end = start + timedelta(minutes=minutes)
    return (vendor, start, end, passengers, distance, rate, pu, do, fare, fare + 1, fee)


TRIPS = [
    trip("2024-01-05 10:15"),
    trip("2024-01-05 10:15"),  # verbatim copy
    trip("2024-01-05 23:30", pu=3, do=1, fare=20.0, fee=1.75),  # next day in UTC
    trip("2024-01-06 11:00", pu=4, do=4, fare=-5.0),  # negative fare
    trip("2024-01-06 12:00", passengers=0),  # too few passengers
    trip("2024-01-06 13:00", passengers=None, fare=12.5, pu=2),  # unknown passengers pass
    trip("2024-01-06 14:00", pu=264),  # unknown location
    trip("2024-01-06 15:00", do=265),
    trip("2024-01-06 16:00", pu=None),
    trip("2024-02-01 09:00", pu=5, do=3, fare=30.0, vendor=None),  # NULL in the key
    trip("2024-02-02 09:30", pu=5, do=3, fare=30.0, distance=7.5),
    trip("2024-03-10 02:30", pu=6, do=1, fare=8.0),  # hour skipped by the spring change
    trip("2024-03-15 08:00", pu=2, do=6, fare=16.0, distance=4.0),
]
ZONES = [
    (1, "Manhattan", "Alphabet City"),
    (2, "Queens", "Corona"),
    (3, "Queens", "Corona"),  # a repeated zone name
    (4, "Bronx", "Allerton"),
    (5, "Brooklyn", "Red Hook"),
    (6, "EWR", "Newark Airport"),
    (7, "Staten Island", "Arden Heights"),
    (264, "Unknown", "N/A"),
    (265, "N/A", "Outside of NYC"),
]
WEATHER_HEADER = "year month day hour temp rhum prcp snwd wdir wspd wpgt pres cldc coco".split()
WEATHER = [
    (2024, 1, 5, 15, 3.5, 60, 0.0, 0, 350, 10.0, 20, 1010.0, 4, 3),
    (2024, 1, 6, 4, 1.0, 70, 0.2, 0, 10, 5.0, 9, 1011.5, 5, 7),
    (2024, 1, 6, 18, 2.0, 71, "", 0, 90, 6.0, 9, 1012.0, 5, 28),  # code without label
    (2024, 2, 2, 14, -3.0, 50, 0.0, 3, 180, 7.0, 9, 1000.0, 8, ""),
    (2024, 2, 30, 14, 0.0, 50, 0.0, 0, 180, 7.0, 9, 1000.0, 8, 1),  # no such day
    (2024, 3, 10, 7, 61.0, 50, 0.0, 0, 180, 7.0, 9, 1000.0, 8, 1),  # too warm
    (2024, 3, 15, 12, "", 50, 1.0, 0, 200, 7.0, 9, 1000.0, 8, 8),  # unknown temperature
]
AIR_HEADER = ["State Code", "County Code", "Site Num", "POC", "Date Local", "Time Local", "Date GMT", "Time GMT",
              "Sample Measurement"]
AIR = [
    ("36", "061", 10, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 8.0),
    ("36", "061", 20, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 12.0),  # second monitor
    ("36", "061", 20, 1, "2024-01-05", "10:00", "2024-01-05", "15:00", 12.0),  # copy
    ("36", "081", 30, 1, "2024-01-05", "23:00", "2024-01-06", "04:00", 40.0),
    ("36", "081", 30, 1, "2024-01-06", "13:00", "2024-01-06", "18:00", -1.0),  # negative
    ("36", "047", 40, 1, "2024-02-02", "09:00", "2024-02-02", "14:00", 300.0),
]


def write_csv(path, header, rows) -> str:
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows(rows)
    return str(path)


@pytest.fixture(scope="session")
def raw_paths(spark, tmp_path_factory) -> dict[str, str]:
    """Raw files of the four datasets."""
    tmp_path = tmp_path_factory.mktemp("raw")
    trips = str(tmp_path / "trips.parquet")
    spark.createDataFrame(TRIPS, TRIP_SCHEMA).write.parquet(trips)
    zones = [(i, borough, zone, "Zone") for i, borough, zone in ZONES]
    return {
        "taxi_zone": write_csv(tmp_path / "zones.csv", ["LocationID", "Borough", "Zone", "service_zone"], zones),
        "weather": write_csv(tmp_path / "weather.csv", WEATHER_HEADER, WEATHER),
        "air_quality": write_csv(tmp_path / "air.csv", AIR_HEADER, AIR),
        "taxi_trips": trips,
    }


@pytest.fixture(scope="session")
def built(spark, raw_paths, tmp_path_factory) -> str:
    """All base tables and the integrated table, built once."""
    root = str(tmp_path_factory.mktemp("built") / "tables")
    ingest_all(spark, root, raw_paths)
    integrate_tables(spark, root)
    return root


@pytest.fixture
def platform(built, root) -> str:
    """A copy of the built tables that a test may change."""
    shutil.copytree(built, root)
    return root


def rows(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import functions as F

from curbside.functions.bands import band_of, piecewise_index
from curbside.functions.hashing import key_columns, uniform
from curbside.functions.names import snake_case, snake_case_columns
from curbside.functions.timekeys import local_to_utc, minutes_between, parts_time_key, text_time_key, trip_time_key
from tests.conftest import at


def test_snake_case():
    expected = {
        "PULocationID": "pu_location_id",
        "VendorID": "vendor_id",
        "RatecodeID": "ratecode_id",
        "Date GMT": "date_gmt",
        "State Code": "state_code",
        "POC": "poc",
        "tpep_pickup_datetime": "tpep_pickup_datetime",
        "Airport_fee": "airport_fee",
    }
    assert {name: snake_case(name) for name in expected} == expected


def test_snake_case_columns_is_one_projection(spark):
    df = snake_case_columns(spark.range(1).select(F.col("id").alias("AbC"), F.lit(1).alias("X Y")))
    assert df.columns == ["ab_c", "x_y"]


def test_local_to_utc_around_clock_changes(spark):
    cases = [
        ("2024-01-15 12:00", "2024-01-15 17:00"),
        ("2024-07-15 12:00", "2024-07-15 16:00"),
        ("2024-03-10 02:30", "2024-03-10 07:30"),  # skipped hour
        ("2024-11-03 01:30", "2024-11-03 05:30"),  # repeated hour, earlier instant
    ]
    df = spark.createDataFrame([(at(a), at(b)) for a, b in cases], "local timestamp_ntz, utc timestamp_ntz")
    for row in df.select("utc", local_to_utc(F.col("local")).alias("got")).collect():
        assert row.got == row.utc


def test_trip_key_is_utc_hour_and_keeps_local_times(spark):
    df = spark.createDataFrame(
        [(at("2024-01-05 23:30"), at("2024-01-05 23:45"))],
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz",
    )
    out = trip_time_key(df)
    row = out.first()
    assert row.pickup_time_local == at("2024-01-05 23:30")
    assert row.time_utc == at("2024-01-06 04:00")
    assert dict(out.dtypes)["time_utc"] == "timestamp_ntz"


def test_parts_and_text_keys_give_null_for_bad_dates(spark):
    parts = spark.createDataFrame([(2024, 2, 29, 5), (2024, 2, 30, 5), (None, 1, 1, 1)], "year int, month int, day int, hour int")
    assert [r.time_utc for r in parts_time_key(parts).collect()] == [at("2024-02-29 05:00"), None, None]
    texts = spark.createDataFrame(
        [("2024-02-29", "05:45"), ("2024-02-30", "05:45"), (None, "05:45")], "date_gmt string, time_gmt string"
    )
    assert [r.time_utc for r in text_time_key(texts).collect()] == [at("2024-02-29 05:00"), None, None]


def test_minutes_are_truncated(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 30), datetime(2024, 1, 1, 0, 2, 29))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(minutes_between("a", "b")).first()[0] == 1


def test_bands_at_their_edges(spark):
    cases = {
        None: "Unknown", 0.0: "Good", 9.0: "Good", 9.01: "Moderate", 35.4: "Moderate",
        55.4: "Unhealthy for Sensitive", 125.4: "Unhealthy", 225.4: "Very Unhealthy", 225.5: "Hazardous",
        math.nan: "Hazardous",
    }
    df = spark.createDataFrame([(v, name) for v, name in cases.items()], "v double, name string")
    assert df.where(band_of(F.col("v")) != F.col("name")).count() == 0


def test_piecewise_index(spark):
    cases = [(None, None), (0.0, 0), (9.0, 50), (35.4, 100), (35.5, 101), (55.4, 150), (125.4, 200), (225.4, 300),
             (500.0, 500), (900.0, 500), (20.0, 71)]
    df = spark.createDataFrame(cases, "v double, want int")
    assert df.where(~piecewise_index(F.col("v")).eqNullSafe(F.col("want"))).count() == 0


def test_uniform_is_even_repeatable_and_seeded(spark):
    df = spark.range(20000).withColumn("name", F.concat(F.lit("n"), "id"))
    keyed = df.withColumns({"a": uniform(1, "id"), "b": uniform(2, "id"), "c": uniform(1, *key_columns(df, ["name"]))})
    stats = keyed.agg(F.avg("a"), F.min("a"), F.max("a"), F.corr("a", "b"), F.avg("c"), F.stddev("a")).first()
    assert abs(stats[0] - 0.5) < 0.01 and stats[1] >= 0 and stats[2] < 1
    assert abs(stats[3]) < 0.03 and abs(stats[4] - 0.5) < 0.01 and abs(stats[5] - 0.2887) < 0.01
    again = df.repartition(7).withColumn("a", uniform(1, "id"))
    assert keyed.select("id", "a").exceptAll(again.select("id", "a")).isEmpty()


def test_reduce_tasks_are_bounded_and_smaller_ones_stay(spark):
    from curbside.session import TASK_BYTES, TASK_BYTES_KEY, ensure_settings

    before = spark.conf.get(TASK_BYTES_KEY, None)
    try:
        for given, want in (("64m", str(TASK_BYTES)), ("16k", "16k"), (None, str(TASK_BYTES))):
            spark.conf.set(TASK_BYTES_KEY, given) if given else spark.conf.unset(TASK_BYTES_KEY)
            ensure_settings(spark)
            assert spark.conf.get(TASK_BYTES_KEY) == want
    finally:
        spark.conf.set(TASK_BYTES_KEY, before) if before else spark.conf.unset(TASK_BYTES_KEY)

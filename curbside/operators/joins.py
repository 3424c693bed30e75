"""Joins of facts with dimensions and observations.

The joins of trips are not hinted: Spark broadcasts a side that a scan or a shuffle has shown to be below its threshold, and adaptive
execution splits hot keys of the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def is_broadcastable(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure a side before it is hinted: one pass, one row back to the driver.

    Columns of fixed width count by their type; only texts, bytes and nested values are measured.
    """
    fixed, measured = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            measured.append(F.octet_length(F.col(f"`{f.name}`")))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            measured.append(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))))
        else:
            fixed += 8
    width = sum((F.coalesce(m, F.lit(0)) + F.lit(8) for m in measured), F.lit(fixed))
    size = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, **limits: int) -> DataFrame:
    """Hint a broadcast only for a side measured to be small.

    Beyond the limits no hint is given: the join shuffles and adaptive execution splits skewed
    partitions.
    """
    return F.broadcast(df) if is_broadcastable(df, **limits) else df


def attach_role(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, columns: Mapping[str, str]
) -> DataFrame:
    """LEFT join of one role of a dimension; `columns` maps dimension columns to role names."""
    role = dimension.select(
        F.col(dimension_key).alias("_role_key"), *[F.col(c).alias(name) for c, name in columns.items()]
    )
    return facts.join(role, F.col(fact_key) == F.col("_role_key"), "left").drop("_role_key")


def attach_zones(
    trips: DataFrame,
    zones: DataFrame,
    pickup: str = "pu_location_id",
    dropoff: str = "do_location_id",
    key: str = "location_id",
) -> DataFrame:
    """Zone and borough for both ends of a trip."""
    wanted = zones.select(key, "zone", "borough")
    out = attach_role(trips, wanted, pickup, key, {"zone": "pickup_zone", "borough": "pickup_borough"})
    return attach_role(out, wanted, dropoff, key, {"zone": "dropoff_zone", "borough": "dropoff_borough"})


# Borough, state code, county code.
REGION_CODES = (
    ("Bronx", "36", "005"),
    ("Brooklyn", "36", "047"),
    ("Manhattan", "36", "061"),
    ("Queens", "36", "081"),
    ("Staten Island", "36", "085"),
    ("EWR", "34", "013"),
)


def map_region_codes(
    df: DataFrame, column: str = "pickup_borough", codes: Sequence[tuple[str, str, str]] = REGION_CODES
) -> DataFrame:
    """Add state_code and county_code by a literal mapping; NULL for names it does not contain."""

    def lookup(position: int) -> Column:
        pairs = [F.lit(row[i]) for row in codes for i in (0, position)]
        return F.try_element_at(F.create_map(*pairs), F.col(column))

    return df.withColumns({"state_code": lookup(1), "county_code": lookup(2)})


# Observation column -> name on the trip.
WEATHER_COLUMNS = {
    "temp": "pickup_weather_temperature",
    "rhum": "pickup_weather_relative_humidity",
    "prcp": "pickup_weather_prcp",
    "snwd": "pickup_weather_snow_depth",
    "wspd": "pickup_weather_wind_speed",
    "wdir": "pickup_weather_wind_direction",
    "wpgt": "pickup_weather_wind_peak_gust",
    "pres": "pickup_weather_air_pressure",
    "cldc": "pickup_cloud_cover",
    "coco": "pickup_weather_condition_code",
}


def hourly_weather(weather: DataFrame, columns: Mapping[str, str] = WEATHER_COLUMNS) -> DataFrame:
    """Observations under their names on the trip; the condition code as a whole number."""
    values = {c: F.col(c).cast("int") if c == "coco" else F.col(c) for c in columns}
    return weather.select("time_utc", *[values[c].alias(name) for c, name in columns.items()])


def attach_hourly(trips: DataFrame, hourly: DataFrame) -> DataFrame:
    """LEFT join of observations keyed by `time_utc`."""
    return trips.join(hourly, "time_utc", "left")


def county_hour_means(
    air: DataFrame,
    codes: Sequence[tuple[str, str, str]] | None = None,
    value: str = "sample_measurement",
    name: str = "pickup_air_quality_pm25",
) -> DataFrame:
    """Mean measurement per county and hour; codes as numbers so that '005' meets 5.

    With `codes` only the counties that trips can have are read and aggregated.
    """
    state, county = F.col("state_code").cast("int"), F.col("county_code").cast("int")
    if codes is not None:
        wanted = [(state == int(s)) & (county == int(c)) for _, s, c in codes]
        air = air.where(reduce(Column.__or__, wanted))
    return air.groupBy(state.alias("state_code"), county.alias("county_code"), "time_utc").agg(
        F.avg(value).alias(name)
    )


def attach_air(trips: DataFrame, means: DataFrame) -> DataFrame:
    """LEFT join of pre-aggregated measurements on (state, county, hour)."""
    side = means.withColumnsRenamed({"state_code": "_state", "county_code": "_county", "time_utc": "_hour"})
    matches = (
        (F.col("state_code").cast("int") == F.col("_state"))
        & (F.col("county_code").cast("int") == F.col("_county"))
        & (F.col("time_utc") == F.col("_hour"))
    )
    return trips.join(side, matches, "left").drop("_state", "_county", "_hour")

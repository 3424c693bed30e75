"""Dataset contracts: what a raw dataset must contain and how it becomes a cleaned table."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from curbside.functions.timekeys import parts_time_key, text_time_key, trip_time_key
from curbside.operators.clean import exclude_codes
from curbside.operators.rules import AllowedValues, NumericRange, Predicate, Rule

Bounds = tuple[float | None, float | None]


@dataclass(frozen=True)
class DatasetSpec:
    """Contract of one dataset. Column names are those after snake-casing."""

    name: str
    format: str
    required: frozenset[str]
    keys: tuple[str, ...]
    ranges: Mapping[str, Bounds] = field(default_factory=dict)
    add_time_key: Callable[[DataFrame], DataFrame] | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    optional: frozenset[str] = frozenset()
    extra_rules: Sequence[Rule] = ()
    # column -> (dataset, column) that must contain its values
    references: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    # known column types of text files; columns not named here are inferred
    types: Mapping[str, str] = field(default_factory=dict)
    schema_version: str = "1.0"


# Zone ids that mean "unknown" and "outside the city".
EXCLUDED_ZONES = (264, 265)
# Valid rate codes.
RATE_CODES = (1, 2, 3, 4, 5, 6, 99)

TAXI_ZONE = DatasetSpec(
    name="taxi_zone",
    format="csv",
    required=frozenset({"location_id", "borough", "zone"}),
    keys=("location_id",),
    types={"location_id": "int", "borough": "string", "zone": "string", "service_zone": "string"},
)

WEATHER = DatasetSpec(
    name="weather",
    format="csv",
    required=frozenset({"year", "month", "day", "hour", "temp", "prcp"}),
    keys=("year", "month", "day", "hour"),
    ranges={"temp": (-90, 60)},
    types={
        **dict.fromkeys(("year", "month", "day", "hour"), "int"),
        **dict.fromkeys(
            ("temp", "rhum", "prcp", "snwd", "wdir", "wspd", "wpgt", "pres", "cldc", "coco", "humidity"), "double"
        ),
    },
    add_time_key=parts_time_key,
    extra_rules=(NumericRange("humidity", 0.0, 100.0), NumericRange("prcp", 0.0, None)),
)

AIR_QUALITY = DatasetSpec(
    name="air_quality",
    format="csv",
    required=frozenset(
        {"state_code", "county_code", "site_num", "poc", "date_gmt", "time_gmt", "sample_measurement"}
    ),
    keys=("state_code", "county_code", "site_num", "date_local", "time_utc", "poc"),
    ranges={"sample_measurement": (0, None)},
    types={
        **dict.fromkeys(("state_code", "county_code", "site_num", "parameter_code", "poc", "aqi"), "int"),
        **dict.fromkeys(("date_local", "date_gmt", "date_of_last_change"), "date"),
        **dict.fromkeys(("time_local", "time_gmt"), "string"),
        **dict.fromkeys(("sample_measurement", "latitude", "longitude", "mdl", "uncertainty"), "double"),
        **dict.fromkeys(
            ("datum", "parameter_name", "units_of_measure", "qualifier", "method_type", "method_code",
             "method_name", "state_name", "county_name"),
            "string",
        ),
    },
    add_time_key=text_time_key,
    extra_rules=(NumericRange("aqi", 0, 500),),
)

TAXI_TRIPS = DatasetSpec(
    name="taxi_trips",
    format="parquet",
    required=frozenset(
        {
            "vendor_id",
            "ratecode_id",
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "passenger_count",
            "trip_distance",
            "pu_location_id",
            "do_location_id",
            "fare_amount",
        }
    ),
    keys=(
        "vendor_id",
        "pickup_time_local",
        "dropoff_time_local",
        "pu_location_id",
        "do_location_id",
        "fare_amount",
    ),
    ranges={"trip_distance": (0, None), "fare_amount": (0, None), "passenger_count": (1, None)},
    add_time_key=trip_time_key,
    transform=lambda df: exclude_codes(df, ("pu_location_id", "do_location_id"), EXCLUDED_ZONES),
    references={
        "pu_location_id": ("taxi_zone", "location_id"),
        "do_location_id": ("taxi_zone", "location_id"),
    },
    extra_rules=(
        Predicate("predicate[dropoff_after_pickup]", "dropoff_time_local > pickup_time_local"),
        AllowedValues("ratecode_id", RATE_CODES),
    ),
)

MOBILITY = {spec.name: spec for spec in (TAXI_ZONE, WEATHER, AIR_QUALITY, TAXI_TRIPS)}

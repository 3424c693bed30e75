"""Star-schema tables seen as mobility data.

Two fact tables play the trips: `events` where the hour matters, `lineitem` with `orders` where
months matter. Joins run left-deep over plain Parquet scans, so Catalyst knows every side's file
size and broadcasts only those below its own threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.operators.clean import in_range
from curbside.operators.dedup import keep_first
from curbside.operators.joins import (
    attach_air,
    attach_hourly,
    attach_role,
    attach_zones,
    county_hour_means,
    hourly_weather,
    map_region_codes,
)
from curbside.operators.rules import (
    AllowedValues,
    Duplicate,
    NotNull,
    NumericRange,
    Predicate,
    ReferenceIntegrity,
    Rule,
)
from curbside.session import ensure_settings, settle
from curbside.sources.layout import with_pickup_date

# Region name, state code, county code; one region has none.
REGIONS = (
    ("AFRICA", "36", "005"),
    ("AMERICA", "36", "047"),
    ("ASIA", "36", "061"),
    ("EUROPE", "34", "013"),
)
# Regions under the names of boroughs, for the operators that know these; one region has none.
BOROUGHS = {"AFRICA": "Bronx", "AMERICA": "Brooklyn", "ASIA": "Manhattan", "EUROPE": "EWR"}
MONTHS = ("1996-01-01", "1996-04-01")
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_ROW_KEYS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
BASE_UNTIL = "2000-01-01"
UPDATE_FROM = "1999-07-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ensure_settings(spark).read.parquet(f"{folder}/{name}.parquet")


def zones(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as locations: nation is the zone, region the borough."""
    customer, nation, region = (table(spark, folder, n) for n in ("customer", "nation", "region"))
    return (
        customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("location_id"),
            F.col("n_name").alias("zone"),
            F.col("r_name").alias("borough"),
            F.col("n_nationkey").alias("zone_code"),
        )
    )


def hour_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Events as trips: from the user's location to the location named in `props`."""
    events = table(spark, folder, "events")
    seconds = F.col("event_id") * 37 % 5400
    return with_pickup_date(
        events.select(
            F.col("event_id").alias("trip_id"),
            F.col("user_id").alias("pu_location_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("do_location_id"),
            F.col("ts").alias("pickup_time_local"),
            (F.col("ts") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).alias("dropoff_time_local"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time_utc"),
            F.col("value").alias("trip_distance"),
            (F.col("value") * 2).alias("fare_amount"),
        )
    )


def hour_weather(spark: SparkSession, folder: str) -> DataFrame:
    """Events as observations: mean value and a condition code per hour."""
    events = table(spark, folder, "events")
    return events.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time_utc")).agg(
        F.avg("value").alias("temp"), (F.count("*") * 7 % 30).cast("int").alias("coco")
    )


def hour_air(spark: SparkSession, folder: str) -> DataFrame:
    """Events as measurements at the user's region."""
    events = table(spark, folder, "events")
    places = map_region_codes(zones(spark, folder), "borough", REGIONS)
    return events.join(places, events.user_id == places.location_id).select(
        "state_code",
        "county_code",
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("time_utc"),
        F.col("value").alias("sample_measurement"),
    )


HOUR_WEATHER_COLUMNS = {"temp": "pickup_weather_temperature", "coco": "pickup_weather_condition_code"}


def with_zones(spark: SparkSession, folder: str) -> DataFrame:
    return attach_zones(hour_trips(spark, folder), zones(spark, folder))


def with_pickup_zones(spark: SparkSession, folder: str) -> DataFrame:
    """Pickup zone and borough only, for questions that do not ask where trips end."""
    places = zones(spark, folder).select("location_id", "zone", "borough")
    names = {"zone": "pickup_zone", "borough": "pickup_borough"}
    return attach_role(hour_trips(spark, folder), places, "pu_location_id", "location_id", names)


def with_weather(spark: SparkSession, folder: str, trips: DataFrame) -> DataFrame:
    return attach_hourly(trips, hourly_weather(hour_weather(spark, folder), HOUR_WEATHER_COLUMNS))


def with_air(spark: SparkSession, folder: str, trips: DataFrame) -> DataFrame:
    means = county_hour_means(hour_air(spark, folder), REGIONS)
    return attach_air(map_region_codes(trips, codes=REGIONS), means)


def integrated(spark: SparkSession, folder: str) -> DataFrame:
    """Event trips with everything attached."""
    return with_air(spark, folder, with_weather(spark, folder, with_zones(spark, folder)))


def month_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as trips from the supplier's nation to the customer's."""
    line, orders, supplier, customer = (
        table(spark, folder, n) for n in ("lineitem", "orders", "supplier", "customer")
    )
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")

    def place(role: str) -> tuple[DataFrame, DataFrame]:
        n = nation.select(
            F.col("n_nationkey").alias(f"{role}_nation"),
            F.col("n_regionkey").alias(f"{role}_region"),
            F.col("n_name").alias(f"{role}_zone"),
        )
        r = region.select(F.col("r_regionkey").alias(f"{role}_r"), F.col("r_name").alias(f"{role}_borough"))
        return n, r

    pick_n, pick_r = place("pickup")
    drop_n, drop_r = place("dropoff")
    joined = (
        line.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(pick_n, F.col("s_nationkey") == F.col("pickup_nation"), "left")
        .join(pick_r, F.col("pickup_region") == F.col("pickup_r"), "left")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(drop_n, F.col("c_nationkey") == F.col("dropoff_nation"), "left")
        .join(drop_r, F.col("dropoff_region") == F.col("dropoff_r"), "left")
    )
    return with_pickup_date(
        joined.select(
            *LINE_ROW_KEYS,
            F.col("o_orderdate").alias("pickup_time_local"),
            F.col("l_shipdate").alias("dropoff_time_local"),
            F.col("l_quantity").alias("trip_distance"),
            F.col("l_linenumber").alias("passenger_count"),
            F.col("l_extendedprice").alias("fare_amount"),
            F.col("l_tax").alias("airport_fee"),
            (F.col("l_extendedprice") * (F.col("l_tax") + 1)).alias("total_amount"),
            "pickup_zone",
            "pickup_borough",
            "dropoff_zone",
            "dropoff_borough",
        )
    )


def line_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as trips without their places."""
    line, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        *LINE_ROW_KEYS,
        F.col("o_orderdate").alias("pickup_time_local"),
        F.col("l_shipdate").alias("dropoff_time_local"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_linenumber").alias("passenger_count"),
    )


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with order date and the name of a customer in credit: input of the rules."""
    customers = table(spark, folder, "customer").where(in_range("c_acctbal", 0, None))
    return (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate", "o_orderdate", "c_name",
        )
    )


def reliable_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").where("s_acctbal >= 0").select("s_suppkey")


def shipment_rules(spark: SparkSession, folder: str) -> list[Rule]:
    return [
        NotNull((*LINE_KEYS, "c_name"), rule_id="not_null"),
        NumericRange("l_quantity", 2, 45, rule_id="range"),
        Duplicate(LINE_KEYS, rule_id="duplicate"),
        ReferenceIntegrity("l_suppkey", reliable_suppliers(spark, folder), "s_suppkey", rule_id="reference"),
        Predicate("predicate", "l_shipdate > o_orderdate"),
        AllowedValues("l_returnflag", ("A", "R"), rule_id="allowed"),
    ]


def base_and_update(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lines shipped before a day, and a later delivery that overlaps them by half a year."""
    line = table(spark, folder, "lineitem")
    base = line.where(F.col("l_shipdate") < F.lit(BASE_UNTIL).cast("timestamp_ntz"))
    update = line.where(F.col("l_shipdate") >= F.lit(UPDATE_FROM).cast("timestamp_ntz"))
    return keep_first(base, LINE_KEYS), settle(keep_first(update, LINE_KEYS), "update")


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as runs of five datasets."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("dataset"),
        F.col("o_orderdate").alias("executed_at"),
        F.col("o_totalprice").alias("execution_time_s"),
        F.col("o_custkey").alias("processed_records"),
        (F.col("o_custkey") % 7).alias("rejected_records"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey") % 5).otherwise(0).alias("validation_failures"),
    )


def rule_log(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines per month, return flag and line status as rule metrics."""
    untaxed = F.count_if(F.col("l_tax") == 0)
    return (
        table(spark, folder, "lineitem")
        .groupBy(
            F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("executed_at"),
            F.col("l_returnflag").alias("dataset"),
            F.concat(F.lit("rule_"), "l_linestatus").alias("rule_id"),
        )
        .agg(
            F.count("*").alias("rows_in"),
            untaxed.alias("rows_failed"),
            F.avg("l_quantity").alias("elapsed_s"),
        )
        .select(
            F.date_format("executed_at", "yyyy-MM").alias("run_id"),
            "dataset",
            "executed_at",
            "rule_id",
            F.when(F.col("rule_id") == "rule_O", "range").otherwise("not_null").alias("rule_type"),
            "rows_in",
            "rows_failed",
            "elapsed_s",
            (F.col("rows_failed") * 6 > F.col("rows_in")).alias("hard_failure"),
        )
    )


def priced_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with part type: target, numbers, categories and dates for the model."""
    line, part = table(spark, folder, "lineitem"), table(spark, folder, "part")
    return line.join(part, line.l_partkey == part.p_partkey, "left").select(
        *LINE_ROW_KEYS, "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "p_type"
    )

"""Analytical questions over the integrated trips table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.functions.bands import band_of
from curbside.functions.timekeys import minutes_between, weekday_name

PM25 = "pickup_air_quality_pm25"
CONDITION_CODE = "pickup_weather_condition_code"
MAX_HINTED_ROWS = 10_000


def _mean(value: Column | str, name: str, digits: int = 2) -> Column:
    return F.round(F.avg(value), digits).alias(name)


def monthly_zone_demand(trips: DataFrame) -> DataFrame:
    """Trips per month and pickup zone, busiest first."""
    return (
        trips.groupBy(F.substring("pickup_date", 1, 7).alias("pickup_month"), "pickup_zone")
        .agg(F.count("*").alias("num_trips"))
        .orderBy(F.desc("num_trips"), "pickup_month", "pickup_zone")
    )


def _with_label(trips: DataFrame, labels: DataFrame) -> DataFrame:
    return trips.join(labels, trips[CONDITION_CODE] == labels["coco"], "left")


def _is_short(lookup: DataFrame) -> bool:
    """Whether a lookup has at most MAX_HINTED_ROWS rows; reads no more than one row beyond."""
    return lookup.limit(MAX_HINTED_ROWS + 1).count() <= MAX_HINTED_ROWS


def distance_by_bucket(
    trips: DataFrame, labels: DataFrame, buckets: DataFrame, hint: bool = False
) -> DataFrame:
    """Mean distance and trips per weather bucket; no bucket is NULL.

    `hint` asks for broadcast joins of lookups with at most MAX_HINTED_ROWS rows; larger ones join unhinted.
    """
    if hint:
        labels, buckets = (F.broadcast(side) if _is_short(side) else side for side in (labels, buckets))
    return (
        _with_label(trips, labels)
        .join(buckets, "weather_condition", "left")
        .groupBy(F.col("weather_bucket").alias("weather"))
        .agg(_mean("trip_distance", "miles"), F.count("*").alias("trips"))
        .orderBy(F.desc("miles"))
    )


def distance_by_label(trips: DataFrame, labels: DataFrame) -> DataFrame:
    """Mean distance and trips per weather condition; no condition is 'Unknown'."""
    return (
        _with_label(trips, labels)
        .groupBy(F.coalesce("weather_condition", F.lit("Unknown")).alias("weather"))
        .agg(_mean("trip_distance", "miles"), F.count("*").alias("trips"))
        .orderBy(F.desc("miles"))
    )


def demand_by_band(trips: DataFrame) -> DataFrame:
    """Trips, observed hours and trips per hour for each air-quality band."""
    return (
        trips.groupBy(band_of(F.col(PM25)).alias("air_quality_category"))
        .agg(F.count("*").alias("trips"), F.count_distinct("time_utc").alias("hours_observed"))
        .withColumn("avg_trips_per_hour", F.round(F.col("trips") / F.col("hours_observed"), 2))
        .orderBy(F.desc("avg_trips_per_hour"))
    )


def zone_variation(trips: DataFrame, labels: DataFrame, buckets: DataFrame) -> DataFrame:
    """Spread of a zone's demand over weather buckets, most variable first."""
    per_bucket = (
        _with_label(trips, labels)
        .join(buckets, "weather_condition", "left")
        .groupBy("pickup_zone", "weather_bucket")
        .agg(F.count("*").alias("n"))
    )
    mean, spread = F.avg("n"), F.stddev("n")
    return (
        per_bucket.groupBy("pickup_zone")
        .agg(
            F.round(mean, 2).alias("avg_trips_per_condition"),
            F.round(spread, 2).alias("stddev_trips"),
            F.round(spread / mean * 100, 2).alias("coeff_of_variation"),
        )
        .orderBy(F.desc("coeff_of_variation"))
    )


def top_hours_per_weekday(trips: DataFrame, top: int = 3) -> DataFrame:
    """The busiest hours of each weekday; ties may give more than `top`."""
    pickup = F.col("pickup_time_local")
    counted = trips.groupBy(weekday_name(pickup).alias("dow"), F.hour(pickup).alias("hour")).agg(
        F.count("*").alias("trips")
    )
    ranked = counted.withColumn("rank", F.rank().over(Window.partitionBy("dow").orderBy(F.desc("trips"))))
    return ranked.where(F.col("rank") <= top)


def monthly_trends(
    trips: DataFrame, start: str = "2024-01-01", end: str = "2024-04-01", prune: bool = True
) -> DataFrame:
    """Monthly totals, means, airport share and revenue in [start, end).

    With `prune` the filter is on the partition column `pickup_date`, so other days are not read;
    without, it is on the pickup time.
    """
    if prune:
        window = (F.col("pickup_date") >= start) & (F.col("pickup_date") < end)
    else:
        pickup = F.col("pickup_time_local")
        window = (pickup >= F.lit(start).cast("timestamp_ntz")) & (pickup < F.lit(end).cast("timestamp_ntz"))
    airport = F.count_if(F.col("airport_fee") > 0)
    return (
        trips.where(window)
        .groupBy(F.substring("pickup_date", 1, 7).alias("pickup_month"))
        .agg(
            F.count("*").alias("total_trips"),
            _mean("trip_distance", "avg_trip_distance"),
            _mean("passenger_count", "avg_passengers"),
            _mean(minutes_between("pickup_time_local", "dropoff_time_local"), "avg_trip_duration_minutes"),
            airport.alias("airport_trips"),
            F.round(airport * F.lit(100.0) / F.count("*"), 2).alias("airport_trip_percentage"),
            F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        )
        .orderBy("pickup_month")
    )


def trips_by_borough(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_borough").agg(F.count("*").alias("trips"))


def fare_by_borough(trips: DataFrame) -> DataFrame:
    return trips.groupBy("pickup_borough").agg(F.avg("fare_amount").alias("avg_fare"))


def duration_by_day(trips: DataFrame) -> DataFrame:
    """Mean trip duration in seconds per local day."""
    seconds = F.timestamp_diff("SECOND", F.col("pickup_time_local"), F.col("dropoff_time_local"))
    return trips.groupBy("pickup_date").agg(F.avg(seconds).alias("avg_duration_s"))


def six_questions(trips: DataFrame, labels: DataFrame, buckets: DataFrame) -> dict[str, DataFrame]:
    """The analytical workload as a whole, as the experiments run it."""
    return {
        "monthly_zone_demand": monthly_zone_demand(trips),
        "distance_by_bucket": distance_by_bucket(trips, labels, buckets),
        "demand_by_band": demand_by_band(trips),
        "zone_variation": zone_variation(trips, labels, buckets),
        "top_hours_per_weekday": top_hours_per_weekday(trips),
        "monthly_trends": monthly_trends(trips),
    }

"""The hour key `time_utc` (timestamp_ntz) that joins all time-varying datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"


def to_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def local_to_utc(local: Column, zone: str = NEW_YORK) -> Column:
    """Wall clock of `zone` to UTC, as timestamp_ntz.

    A wall clock the spring change skips moves forward; one the autumn change repeats takes
    the earlier instant.
    """
    return F.to_utc_timestamp(local, zone).cast("timestamp_ntz")


def trip_time_key(
    df: DataFrame,
    pickup: str = "tpep_pickup_datetime",
    dropoff: str = "tpep_dropoff_datetime",
    zone: str = NEW_YORK,
) -> DataFrame:
    """Keep the local wall clocks, add their UTC forms and the pickup hour."""
    renamed = df.withColumnsRenamed({pickup: "pickup_time_local", dropoff: "dropoff_time_local"})
    pickup_utc = local_to_utc(F.col("pickup_time_local"), zone)
    return renamed.withColumns(
        {
            "pickup_time_utc": pickup_utc,
            "dropoff_time_utc": local_to_utc(F.col("dropoff_time_local"), zone),
            "time_utc": to_hour(pickup_utc),
        }
    )


def parts_time_key(df: DataFrame) -> DataFrame:
    """Hour key from year, month, day, hour; NULL for dates that do not exist."""
    parts = [F.col(c).cast("int") for c in ("year", "month", "day", "hour")]
    made = F.try_make_timestamp_ntz(*parts, F.lit(0), F.lit(0))
    return df.withColumn("time_utc", to_hour(made))


def text_time_key(df: DataFrame, date: str = "date_gmt", clock: str = "time_gmt") -> DataFrame:
    """Hour key from a date column and an `HH:mm` text column; NULL where they do not parse."""
    text = F.concat_ws(" ", F.col(date).cast("string"), F.col(clock))
    return df.withColumn("time_utc", to_hour(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))))


def minutes_between(start: str, end: str) -> Column:
    """Whole minutes, truncated towards zero."""
    return F.timestamp_diff("MINUTE", F.col(start), F.col(end))


def weekday_name(ts: Column) -> Column:
    return F.date_format(ts, "EEEE")
